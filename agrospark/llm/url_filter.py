"""URL filters: glob rules as one bit-parallel automaton that reads each canonical URL once for all rules.

A canonical URL is a dot, the host in lower case and the path, so that a rule for a host and all its subdomains is one
glob. `*` is any run without a slash, `**` any run, `?` any one character but a slash, `[...]` one of a set.

Every glob is a run of states in one long bit vector, cut into 64-bit words: the state before anything is read, and
one per symbol. Reading a character shifts all states by one (the top bit of a word moves into the next) and keeps
those whose symbol it is; states followed by a wildcard may stay as well. Batches of URLs are read in step, a column
of characters at a time; the few that are much longer than the others are finished one by one, the vector being a
single integer.

Rules are judged by the longest that fits (the first listed among equally long ones). A URL that no rule fits is
blocked if one of the general globs fits it, else allowed. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from agrospark.llm import common


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, and how the path begins."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{literal(self.name)}**"


RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
)
# Words that a label of a host begins with on pages that are of no use as text, and paths of machines.
UNWANTED = ("ads", "adserver", "bets", "casino", "malware", "phishing", "poker", "porn", "spam", "track", "viagra", "warez", "xxx")
GLOBS = (
    *(f"*[.-]{word}[.-]**" for word in UNWANTED), "*/**/wp-login.php", "*/wp-login.php", "*/cgi-bin/**", "*/**.exe", "*/**.apk",
)


def literal(text: str) -> str:
    """The text as a glob that fits it alone."""
    return "".join(f"[{c}]" if c in "*?[" else c for c in text)


def symbols(glob: str) -> tuple[list[str | None], dict[int, bool]]:
    """(one set of characters per symbol, None for any but a slash; the symbols before which a run may stand, and
    whether it may hold slashes)."""
    found: list[str | None] = []
    runs: dict[int, bool] = {}
    i = 0
    while i < len(glob):
        if glob[i] == "*":
            end = i
            while end < len(glob) and glob[end] == "*":
                end += 1
            runs[len(found)] = end - i > 1 or runs.get(len(found), False)
            i = end
        elif glob[i] == "[":
            end = glob.index("]", i + 2)
            found.append(glob[i + 1:end])
            i = end + 1
        else:
            found.append(None if glob[i] == "?" else glob[i])
            i += 1
    return found, runs


class Automaton:
    """All globs at once; `fits` has one row per text and one column per glob."""

    def __init__(self, globs: Sequence[str]):
        parsed = [symbols(g) for g in globs]
        known = sorted({c for found, _ in parsed for s in found if s for c in s} | {"/"})
        # Class 0 stands for every character that no glob names.
        self.classes = np.zeros(max(map(ord, known)) + 2, np.int64)
        self.classes[[ord(c) for c in known]] = np.arange(1, len(known) + 1)
        slash = 1 + known.index("/")
        number = {c: i + 1 for i, c in enumerate(known)}
        size = sum(len(found) + 1 for found, _ in parsed)
        self.words = max(1, -(-size // 64))
        enter, stay = [0] * (len(known) + 1), [0] * (len(known) + 1)
        begin, self.ends, at = 0, [], 0
        for found, runs in parsed:
            begin |= 1 << at
            for i, some in enumerate(found):
                classes = [c for c in range(len(enter)) if c != slash] if some is None else {number[c] for c in some}
                for c in classes:
                    enter[c] |= 1 << (at + i + 1)
            for i, crosses in runs.items():
                for c in range(len(enter)):
                    if crosses or c != slash:
                        stay[c] |= 1 << (at + i)
            at += len(found) + 1
            self.ends.append(at - 1)
        self.begin, self.enter, self.stay = begin, enter, stay
        self._begin, self._enter, self._stay = self._packed([begin])[0], self._packed(enter), self._packed(stay)

    def _packed(self, masks: Sequence[int]) -> np.ndarray:
        data = b"".join(m.to_bytes(8 * self.words, "little") for m in masks)
        return np.frombuffer(data, "<u8").reshape(len(masks), self.words)

    def fits(self, texts: Sequence[str], few: int = 8) -> np.ndarray:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        codes = self.classes[np.minimum(codes, len(self.classes) - 1)]
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        ranked, first = lengths[order], starts[order]
        states = np.tile(self._begin, (len(texts), 1))
        step = 0
        while True:
            n = int(np.searchsorted(-ranked, -step, side="left"))  # texts longer than `step`
            if n <= few:
                break
            c = codes[first[:n] + step]
            now = states[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            states[:n] = moved & self._enter[c] | now & self._stay[c]
            step += 1
        for i in range(n):
            state = int.from_bytes(states[i].tobytes(), "little")
            for c in codes[first[i] + step:first[i] + ranked[i]].tolist():
                state = (state << 1) & self.enter[c] | state & self.stay[c]
            states[i] = self._packed([state])[0]
        ends = np.array(self.ends, np.int64)
        found = np.empty((len(texts), len(ends)), bool)
        found[order] = states[:, ends // 64] >> (ends % 64).astype(np.uint64) & np.uint64(1)
        return found


def host_and_path(pages: DataFrame) -> DataFrame:
    """page_id, host, path: what follows the first `://`; both are empty where there is none, or no url."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring("url", at + 3, F.length("url"))).otherwise("")
    rest = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^?#]*", 0)
    host = F.regexp_extract("rest", "^[^/]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.select("page_id", rest.alias("rest")) \
        .select("page_id", lower.alias("host"), F.substring("rest", F.length(host) + 1, F.length("rest")).alias("path"))


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, globs: Sequence[str] = GLOBS) -> DataFrame:
    """One row for each row of (page_id, url): page_id, host, path, rule, verdict, glob.

    `rule` is the fixed rule that decided, else null; `glob` the first general glob that fits, whatever decided. A null
    url, or one without `://`, has an empty host and path, which rules do not fit; so has an empty host for rules on
    hosts. A path that is empty does not begin with a slash. Repeated rows are judged each for itself.
    """
    ranked = sorted(rules, key=lambda r: -len(r.name))  # stable: the first listed of equally long ones
    kind = pages.schema["page_id"].dataType.simpleString()
    out = f"page_id {kind}, host string, path string, rule string, verdict string, glob string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton([r.glob for r in ranked] + list(globs))
        rows = max(1, (4 << 20) // (8 * automaton.words))

        def first(fits: np.ndarray, names: list) -> np.ndarray:
            """Per row the name of its first column that is true, or None."""
            index = np.where(fits.any(axis=1), fits.argmax(axis=1) if fits.shape[1] else 0, len(names))
            return np.array([*names, None], object)[index]

        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                urls = ["." + h + p for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
                fits = automaton.fits(urls)
                fixed, general = fits[:, :len(ranked)], fits[:, len(ranked):]
                glob = first(general, list(globs))
                verdict = first(fixed, [r.verdict for r in ranked])
                verdict = np.where(verdict == None, np.where(general.any(axis=1), "block", "allow"), verdict)  # noqa: E711
                yield pa.RecordBatch.from_arrays([
                    batch.column("page_id"), batch.column("host"), batch.column("path"),
                    pa.array(first(fixed, [r.name for r in ranked]), pa.string()),
                    pa.array(verdict, pa.string()), pa.array(glob, pa.string()),
                ], names=[f.split()[0] for f in out.split(", ")])

    common.ship(pages.sparkSession)
    return host_and_path(pages).mapInArrow(run, out)


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "pages"))
