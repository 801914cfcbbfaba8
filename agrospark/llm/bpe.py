"""Byte-pair encoding as a streaming transducer, and decoding as a state machine.

The encoding of a prefix that ends where a token ends is the prefix of the encoding. So it is enough to know, for
every place in a word, the last token of what stands before it: that is the one token that ends there and makes a
pair with the last token before it that merging leaves apart. No token is longer than `lookahead` symbols, hence
whatever follows, the next token to be kept begins at one of the last `lookahead` places. As soon as the paths back
from all of these meet in one place, the tokens up to it are stable; they are emitted and forgotten. Memory does not
grow with the word, however long it is.

Which words there are, which strings are special and how a text is normalised is read from the tokenizer's file.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, types as T

from agrospark.llm import common


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte: itself if it can be seen, else the next free one."""
    seen = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Transducer:
    """Emits the ids of a word's symbols as soon as nothing that may follow can change them."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.names = {i: t for t, i in vocab.items()}
        # How a token is made: the rank of its merge (-1 for a symbol) and the parts.
        self.order = dict.fromkeys(self.names, -1)
        self.left, self.right, self.joins = {}, {}, {}
        for (a, b), rank in self.ranks.items():
            token = vocab[a + b]
            self.order[token], self.left[token], self.right[token] = rank, vocab[a], vocab[b]
            self.joins[vocab[a], vocab[b]] = rank
        #: How far the merge list can look ahead: the length of its longest token.
        self.lookahead = max((len(self._symbols(t)) for t in vocab), default=1)
        self._whole: dict[int, bool] = {}
        self.trie: dict = {}
        for token, i in vocab.items():
            node = self.trie
            for symbol in self._symbols(token):
                node = node.setdefault(symbol, {})
            node[None] = i

    def _symbols(self, token: str) -> list[str]:
        if self.suffix and token.endswith(self.suffix):
            chars = list(token[:-len(self.suffix)])
            return [*chars[:-1], chars[-1] + self.suffix] if chars else [token]
        return list(token)

    def merged(self, symbols: list[str]) -> list[str]:
        """Merging in rank order, leftmost first; used on a token's own symbols."""
        parts, ranks = list(symbols), self.ranks
        while len(parts) > 1:
            best = min((ranks.get(pair, len(ranks)), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if best[0] == len(ranks):
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def whole(self, token: int) -> bool:
        """Whether merging the token's own symbols gives the token."""
        if token not in self._whole:
            self._whole[token] = self.merged(self._symbols(self.names[token])) == [self.names[token]]
        return self._whole[token]

    def apart(self, left: int, right: int) -> bool:
        """Whether merging leaves the two tokens side by side.

        The merges that made them are undone, the later one first. The parts that then meet at the border must have
        no merge of their own that comes before the one undone; of equal ones, the one further left comes first.
        """
        order, limit = self.order, len(self.ranks)
        while True:
            if self.joins.get((left, right), limit) < limit:
                return False
            made, after = order[left], order[right]
            if made > after:
                limit, left = made, self.right[left]
            elif after >= 0:
                limit, right = after + 1, self.left[right]
            else:
                return True

    def __call__(self, symbols: Iterable[str]) -> Iterator[int]:
        reach, trie, whole, apart = self.lookahead, self.trie, self._whole, self.apart
        stream = iter(symbols)
        ahead = next(stream, None)
        # Since the last emission: number of symbols, last token per place, where it begins.
        n, last, back = 0, [-1], [0]
        growing: list[tuple[int, dict]] = []  # places from which a token may still be growing, and how far it is
        while ahead is not None:
            symbol, ahead = ahead, next(stream, None)
            if ahead is None:
                symbol += self.suffix
            growing.append((n, trie))
            growing = [(start, node[symbol]) for start, node in growing if symbol in node]
            n += 1
            for start, node in growing:  # the longest token first
                token = node.get(None)
                if token is not None and (whole[token] if token in whole else self.whole(token)):
                    before = last[start]
                    if before == -1 or apart(before, token):
                        last.append(token)
                        back.append(start)
                        break
            else:
                raise ValueError(f"the vocabulary has no token for {symbol!r}")
            if ahead is not None and n % (2 * reach) == 0:
                meet = self._meeting(back, n - reach + 1, n)
                if meet:
                    yield from self._path(last, back, meet)
                    n, last = n - meet, last[meet:]
                    back = [0, *(b - meet for b in back[meet + 1:])]
                    growing = [(start - meet, node) for start, node in growing if start >= meet]
        yield from self._path(last, back, n)

    @staticmethod
    def _meeting(back: list[int], low: int, high: int) -> int:
        """The last place that the paths back from low..high all pass."""
        places = set(range(max(low, 0), high + 1))
        while len(places) > 1:
            far = max(places)
            places.remove(far)
            places.add(max(back[far], 0))
        return places.pop()

    @staticmethod
    def _path(last: list[int], back: list[int], place: int) -> list[int]:
        tokens = []
        while place > 0:
            tokens.append(last[place])
            place = back[place]
        return tokens[::-1]


class Tokenizer:
    """Texts to ids and back, by a tokenizer's file (NFC, white space and lower case; split by pattern; byte level)."""

    def __init__(self, path: str, limit: int = 500_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.transducer = Transducer(model["vocab"], merges, self.suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = self.transducer.names | {i: t for t, i in self.special.items()}
        self.joined = spec.get("decoder") is None  # such a file's decoder puts blanks between the tokens
        self.alphabet = byte_alphabet()
        self.bytes_of = {c: b for b, c in self.alphabet.items()}
        self._table = str.maketrans({chr(b): c for b, c in self.alphabet.items()})
        self._specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        splits = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self._split = regex.compile(splits[0].replace(r"\s", r"\p{White_Space}"))
        self._known: dict[str, tuple[int, ...]] = {}
        self._written: dict[str, tuple[int, bytes, bytes]] = {}
        self.limit = limit

    def _word(self, word: str) -> tuple[int, ...]:
        ids = self._known.get(word)
        if ids is None:
            symbols = word.encode().decode("latin-1").translate(self._table)
            ids = tuple(self.transducer(symbols))
            if len(word) <= 64 and len(self._known) < self.limit:
                self._known[word] = ids
        return ids

    def encode(self, text: str) -> Iterator[int]:
        """The ids of a text, as they become stable; special strings in it are special tokens."""
        for piece in self._specials.split(text) if self._specials and "<" in text else (text,):
            if piece in self.special:
                yield self.special[piece]
                continue
            if not piece.isascii():
                # Case is changed letter by letter: a sigma at a word's end is like any other.
                piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
            for word in self._split.findall(piece.lower()):
                yield from self._word(word)

    def written(self, chunk: str) -> tuple[int, bytes, bytes]:
        """Number of ids of a chunk, the ids in decimals, and what they decode to."""
        found = self._written.get(chunk)
        if found is None:
            ids = list(self.encode(chunk))
            found = len(ids), " ".join(map(str, ids)).encode(), self.decode(ids).encode()
            if len(self._written) < self.limit and len(chunk) <= 64:
                self._written[chunk] = found
        return found

    def decode(self, ids: Iterable[int]) -> str:
        """What the file's decoder gives for ids, special tokens included."""
        return " ".join(map(self.names.__getitem__, ids)) if self.joined else "".join(self.decoded(ids))

    def decoded(self, ids: Iterable[int], readable: bool = False) -> Iterator[str]:
        """Pieces of text, one id at a time.

        readable: bytes instead of their stand-ins, a blank where a word ends. The state is then the bytes of a
        character that is not complete yet; bytes that are no text give the replacement character.
        """
        if self.joined and not readable:
            for k, i in enumerate(ids):
                yield " " + self.names[i] if k else self.names[i]
            return
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            name = self.names[i]
            ends = bool(self.suffix) and i not in self.special.values() and name.endswith(self.suffix)
            raw = bytes(self.bytes_of[c] for c in (name[:-len(self.suffix)] if ends else name))
            yield machine.decode(raw) + (machine.decode(b"", final=True) + " " if ends else "")
        yield machine.decode(b"", final=True)


@functools.lru_cache(maxsize=2)
def load(name: str) -> Tokenizer:
    """One tokenizer for all tasks of a worker process."""
    return Tokenizer(common.tokenizer_path(name))


def _chunks(tokenizer: Tokenizer, text: pa.Array) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """Texts as runs of distinct chunks between white space (which no token and no special string crosses)."""
    bounds, codes, distinct = common.split_words(text)
    return bounds, codes, [list(tokenizer.encode(chunk)) for chunk in distinct.to_pylist()]


def encode_texts(docs: DataFrame, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """Adds n_tokens and token_ids (array<int>) to all columns of docs, one row for each row.

    A null or empty text has no tokens. Columns of these names that docs has already are replaced. Nothing is
    shuffled; a batch's words are encoded once each.
    """
    keep = [c for c in docs.columns if c not in ("n_tokens", "token_ids")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(tokenizer)
        for batch in (piece for batch in batches for piece in common.slices(batch)):
            bounds, codes, ids = _chunks(model, batch.column("text").cast(pa.string()).fill_null(""))
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            pool = np.fromiter((i for x in ids for i in x), np.int32, int(sizes.sum()))
            starts = np.cumsum(sizes) - sizes
            upto = np.concatenate(([0], np.cumsum(sizes[codes])))[bounds]
            values = pool[common.gather(starts[codes], sizes[codes])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(np.diff(upto), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(values, pa.int32()))],
                names=[*keep, "n_tokens", "token_ids"])

    common.ship(docs.sparkSession)
    schema = docs.select(*keep).schema.add("n_tokens", T.LongType()).add("token_ids", T.ArrayType(T.IntegerType()))
    return docs.select(*keep).mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, tokenizer: str = "word_bpe_49k.json", readable: bool = False) -> DataFrame:
    """doc_id and decoded text of (doc_id, token_ids); null ids give the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(tokenizer)
        for batch in batches:
            texts = ["".join(model.decoded(ids or (), readable)) for ids in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    common.ship(encoded.sparkSession)
    rows = encoded.select("doc_id", "token_ids")
    return rows.mapInArrow(run, rows.select("doc_id").schema.add("text", T.StringType()))


def digests(docs: DataFrame, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by blanks) and decoded_sha256 of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(tokenizer)
        for batch in (piece for batch in batches for piece in common.slices(batch, size=12 << 20)):
            bounds, codes, distinct = common.split_words(batch.column("text"))
            # A decoder that joins tokens has no state but whether it has begun, so chunks are decoded by themselves.
            each = list(map(model.written, distinct.to_pylist()))
            sizes = np.fromiter((x[0] for x in each), np.int64, len(each))
            numbers, decoded = [x[1] for x in each], [x[2] for x in each]
            upto = np.concatenate(([0], np.cumsum(sizes[codes])))[bounds]
            if not sizes.all():  # chunks without a token, as of other white space
                full = sizes[codes] > 0
                bounds = np.concatenate(([0], np.cumsum(full)))[bounds]
                codes = codes[full]
            codes = codes.tolist()
            each = [codes[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.diff(upto), pa.int64()),
                pa.array([hashlib.sha256(b" ".join(map(numbers.__getitem__, c))).hexdigest() for c in each]),
                pa.array([hashlib.sha256(b" ".join(map(decoded.__getitem__, c))).hexdigest() for c in each]),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    common.ship(docs.sparkSession)
    rows = common.texts(docs)
    schema = rows.select("doc_id").schema.add("n_tokens", T.LongType()).add("ids_sha256", T.StringType())
    return rows.mapInArrow(run, schema.add("decoded_sha256", T.StringType()))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.table(spark, sf_dir, "documents"))
