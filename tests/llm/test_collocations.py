import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from agrospark.llm import collocations as C
from tests.llm.brute import lower
from tests.llm.texts import ROWS, prose


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower(text))]


def plain(rows, least=30, first=2000, longest=4):
    counts = {}
    for lang, text in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for w in pieces(text):
            own.update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        held = {}
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    held[p[i:i + k]] = max(held.get(p[i:i + k], 0), a)
        scored = []
        for p, a in found.items():
            if 100 * held.get(p, 0) >= 80 * a:
                continue
            score, cut = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]], cut))
        for rank, (s, a, p, left, right, cut) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s, cut))
    return sorted(out)


def result(docs, **options):
    return sorted(tuple(r) for r in C.best_phrases(docs, **options).collect())


def some_rows():
    rows = [(r[0], r[1]) for r in ROWS] + [(300 + i, prose(i % 7, 120) + ". Über New York, new york times! " * (i % 5)) for i in range(60)]
    rows += [(900 + i, "a b c d e") for i in range(31)] + [(950 + i, "a b c, b c d\ta\x0bb") for i in range(9)]
    langs = ["en", None, "und", "de", ""]
    return [(i, t, "en" if i >= 900 else langs[i % 5]) for i, t in rows]


@pytest.mark.parametrize("least,block", [(30, 1 << 23), (3, 2000)])
def test_phrases_equal_a_plain_count(spark, documents, least, block):
    rows = some_rows()
    got = result(documents(rows).repartition(3), least=least, block_bytes=block)
    want = plain([(lang, t) for _, t, lang in rows], least)
    assert got == want and len({r[0] for r in want}) == 4
    if least == 30:  # parts of a longer phrase as frequent go, others stay
        phrases = {r[2]: r for r in want if r[0] == "en"}
        assert "a b c d" in phrases and "c d e" not in phrases


def test_first_phrases_per_language(spark, documents):
    rows = some_rows()
    assert result(documents(rows), least=3, first=5, salts=4) == plain([(lang, t) for _, t, lang in rows], 3, 5)


def test_empty(spark, documents):
    assert C.best_phrases(documents([])).count() == 0
    assert C.best_phrases(documents([(1, None), (2, ""), (3, "one two")])).count() == 0


def test_scores_of_large_counts(spark):
    rows = [(2**62, 2**62, 2**63 - 1), (30, 30, 30), (30, 31, 30), (10**13, 10**13 + 1, 3 * 10**13)]
    df = spark.createDataFrame(rows, "a bigint, l bigint, r bigint").select("a", "l", "r", C.score(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert [r.s for r in df.collect()] == [2000000 * a // (b + c) for a, b, c in rows]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aB \t.,\n\x0b\réé", max_size=15), max_size=6), st.integers(0, 3))
def test_words_and_places(texts, skip):
    places, codes, words, owner = C.read_words(pa.array(texts, pa.string())[min(skip, len(texts)):])
    texts = texts[min(skip, len(texts)):]
    want = [(i, j, w) for i, t in enumerate(texts) for j, p in enumerate(pieces(t)) for w in p]
    assert [(o, w) for o, w in zip(owner.tolist(), words.take(pa.array(codes)).to_pylist())] == [(i, w) for i, _, w in want]
    assert (np.diff(places) > 0).all()
    assert (np.diff(places) == 1).tolist() == [a[:2] == b[:2] for a, b in zip(want, want[1:])]
