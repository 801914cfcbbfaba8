import random

import pytest
from pyspark.sql import functions as F

from agrospark.llm import suffix_repeats as S
from tests.llm import brute
from tests.llm.texts import ROWS


def spans(df):
    return {r[0]: tuple(r)[1:5] for r in df.drop("kept").collect()}


def test_removed_bytes_equal_a_plain_count(spark, documents):
    assert spans(S.remove_repeats(documents(ROWS))) == brute.repeats(ROWS)


def pieces(seed, n_docs):
    """Texts put together from a few blocks, so that repeats begin and end anywhere."""
    rng = random.Random(seed)
    blocks = ["".join(rng.choice("abcd") for _ in range(rng.choice((150, 390, 401, 700)))) for _ in range(6)]
    return [(d, "".join(rng.choice(blocks)[rng.randrange(60):] + "".join(rng.choice("xy") for _ in range(rng.randrange(4)))
                        for _ in range(rng.randrange(1, 6)))) for d in range(n_docs)]


@pytest.mark.parametrize("seed,limit", [(1, 256), (2, 256), (3, 4), (4, 1)])
def test_overlapping_repeats_and_split_groups(spark, documents, seed, limit):
    rows = pieces(seed, 25)
    assert spans(S.remove_repeats(documents(rows), limit=limit)) == brute.repeats(rows)


def ends_of_their_own(n):
    """A passage that n texts hold whole and n more hold ever longer beginnings of, all with other ends."""
    rng = random.Random(7)
    letters = lambda k: "".join(rng.choices("abcd", k=k))
    passage = letters(560)
    return list(enumerate(letters(60) + passage[:k] + letters(60) for k in [560] * n + [410 + 150 * i // n for i in range(n)]))


def test_shared_contents_are_not_multiplied_by_their_repeats(spark, documents):
    rows = {}
    for n in (16, 32):
        docs = documents(ends_of_their_own(n)).select("doc_id", F.xxhash64("text").alias("h"), "text")
        repeats, parts, _ = S.repeat_groups(docs, limit=4)
        rows[n] = sum(t.count() for t in (*repeats, *parts))
    assert rows[32] < 3 * rows[16]  # a row for each class and repeat: 718 and 2682
    few = ends_of_their_own(16)
    assert spans(S.remove_repeats(documents(few), limit=4)) == brute.repeats(few)


def test_chunk_borders_change_nothing(monkeypatch):
    import numpy as np
    data = np.frombuffer(pieces(5, 1)[0][1].encode() * 3, np.uint8)
    offsets = np.array([0, 500, len(data)])
    whole = S.segments_of(data, offsets)
    monkeypatch.setattr(S, "CHUNK", 257)
    parts = S.segments_of(data, offsets)
    starts = lambda f: {(d, s, a) for d, x, y, a in zip(*(c.tolist() for c in f[:4])) for s in range(x, y + 1)}
    assert starts(whole) == starts(parts)


def test_groups_are_maximal_and_complete():
    import numpy as np
    left, middle, right = "L" * 20, "".join(random.Random(1).choices("abc", k=420)), "R" * 30
    texts = [left + middle + right, left + middle + "zz", "q" + middle + right, "w" + middle]
    data = [t.encode() for t in texts]
    rel = [t.index(middle) + 60 for t in texts]
    found = {(tuple(sorted(m)), b, a) for m, b, a in S.maximal_repeats(np.zeros(4, np.int64), data, rel)}
    assert found == {((0, 1, 2, 3), 60, 360), ((0, 1), 80, 360), ((0, 2), 60, 390)}


def test_empty_table_repeated_rows_and_kept_bytes(spark, documents):
    assert S.remove_repeats(documents([])).count() == 0
    text = "é" + "".join(random.Random(3).choices("abc", k=450)) + "tail"
    got = S.remove_repeats(documents([(1, text), (1, text), (None, text[:60]), (None, None)])).collect()
    assert sorted((r.n_removed, r.n_spans, len(r.kept)) for r in got) == [(0, 0, 0), (0, 0, 61), (456, 1, 0), (456, 1, 0)]


def test_intervals():
    assert sorted(S.intervals([0, 3, 5, 5, 2, 0, 4], 2)) == [(2, 0, 4), (3, 0, 3), (4, 5, 6), (5, 1, 3)]
