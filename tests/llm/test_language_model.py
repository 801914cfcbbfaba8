import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from agrospark.llm import lm_scoring as L
from tests.llm import brute
from tests.llm.texts import ROWS


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def tokens(text):
    return [*brute.words(brute.lower(text)), "\n"]


def plain(rows, weights):
    """Scores by counting, with given mixture weights."""
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    one, two = Counter(), Counter()
    for d, t in rows:
        if not held[d]:
            w = tokens(t)
            one.update(w)
            two.update(zip(["\n", *w], w))
    n, v = sum(one.values()), len(one)
    out = []
    for d, t in rows:
        w = tokens(t)
        base = sum(math.log10((one[x] + 1) / (n + v + 1)) for x in w)
        score = 0
        for a, b in zip(["\n", *w], w):
            k = weights[min(int(math.log2(one[a])) + 1 if one[a] else 0, len(weights) - 1)]
            score += math.log10(k[0] * (two[a, b] / one[a] if one[a] else 0) + k[1] * one[b] / max(n, 1) + k[2] / (v + 1))
        out.append((d, held[d], len(w), sum(one[x] > 0 for x in w), n, base, score))
    return out


def check(spark, documents, rows):
    known = L.known_counts(documents(rows), held_out())
    model = L.learn(known)
    got = sorted(map(tuple, L.score(known, model).collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    want = sorted(plain(rows, model.weights), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    np.testing.assert_allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9, atol=1e-9)
    return model, got


def test_scores_equal_a_plain_count(spark, documents):
    check(spark, documents, ROWS)


def test_several_blocks_give_the_same(spark, documents, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_BYTES", 20_000)
    check(spark, documents, ROWS + [(None, "the of a"), (None, "the of a"), (5, ROWS[4][1])])


def test_nothing_to_learn_from(spark, documents):
    only_held = [(d, "a b") for d in range(60) if zlib.crc32(str(d).encode()) % 7 == 2]
    _, got = check(spark, documents, only_held)
    assert all(g[5:] == (0.0, 0.0) for g in got)
    assert L.score_documents(documents([]), held_out()).count() == 0


def test_the_mixture_is_a_distribution_and_beats_the_base(spark, documents):
    rows = [(i, " ".join("abcdefgh"[(i * k + k * k) % (3 + k % 3)] for k in range(80))) for i in range(60)]
    model, got = check(spark, documents, rows)
    np.testing.assert_allclose(model.weights.sum(axis=1), 1)
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)


def test_weights_maximise_the_likelihood():
    cells = np.array([[3.0, 3], [900, 100], [-1.0, np.nan], [4.0, 5.0]])
    w = L.learn_weights(cells, 10_000, 99)[3]

    def loss(w):
        first = w[0] * 0.5 + w[1] * 16 / 10_000 + w[2] / 100
        return 900 * math.log(first) + 100 * math.log(w[1] * 32 / 10_000 + w[2] / 100)

    for other in ([0.8, 0.1, 0.1], [0.95, 0.0, 0.05], [0.5, 0.25, 0.25], [0.88, 0.02, 0.1]):
        assert loss(w) >= loss(other) - 1e-6
