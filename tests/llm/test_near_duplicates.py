import random

import pytest

from agrospark.llm import minhash as M
from tests.llm import brute
from tests.llm.texts import BASE, ROWS, changed, prose


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_components_equal_those_of_all_pairs(spark, documents, size, percent):
    rows = ROWS + [(100 + i, changed(BASE, i, 3 + i % 9)) for i in range(25)] + [(200 + i, prose(50 + i // 3, 80)) for i in range(9)]
    assert result(M.near_duplicates(documents(rows), size, percent)) == brute.near(rows, percent, size)


def test_mixed_buckets_are_joined_exactly(spark, documents):
    # Texts that share much but too little to be linked, and some that are linked among them.
    rows = [(i, changed(BASE, i, 25)) for i in range(30)] + [(50 + i, changed(changed(BASE, i, 25), 99 + i, 1)) for i in range(5)]
    want = brute.near(rows)
    assert 25 <= sum(kept for _, _, kept in want.values()) < 35
    assert result(M.near_duplicates(documents(rows), 3, 85)) == want


def test_chains_and_missing_ids(spark, documents):
    chain, text = [], prose(70, 200)
    for i in range(12):
        chain.append((40 - i, text))
        text = changed(text, i, 4)
    got = result(M.near_duplicates(documents(chain), 3, 85))
    assert got == brute.near(chain)
    rows = M.near_duplicates(documents([(None, BASE), (None, BASE), (7, BASE), (7, BASE), (8, BASE)]), 3, 85).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in rows if r.doc_id) == [(7, 7, True), (7, 7, True), (8, 7, False)]
    assert all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    assert M.near_duplicates(documents([])).count() == 0


def test_star_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in M.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_rows_that_stay_have_their_columns(spark, documents):
    docs = documents([(1, BASE), (2, BASE), (3, None)])
    left = M.drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 3]
