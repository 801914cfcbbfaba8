import hashlib
import zlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from agrospark.llm import merkle as M
from tests.llm.brute import lower, sha


def leaf(row, text):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(map(part, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([sha("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
    return out


def climb(node, place, tree):
    """(what a node folds to, its siblings in one text)."""
    proof = ""
    for level in tree[:-1]:
        run = place - place % 8
        others = level[run:run + 8]
        proof += "".join(others[:place - run] + others[place - run + 1:])
        node = sha("".join(others[:place - run] + [node] + others[place - run + 1:]))
        place //= 8
    return node, proof


def plain(rows):
    groups = {}
    for r in rows:
        own = leaf(r, r["text"])
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
        claimed = leaf(r, None if r["text"] is None else lower(r["text"])) if hit else own
        groups.setdefault(r["lang"], []).append((r["doc_id"], own, claimed))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        trees[g] = levels([own for _, own, _ in groups[g]])
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, (doc_id, own, claimed) in enumerate(groups[g]):
            sub, proof = climb(claimed, i, trees[g])
            folded, rest = climb(sub, k, top)
            out.append((doc_id, own, trees[g][-1][0], top[-1][0], sha(proof + rest), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def result(docs):
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return M.check(M.manifest(docs, claimed=F.when(tampered, M.record(text))))


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, g string, node string, at string, root string"


def table(spark, rows):
    return spark.createDataFrame([(d, t, g, s, n, "g", "n", "a", "r") for d, t, g, s, n in rows], SCHEMA)


ROWS = [
    (None, "No id", "en", "s", 5), (3, None, "en", None, None), (3, "Twice", "en", "s", 5), (3, "Twice", "en", "s", 5), (3, "Once", "en", "s", 4),
    (4, "", "", "s", 0), (5, "Lone É", None, "a:b", 6), (6, "x" * 300_000 + "Y", "zh", "s", 1), (-7, "Minus", "en", "s", 5), (8, "\U0001f600 A", "\uffee", "s", 3),
    (9, "B", "\U0001f600", "s", 1), *((100 + i, f"Text {i}", "de", "s", i) for i in range(9)), *((1000 + i, f"Some {i}", "fr", "s", i) for i in range(700)),
]


@pytest.mark.parametrize("block", [1, 2, 4])
def test_manifest_equals_plain_trees(spark, monkeypatch, block):
    """Blocks of eight, 64 and 4096 leaves give the same tree."""
    monkeypatch.setattr(M, "LEVELS", block)
    docs = table(spark, ROWS)
    want = plain([r.asDict() for r in docs.collect()])
    got = sorted((tuple(r) for r in result(docs).collect()), key=str)
    assert got == want
    assert {v for *_, v in want} == {True, False}


def test_empty_and_single(spark):
    assert result(table(spark, [])).count() == 0
    one = result(table(spark, [(1, "x", None, None, None)])).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == sha("") and one.verified


def test_any_change_is_found(spark):
    docs = table(spark, ROWS)
    changed = M.record(F.concat(F.coalesce("text", F.lit("")), F.lit("!")))
    assert M.check(M.manifest(docs, claimed=changed)).where("verified").count() == 0
    assert M.check(M.manifest(docs)).where("not verified").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 700))
def test_streams_of_any_length(n):
    nodes = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    stream = M.Stream()
    for i, node in enumerate(nodes):
        stream.append(node)
        # A witness reaches as far as the runs around it are complete.
        assert len(stream.witnesses[0]) == sum(i + 1 >= 8 ** k for k in range(1, 5))
    root = stream.finish()
    assert root.hex() == levels([x.hex() for x in nodes])[-1][0]
    assert all(M.fold(node, w) == root for node, w in zip(nodes, stream.witnesses))
