import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.llm import brute
from tests.llm.test_filters import plain_overlaps

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(name, rows that went in, rows that came out) of each stage over the smallest tables."""
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF).cache()
        seen.append((name, docs, out))
        docs = out
    return {name: (a, b) for name, a, b in seen}


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_all_stages_but_the_last_return_documents(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [out.columns == columns for _, out in stages.values()] == [True] * 4 + [False]


def test_quality_stage(stages):
    before, after = stages["quality_rules"]
    left = {d for d, _ in rows(after)}
    failed = {d for d, t in rows(before) if brute.quality(t)[-1]}
    assert not left & failed and len(left) > 0.8 * (before.count() - len(failed))


def test_line_stage_keeps_every_document(stages):
    before, after = (dict(rows(df)) for df in stages["line_dedup"])
    assert before.keys() == after.keys()
    for d, text in after.items():
        lines = iter(before[d].split("\n"))
        assert all(line in lines for line in text.split("\n")) or text == ""


def test_near_dedup_stage(stages):
    before, after = stages["near_dedup"]
    assert {d for d, _ in rows(after)} == {d for d, (_, _, kept) in brute.near(rows(before), 80, 5).items() if kept}


def test_decontamination_stage(spark, stages):
    before, after = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = {d for d, _ in plain_overlaps(rows(before), items)}
    assert found and {d for d, _ in rows(after)} == {d for d, _ in rows(before)} - found


def test_encoding_stage(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    _, after = stages["encoding"]
    for r in after.collect():
        assert r.token_ids == library.encode(r.text, add_special_tokens=False).ids


def test_run_applies_all_stages(spark, stages):
    got = P.run(spark, SF)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages["encoding"][1].collect()))
