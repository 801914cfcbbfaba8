import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from agrospark.functions import ordering as O
from tests.conftest import by


def test_number_rows_is_global_and_gapless(spark):
    for step in (3, 1_000_003):  # sparse keys make no more blocks than dense ones
        df = spark.range(0, 1000).select(((F.col("id") * 37) % 1000 * step).alias("k"))
        got = O.number_rows(df, F.col("k"), start=0).orderBy("k").collect()
        assert [r.row_id for r in got] == list(range(1000))
    names = spark.range(200).select(F.format_string("https://one.prefix/%05d", "id").alias("k"))
    assert [r.row_id for r in O.number_rows(names, F.col("k")).orderBy("k").collect()] == list(range(1, 201))


PROBS = [i / 10 for i in range(1, 10)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e3, 1e3)), min_size=1, max_size=60))
def test_small_group_quantiles_match_interpolation(spark, values):
    df = spark.createDataFrame([("a", v) for v in values], "k string, v double")
    got = O.exact_quantiles(df, ["k"], "v", PROBS, few_keys=True).collect()
    known = [v for v in values if v is not None]
    if not known:
        assert got == []
        return
    assert got[0].n == len(known)
    assert got[0].quantiles == pytest.approx(list(np.quantile(known, PROBS)), abs=1e-9)


@pytest.mark.parametrize("few_keys", [True, False])
def test_bracketed_quantiles_match_on_large_and_skewed_groups(spark, few_keys):
    # One group holds nearly all rows; accuracy is small so that the brackets are really used.
    big = spark.range(60_000).select(
        F.lit("hot").alias("k"), (F.pmod(F.xxhash64("id"), F.lit(9_973)) * 0.25).alias("v"))
    spiky = spark.range(20_000).select(
        F.lit("spike").alias("k"), F.when(F.col("id") % 3 != 0, 7.0).otherwise(F.col("id") * 0.5).alias("v"))
    small = spark.range(11).select(F.lit("few").alias("k"), F.col("id").cast("double").alias("v"))
    df = big.unionByName(spiky).unionByName(small).repartition(8)
    got = {r.k: r for r in O.exact_quantiles(df, ["k"], "v", PROBS, accuracy=200, few_keys=few_keys).collect()}
    frame = df.toPandas()
    for k, part in frame.groupby("k"):
        assert got[k].n == len(part)
        assert got[k].quantiles == pytest.approx(list(np.quantile(part["v"], PROBS)), abs=1e-9), k


def test_extreme_probabilities(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("v"))
    r = O.exact_quantiles(df, ["k"], "v", [0.0, 0.5, 1.0], accuracy=100).first()
    assert r.quantiles == [0.0, 2499.5, 4999.0]


def test_fill_reads_every_block_once_each_way(spark):
    n = 3000
    known = lambda k: k % 7 == 3 and not 500 <= k < 900
    df = spark.range(n).select(F.col("id").alias("k")).withColumn("first", F.when((F.col("k") % 7 == 3) & ~F.col("k").between(500, 899), F.col("k"))) \
        .withColumn("last", F.col("first") + 10_000)
    out = O.fill_from_neighbours(df, "k", "first", "last", "filled")
    assert "unboundedfollowing" not in out._jdf.queryExecution().optimizedPlan().toString().lower()  # quadratic in a block
    offers = [k for k in range(n) if known(k)]
    got = by(out, "k")
    for k in range(n):
        ahead = next((o for o in offers if o > k), None)
        behind = next((o for o in reversed(offers) if o <= k), None)
        assert got[k].filled == (ahead if ahead is not None else behind + 10_000), k
