import numpy as np
import pytest
from pyspark.sql import functions as F

from agrospark.functions import columns as C
from agrospark.operators import drift as D
from tests.conftest import by


def numpy_psi(ref, cur, bins=10):
    edges = np.quantile(ref, np.linspace(0, 1, bins + 1))
    edges[0], edges[-1] = -np.inf, np.inf
    r, c = np.histogram(ref, bins=edges)[0] / len(ref), np.histogram(cur, bins=edges)[0] / len(cur)
    r, c = np.where(r == 0, 1e-6, r), np.where(c == 0, 1e-6, c)
    return float(np.sum((c - r) * np.log(c / r)))


def frame(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


def test_numeric_psi_matches_numpy(spark):
    rng = np.random.default_rng(1)
    ref, cur = rng.normal(0, 1, 700).tolist(), rng.normal(0.4, 1.2, 300).tolist()
    got = D.numeric_psi(frame(spark, ref), frame(spark, cur), ["x"]).first().psi
    assert got == pytest.approx(numpy_psi(ref, cur))
    assert D.numeric_psi(frame(spark, ref), frame(spark, ref), ["x"]).first().psi == pytest.approx(0.0)


def test_small_features_are_not_rounded_away(spark):
    rng = np.random.default_rng(3)
    ref, cur = (1e-12 * rng.uniform(0, 1, 400)).tolist(), (1e-12 * rng.uniform(3, 4, 400)).tolist()
    got = D.numeric_psi(frame(spark, ref), frame(spark, cur), ["x"]).first().psi
    assert got == pytest.approx(numpy_psi(ref, cur)) and got > 1


def test_repeated_edges_and_constant_values(spark):
    ref, cur = [1.0] * 50 + [2.0] * 5, [1.0] * 20 + [2.0] * 20
    got = D.numeric_psi(frame(spark, ref), frame(spark, cur), ["x"]).first().psi
    assert got == pytest.approx(numpy_psi(ref, cur))
    assert D.numeric_psi(frame(spark, [3.0] * 9), frame(spark, [3.0] * 4), ["x"]).first().psi == pytest.approx(0.0)


def test_report_types_missing_rates_and_empty_sides(spark):
    schema = "plot_id long, gdd double, wet boolean, stage string, gone double"
    ref = spark.createDataFrame([(i, float(i % 7), i % 2 == 0, "VE" if i % 3 else None, 1.0) for i in range(60)], schema)
    cur = spark.createDataFrame([(i, float("nan") if i % 2 else 3.0, True, "VT", None) for i in range(20)], schema)
    got = by(D.drift_report(ref, cur), "feature")
    assert set(got) == {"gdd", "wet", "stage", "gone"}
    assert got["wet"]["type"] == "numeric" and got["stage"]["type"] == "categorical"
    assert got["gdd"]["missing_cur"] == pytest.approx(0.5) and got["stage"]["missing_ref"] == pytest.approx(1 / 3)
    assert got["gone"]["psi"] == 0.0 and got["gone"]["missing_cur"] == 1.0
    # A new category against a vanished one: both shares fall back to the floor.
    assert got["stage"]["psi"] == pytest.approx(2 * (1 - 1e-6) * np.log(1e6))
    assert got["stage"]["level"] == "high"
    summary = D.drift_summary(D.drift_report(ref, cur), "2021-10-07").first()
    assert summary.n_features == 4 and summary.alert == "high_drift" and summary.status == "ok"
    top = [r.feature for r in D.top_drift(D.drift_report(ref, cur), 2).collect()]
    assert top[0] == "stage" and len(top) == 2


def test_categorical_only(spark):
    ref = spark.createDataFrame([("a",)] * 6 + [("b",)] * 4, "s string")
    cur = spark.createDataFrame([("a",)] * 5 + [("b",)] * 5, "s string")
    want = (0.5 - 0.6) * np.log(0.5 / 0.6) + (0.5 - 0.4) * np.log(0.5 / 0.4)
    assert D.categorical_psi(ref, cur, ["s"]).first().psi == pytest.approx(want)


def test_levels_at_the_limits(spark):
    df = spark.createDataFrame([(0.25,), (0.1,), (0.0999,)], "p double")
    assert [r[0] for r in df.select(C.drift_level(F.col("p"))).collect()] == ["high", "medium", "low"]


def test_feature_choice(spark):
    df = spark.createDataFrame([], "plot_id long, date date, latitude double, a int, b boolean, c string, d date")
    assert D.choose_features(df) == (["a", "b"], ["c", "d"])


def values(rng, n=6000):
    """Even, tied, skewed and constant features with holes; nine tenths of `skewed` are one value."""
    return [(float(rng.normal()), float(rng.integers(0, 4)), 7.0 if i % 10 else float(rng.normal(7, 3)), 1.0,
             None if i % 3 else float(rng.exponential())) for i in range(n)]


NAMES = ["even", "tied", "skewed", "constant", "holes"]


def want_edges(rows):
    columns = zip(*rows)
    return {n: np.quantile([v for v in c if v is not None], [i / 10 for i in range(1, 10)]).tolist() for n, c in zip(NAMES, columns)}


@pytest.mark.parametrize("whole", [0, 100_000])
def test_edges_from_brackets_are_exact(spark, whole):
    rows = values(np.random.default_rng(7))
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in NAMES)).repartition(7)
    between = D.brackets(D.sketches(df, NAMES), whole=whole)
    got = {r.feature: r.edges for r in D.exact_edges(df, {"ref": df}, NAMES, 10, between=between)[1].collect()}
    for name, edges in want_edges(rows).items():
        assert got[name] == pytest.approx(edges, abs=1e-12), name
    cells = D.counted_cells({"ref": df}, NAMES, between)
    if not whole:  # values outside the brackets are not kept
        assert cells.where("feature = 'even'").count() < 400
    assert cells.where("feature = 'skewed' and value = 7.0").first().ref == 5400


def test_edges_beside_their_brackets_are_found_again(spark):
    rows = values(np.random.default_rng(8), 900)
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in NAMES))
    wrong = D.sketches(df, NAMES).select("feature", F.array_repeat("least", 9).alias("lo"), F.array_repeat("least", 9).alias("hi"))
    assert D.cell_edges(D.counted_cells({"ref": df}, NAMES, wrong), wrong).where("edges is null").count() > 0
    got = {r.feature: r.edges for r in D.exact_edges(df, {"ref": df}, NAMES, 10, between=wrong)[1].collect()}
    for name, edges in want_edges(rows).items():
        assert got[name] == pytest.approx(edges, abs=1e-12), name


def test_sketches_of_days_add_up(spark):
    rng = np.random.default_rng(9)
    days = [values(rng, 2000) for _ in range(4)]
    schema = ", ".join(f"{n} double" for n in NAMES)
    stored = None
    for rows in days[:3]:
        part = D.sketches(spark.createDataFrame(rows, schema), NAMES)
        stored = part if stored is None else stored.unionByName(part)
    ref, cur = spark.createDataFrame(sum(days[:3], []), schema), spark.createDataFrame(days[3], schema)
    merged = D.merged(stored)
    assert by(merged, "feature")["holes"].present == 3 * 667
    key = lambda df: sorted((r.feature, round(r.psi, 12), r.missing_ref) for r in df.collect())
    assert key(D.drift_report(ref, cur, sketch=merged)) == key(D.drift_report(ref, cur))


def test_ranks_are_taken_in_ranges(spark):
    """No window over a feature's cells: they are ordered inside ranges only, which a feature may span."""
    rows = [(float(i),) for i in range(4000)]
    df = spark.createDataFrame(rows, "even double")
    between = D.brackets(D.sketches(df, ["even"]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = D.cell_edges(D.counted_cells({"ref": df}, ["even"], between), between)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert edges.first().edges == pytest.approx([399.9 * i for i in range(1, 10)])
    plan = edges._jdf.queryExecution().executedPlan().toString()
    wide = [w for w in plan.split("\n") if "windowspecdefinition" in w and "slot" in w]
    assert wide and all("_block" in w for w in wide)
