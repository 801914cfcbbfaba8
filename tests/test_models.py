import math

import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from agrospark.operators import models as M
from agrospark.plans import jobs
from tests.conftest import by


@pytest.mark.parametrize("n, test", [(412, 83), (1, 1), (10, 2), (1001, 201)])
def test_split_sizes_are_exact_and_stable(spark, n, test):
    df = spark.range(n)
    got = M.exact_split(df, "id")
    assert got.where("is_test").count() == test and got.count() == n
    again = M.exact_split(df.repartition(7), "id")
    assert {r.id for r in got.where("is_test").collect()} == {r.id for r in again.where("is_test").collect()}


def training(spark, n=300):
    return spark.range(n).select(
        "id", (F.col("id") % 17).cast("double").alias("a"), F.when(F.col("id") % 5 != 0, F.col("id") % 11).cast("double").alias("b"),
        F.when(F.col("id") % 2 == 0, "maize").otherwise("beans").alias("crop"),
        ((F.col("id") % 17) * 10.0 + F.when(F.col("id") % 2 == 0, 50.0).otherwise(0.0)).alias("dry_harvest_kg/ha"))


def test_learners_fit_importance_and_reload(spark, tmp_path):
    rows = training(spark)
    flow = M.pipeline(RandomForestRegressor(numTrees=5, maxDepth=4, seed=1), ["a", "b"], M.TARGET, ["crop"])
    model = flow.fit(rows)
    scored = model.transform(rows)
    top = M.feature_importance(model, scored).collect()
    assert {r.feature for r in top} == {"a", "b", "crop"} and top[0].feature == "a"
    M.save_model(model, str(tmp_path / "m"))
    again = M.load_model(str(tmp_path / "m")).transform(rows)
    assert [r.prediction for r in again.orderBy("id").collect()] == [r.prediction for r in scored.orderBy("id").collect()]


def test_many_categories_and_the_first_registration(spark):
    rows = training(spark, 400).withColumn("crop", F.concat(F.lit("c"), (F.col("id") % 70).cast("string")))
    bins = M.bins_needed(rows, ["crop"])
    assert bins == 71 and M.bins_needed(rows, []) == 32
    flow = M.pipeline(RandomForestRegressor(numTrees=2, maxDepth=3, seed=1), ["a"], M.TARGET, ["crop"], bins)
    assert flow.fit(rows).transform(rows).count() == 400
    with pytest.raises(ValueError):
        M.bins_needed(rows, ["crop"], most=50)
    none = spark.createDataFrame([], "name string, version long, stage string, run_id string")
    first = M.register_version(none, "yield", F.lit("run-1")).first()
    assert (first.version, first.run_id) == (1, "run-1")


def test_a_forest_in_parts_is_the_mean_of_all_its_trees(spark, tmp_path):
    rows = training(spark)
    forest = RandomForestRegressor(numTrees=5, maxDepth=4, minInstancesPerNode=2, seed=1)
    model = M.pipeline(forest, ["a", "b"], M.TARGET, ["crop"], trees_at_once=2).fit(rows)
    parts = [s for s in model.stages if hasattr(s, "trees")]
    assert [p.getNumTrees for p in parts] == [2, 2, 1]
    assert all(p.getMaxDepth() == 4 and p.getMinInstancesPerNode() == 2 for p in parts)
    trees = [t for p in parts for t in p.trees]
    assert len({t.toDebugString.split("\n", 1)[1] for t in trees}) == 5  # each has its own seed
    M.save_model(model, str(tmp_path / "m"))
    for m in (model, M.load_model(str(tmp_path / "m"))):
        for r in m.transform(rows).orderBy("id").limit(20).collect():
            assert r.prediction == pytest.approx(sum(t.predict(r.features) for t in trees) / 5)
    whole = M.pipeline(forest, ["a", "b"], M.TARGET, ["crop"], trees_at_once=5)
    assert whole.getStages()[-1].getNumTrees() == 5


@pytest.mark.parametrize("n, most, least, sizes", [
    (8_000, 500_000, 1_000, 8), (8_000, 400, 100, 24), (3_000, 500_000, 1_000, 3), (0, 500_000, 1_000, 1)])
def test_training_rows_lie_in_even_parts(spark, n, most, least, sizes):
    """Eight cores; all rows come in one part, as a small table is read."""
    rows = spark.range(0, n, 1, 1).withColumn("x", F.col("id") % 7)
    got = M.spread(rows, most, least)
    parts = got.rdd.glom().map(len).collect()
    assert len(parts) == sizes and max(parts) - min(parts) <= 1 + sizes and sum(parts) == n
    assert {r.id for r in got.collect()} == set(range(n))


def test_rows_of_a_part_lie_in_order_and_prepared_rows_give_the_same_trees(spark):
    rows = training(spark, 4_000).withColumn("n", F.col("id").cast("double"))
    train = M.spread(rows, most=300, least=1_000, near=("crop", "a", "b"))
    parts = train.rdd.map(lambda r: (r.crop, r.a, r.b if r.b is not None else -1.0)).glom().collect()
    assert len(parts) == 4 and all(p == sorted(p) for p in parts)
    assert {r.id for r in train.collect()} == set(range(4_000))
    forest = RandomForestRegressor(numTrees=5, maxDepth=4, minInstancesPerNode=2, seed=1)
    flow = M.pipeline(forest, ["a", "b"], M.TARGET, ["crop"], trees_at_once=2)
    models = [flow.fit(train), M.fit_prepared(flow, train)]
    trees = [[t.toDebugString.split("\n", 1)[1] for s in m.stages if hasattr(s, "trees") for t in s.trees] for m in models]
    assert trees[0] == trees[1] and len(trees[0]) == 5 and any("in {" in t for t in trees[0])  # crops stay categories
    first, again = ([r.prediction for r in m.transform(rows).orderBy("id").collect()] for m in models)
    assert first == again


def test_parameter_draws_are_distinct_and_repeatable():
    learner = M.Learner("x", lambda: None, {"numTrees": [1, 2], "maxDepth": [3, 4]})

    class Names:
        def getParam(self, name):
            return name

    first = M.draw_params(learner, Names(), 20, seed=7)
    assert len(first) == 4 and first == M.draw_params(learner, Names(), 20, seed=7)
    spaces = {name: M.LEARNERS[name]().space for name in M.LEARNERS}
    assert spaces["boosted"]["maxIter"][0] == 400 and spaces["boosted"]["maxIter"][-1] == 1500
    assert len(spaces["boosted"]["stepSize"]) == 10 and spaces["forest"]["numTrees"][-1] == 600


def test_train_and_compare(spark):
    table = training(spark).withColumn("wet_harvest_kg/ha", F.lit(1.0))
    assert M.numeric_features(table, drop=(*M.NOT_FEATURES, "id")) == ["a", "b"]
    out = jobs.train_models(
        table, "id", ("boosted", "forest"), features=["a", "b"], categories=["crop"], draws=2, folds=2,
        narrow={"boosted": {"maxIter": [3], "maxDepth": [3]}, "forest": {"numTrees": [4], "maxDepth": [4]}})
    metrics = by(out.metrics, "model")
    assert set(metrics) == {"boosted", "forest", "ensemble"}
    assert metrics["forest"].best_params and metrics["ensemble"].best_params is None
    assert out.predictions.count() == 60 and "pred_ensemble" in out.predictions.columns
    runs = M.run_rows(out.metrics, "2024-01-01")
    assert M.newest_run(runs, "forest").first().metrics["RMSE"] == metrics["forest"].RMSE
    r = out.predictions.first()
    assert r.pred_ensemble == pytest.approx((r.pred_boosted + r.pred_forest) / 2)


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (3.0, 2.0, 3.0), (5.0, 8.0, 5.0)], "actual double, pred_x double, pred_y double")
    got = by(M.evaluate(df), "model")
    assert got["x"].RMSE == pytest.approx(math.sqrt(11 / 3)) and got["x"].MAE == pytest.approx(5 / 3)
    assert got["x"].R2 == pytest.approx(1 - 11 / 8) and got["y"].R2 == pytest.approx(1.0)
    assert M.best_model(M.evaluate(df)).first().best_model == "y"


def test_registry_tables(spark):
    versions = spark.createDataFrame(
        [("m", 1, "Production", 10), ("m", 2, "Staging", 11), ("other", 1, "Production", 12)], "name string, version long, stage string, run_id long")
    added = M.register_version(versions, "m", F.lit(13).cast("long"))
    assert added.where("name = 'm'").agg(F.max("version")).first()[0] == 3
    assert M.register_version(versions, "new", F.lit(1).cast("long")).where("name = 'new'").first().version == 1
    got = {(r.name, r.version): r.stage for r in M.promote(added, "m", 3).collect()}
    assert got == {("m", 1): "Archived", ("m", 2): "Staging", ("m", 3): "Production", ("other", 1): "Production"}
    runs = spark.createDataFrame([(1, "forest_RandomSearch", 5), (2, "forest_RandomSearch", 9), (3, "boosted_RandomSearch", 11)],
                                 "run_id long, run_name string, start_time long")
    assert M.newest_run(runs, "forest").first().run_id == 2 and M.newest_run(runs, "none").count() == 0


def test_batch_scores(spark):
    rows = spark.createDataFrame([(1, "1.239", "Short Rains"), (2, "x", "Short Rains")], "plot_id long, v string, season string")
    scored = M.score_batch(rows, lambda df: df.withColumn("prediction", F.col("v")), "m")
    assert {r.plot_id: r.predicted_yield_kg_per_ha for r in scored.collect()} == {1: 1.24, 2: None}
    assert tuple(M.score_counts(scored).first()) == (2, 1, 1)
