"""H: models. Learners run on order totals (target: the order's price) with few trees."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from agrospark.catalog.base import Tables, query
from agrospark.operators import features as X
from agrospark.operators import models as M
from agrospark.plans import jobs
from agrospark.sources import files, registry

NUMBERS = ("items", "quantity", "price_sum", "discount_mean", "plant_month")
CATEGORY = ("o_orderpriority",)
TARGET = "o_totalprice"


def order_rows(t: Tables):
    """One training row per order."""
    items = t.lineitem.groupBy("l_orderkey").agg(
        F.count("*").cast("double").alias("items"), F.sum("l_quantity").alias("quantity"),
        F.sum("l_extendedprice").alias("price_sum"), F.avg("l_discount").alias("discount_mean"))
    orders = t.orders.select("o_orderkey", "o_orderpriority", TARGET, F.month("o_orderdate").cast("double").alias("plant_month"))
    return orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


def split_orders(t: Tables):
    """The rows with their side, stored: learners read them many times."""
    return files.store(M.exact_split(order_rows(t), "o_orderkey"), "split-orders")


def fitted(t: Tables, estimator, categories=(), rows=None) -> tuple[PipelineModel, object]:
    rows = split_orders(t) if rows is None else rows
    train = rows.where(~F.col("is_test"))
    flow = M.pipeline(estimator, NUMBERS, TARGET, categories, M.bins_needed(train, categories))
    return flow.fit(train), rows.where("is_test")


def scored(t: Tables, estimator, categories=()):
    model, test = fitted(t, estimator, categories)
    return model.transform(test).select("o_orderkey", F.col(TARGET).alias("actual"), "prediction")


SPLIT_SQL = """select o_orderkey, row_number() over (order by md5('42:' || o_orderkey), o_orderkey)
 <= ceil((select count(*) from orders) * 0.2::double) as is_test from orders"""


@query("h1_exact_split", "o_orderkey:i is_test:b", SPLIT_SQL)
def _(t):
    return M.exact_split(t.orders.select("o_orderkey"), "o_orderkey")


PREDICTION_SPEC = "o_orderkey:i actual:f prediction:f"


@query("h2_boosted_trees", PREDICTION_SPEC)
def _(t):
    return scored(t, GBTRegressor(maxIter=5, maxDepth=4, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42))


@query("h3_boosted_leafwise", PREDICTION_SPEC)
def _(t):
    return scored(t, GBTRegressor(maxIter=5, maxDepth=5, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42))


@query("h4_boosted_categorical", PREDICTION_SPEC)
def _(t):
    return scored(t, GBTRegressor(maxIter=5, maxDepth=4, stepSize=0.1, seed=42), CATEGORY)


@query("h5_random_forest", PREDICTION_SPEC)
def _(t):
    return scored(t, RandomForestRegressor(numTrees=10, maxDepth=6, minInstancesPerNode=2, seed=42), CATEGORY)


@query("h6_random_search", "model:s RMSE:f MAE:f R2:f")
def _(t):
    rows = M.exact_split(order_rows(t), "o_orderkey")
    learner = M.forest()
    small = M.Learner("forest", learner.make, {**learner.space, "numTrees": [5, 8], "maxDepth": [4, 6]})
    search = M.random_search(rows.where(~F.col("is_test")), small, NUMBERS, TARGET, draws=2)
    test = M.predict_all(rows.where("is_test"), {"forest": search.bestModel}, NUMBERS, TARGET, ensemble=None)
    return M.evaluate(test)


@query("h7_voting_ensemble", "o_orderkey:i actual:f pred_boosted:f pred_forest:f pred_ensemble:f")
def _(t):
    rows = split_orders(t)
    boosted, test = fitted(t, GBTRegressor(maxIter=5, maxDepth=4, seed=42), rows=rows)
    forest, _ = fitted(t, RandomForestRegressor(numTrees=10, maxDepth=6, seed=42), rows=rows)
    return M.predict_all(test, {"boosted": boosted, "forest": forest}, NUMBERS, TARGET)


METRICS = """select model, sqrt(avg(pow(p - actual, 2))) as "RMSE", avg(abs(p - actual)) as "MAE",
 1 - sum(pow(p - actual, 2)) / (var_pop(actual) * count(*)) as "R2" from (select actual, 'a' as model, pred_a as p from scores
 union all select actual, 'b', pred_b from scores) group by model"""


@query("h8_metrics", "model:s RMSE:f MAE:f R2:f", METRICS, ("scores",))
def _(t):
    return M.evaluate(t.scores)


@query("h9_predictions_side_by_side", "row_id:i actual:f pred_a:f pred_b:f pred_mean:f",
       "select row_id, actual, pred_a, pred_b, (pred_a + pred_b) / 2 as pred_mean from scores", ("scores",))
def _(t):
    def echo(column):
        return SQLTransformer(statement=f"SELECT *, {column} AS prediction FROM __THIS__")

    rows = t.scores.withColumnsRenamed({"pred_a": "a_in", "pred_b": "b_in"})
    return M.predict_all(rows, {"a": echo("a_in"), "b": echo("b_in")}, [], "actual", ensemble="mean")


@query("h10_leaderboard", "model:s RMSE:f", METRICS, ("scores",))
def _(t):
    return M.leaderboard(M.evaluate(t.scores))


@query("h10_best_model", "best_model:s RMSE:f", f'select arg_min(model, "RMSE") as best_model, min("RMSE") as "RMSE" from ({METRICS})', ("scores",))
def _(t):
    return M.best_model(M.evaluate(t.scores))


@query("h11_feature_importance", "feature:s importance:f")
def _(t):
    model, test = fitted(t, RandomForestRegressor(numTrees=10, maxDepth=6, seed=42), CATEGORY)
    return M.feature_importance(model, model.transform(test))


@query("h12_save_and_load", PREDICTION_SPEC)
def _(t):
    model, test = fitted(t, RandomForestRegressor(numTrees=5, maxDepth=4, seed=42))
    path = files.scratch_dir(t.spark, "model")
    M.save_model(model, path)
    return M.load_model(path).transform(test).select("o_orderkey", F.col(TARGET).alias("actual"), "prediction")


@query("h12_newest_run", "run_id:i run_name:s start_time:t", """
select arg_max(event_id, (ts, event_id)) as run_id, arg_max(event_type || '_RandomSearch', (ts, event_id)) as run_name,
 max(ts) as start_time from events where event_type like 'purch%'""")
def _(t):
    runs = t.events.select(
        F.col("event_id").alias("run_id"), F.concat("event_type", F.lit("_RandomSearch")).alias("run_name"),
        F.col("ts").alias("start_time"))
    return M.newest_run(runs, "purch")


VERSIONS = "select event_type as name, event_id as version, case event_id % 3 when 0 then 'Production' when 1 then 'Staging' else 'None' end as stage, event_id as run_id from events"


def versions_of(t):
    e = F.col("event_id")
    return t.events.select(
        F.col("event_type").alias("name"), e.alias("version"),
        F.when(e % 3 == 0, "Production").when(e % 3 == 1, "Staging").otherwise("None").alias("stage"), e.alias("run_id"))


@query("h13_promote", "name:s version:i stage:s", f"""
with v as ({VERSIONS}) select name, version, case when name = 'click' and version = (select max(version) from v where name = 'click') then 'Production'
 when name = 'click' and stage = 'Production' then 'Archived' else stage end as stage from v""")
def _(t):
    v = versions_of(t)
    newest = v.where(F.col("name") == "click").agg(F.max("version")).scalar()
    return M.promote(v, "click", newest)


@query("h13_register_first_version", "name:s version:i stage:s run_id:i", "select 'yield' as name, 1 as version, 'None' as stage, count(*) as run_id from events")
def _(t):
    runs = t.events.agg(F.count("*").alias("n")).scalar()
    return M.register_version(versions_of(t).where(F.col("name").isNull()), "yield", runs)


@query("h13_register_version", "name:s version:i stage:s run_id:i", f"""
with v as ({VERSIONS}) select * from v union all select 'click', max(version) + 1, 'None', 7 from v where name = 'click'""")
def _(t):
    return M.register_version(versions_of(t), "click", F.lit(7).cast("long"))


@query("h13_published_versions", "name:s version:i stage:s run_id:s", """
select n.name, v.version, case when v.version = 3 then 'Production' when v.version = 1 then 'Archived' else 'None' end as stage,
 n.name || '-' || v.version as run_id from (select distinct event_type as name from events) n, (select unnest([1, 2, 3]) as version) v""")
def _(t):
    """Three versions of a model for each type of event; the first is in Production until the third is."""
    root = files.scratch_dir(t.spark, "registry")
    for (name,) in t.events.select("event_type").distinct().collect():  # a handful of types
        for n in (1, 2, 3):
            version = registry.register(t.spark, root, name, f"{name}-{n}", f"/models/{name}-{n}", "2024-01-01")
            if n != 2:
                registry.set_stage(t.spark, root, name, version, "Production", "2024-01-01")
    return registry.current_versions(t.spark, root).drop("path")


# Prices follow from quantities in these tables, order totals from nothing: what can be learned is asked for here.
PRICE, PRICE_FROM = "price_sum", ("items", "quantity", "discount_mean", "plant_month")
HOLDS = f"""with s as ({SPLIT_SQL}), p as (select l_orderkey as o_orderkey, sum(l_extendedprice) as price from lineitem group by 1)
select count(*) as test_rows, round(sum(price), 2) as actual, 0 as missing, true as beats_mean from s left join p using (o_orderkey) where is_test"""
HOLDS_SPEC = "test_rows:i actual:f missing:i beats_mean:b"


def price_models(t: Tables, estimators: dict, categories=()):
    rows = files.store(M.exact_split(order_rows(t).drop(TARGET), "o_orderkey"), "split-prices")
    train, test = (M.spread(part, near=(*PRICE_FROM, *categories)) for part in (
        rows.where(~F.col("is_test") & F.col(PRICE).isNotNull()), rows.where("is_test")))
    bins = M.bins_needed(train, categories)
    numbers = M.as_double(train, [*PRICE_FROM, PRICE])
    models = {name: M.fit_prepared(M.pipeline(e, PRICE_FROM, PRICE, categories, bins, trees_at_once=10), numbers)
              for name, e in estimators.items()}
    return M.predict_all(test, models, PRICE_FROM, PRICE)


def holds(predictions, column: str):
    """What can be said of predictions without trees: the rows, the actual values, none missing, and better than the mean."""
    error, known = F.col(column) - F.col("actual"), F.col("actual").isNotNull()
    return predictions.agg(
        F.count("*").alias("test_rows"), F.round(F.sum("actual"), 2).alias("actual"), F.count_if(F.col(column).isNull()).alias("missing"),
        (F.avg(F.when(known, error * error)) < F.var_pop("actual")).alias("beats_mean"))


@query("h2_boosted_holds", HOLDS_SPEC, HOLDS)
def _(t):
    return holds(price_models(t, {"b": GBTRegressor(maxIter=10, maxDepth=4, stepSize=0.3, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42)}), "pred_b")


@query("h5_forest_profile_holds", HOLDS_SPEC, HOLDS)
def _(t):
    """The forest as its profile has it, all trees."""
    return holds(price_models(t, {"forest": M.forest().make()}, CATEGORY), "pred_forest")


@query("h7_four_members_hold", "model:s test_rows:i missing:i beats_mean:b", f"""
with s as ({SPLIT_SQL}) select m.model, count(*) as test_rows, 0 as missing, true as beats_mean
from s, (select unnest([{', '.join(f"'{n}'" for n in M.LEARNERS)}, 'ensemble']) as model) m where is_test group by 1""")
def _(t):
    """All four members of the ensemble, with fewer and larger steps than their profiles, and their mean."""
    def smaller(tree):
        return tree.setMaxIter(10).setStepSize(0.3) if tree.hasParam("maxIter") else tree.setNumTrees(10)

    long = price_models(t, {name: smaller(learner().make()) for name, learner in M.LEARNERS.items()})
    each = None
    for name in (*M.LEARNERS, "ensemble"):
        row = holds(long, f"pred_{name}").select(F.lit(name).alias("model"), "test_rows", "missing", "beats_mean")
        each = row if each is None else each.unionByName(row)
    return each


@query("h11_importances_sum", "features:i total:f4 least_is_positive:b", "select 6 as features, 1.0::double as total, count(*) > 0 as least_is_positive from orders")
def _(t):
    model, test = fitted(t, RandomForestRegressor(numTrees=10, maxDepth=6, seed=42), CATEGORY)
    table = M.feature_importance(model, model.transform(test))
    return table.agg(F.count("*").alias("features"), F.sum("importance").alias("total"), (F.min("importance") >= 0).alias("least_is_positive"))


@query("h12_loaded_model_agrees", "test_rows:i different:i", f"with s as ({SPLIT_SQL}) select count(*) as test_rows, 0 as different from s where is_test")
def _(t):
    """A model that was saved and loaded predicts what the fitted one does."""
    model, test = fitted(t, RandomForestRegressor(numTrees=5, maxDepth=4, seed=42))
    path = files.scratch_dir(t.spark, "model")
    M.save_model(model, path)
    first = model.transform(test).select("o_orderkey", "prediction")
    again = M.load_model(path).transform(test).select("o_orderkey", F.col("prediction").alias("loaded"))
    return first.join(again, "o_orderkey").agg(
        F.count("*").alias("test_rows"), F.count_if(~F.col("prediction").eqNullSafe(F.col("loaded"))).alias("different"))


@query("h14_batch_scoring", "plot_id:i predicted_yield_kg_per_ha:f2 model_name:s", """
select r.plot_id, round(case when f.plot_id is null then 0 + case when coalesce(r.altitude, 0) = 0 then 1200 else r.altitude end
 else f.precip_total end, 2) as predicted_yield_kg_per_ha, 'linear' as model_name from score_requests r
 left join feature_rows f on f.plot_id = r.plot_id""", ("score_requests", "feature_rows"))
def _(t):
    rows = X.features_for_scoring(t.score_requests, t.feature_rows)
    return M.score_batch(rows, linear, "linear")


def linear(df):
    return df.withColumn("prediction", F.col("precip_total") + F.coalesce("altitude", F.lit(0.0)))


@query("h14_score_counts", "total_plots:i successful:i failed:i", """
select count(*) as total_plots, count(*) filter (f.plot_id is null or f.precip_total is not null) as successful,
 count(*) filter (f.plot_id is not null and f.precip_total is null) as failed from score_requests r
 left join feature_rows f on f.plot_id = r.plot_id""", ("score_requests", "feature_rows"))
def _(t):
    rows = X.features_for_scoring(t.score_requests, t.feature_rows)
    return M.score_counts(M.score_batch(rows, linear, "linear"))


@query("h15_route_by_parity", "plot_id:i model_name:s",
       "select plot_id, case when plot_id % 2 = 0 then 'ensemble' else 'challenger' end as model_name from score_requests", ("score_requests",))
def _(t):
    return M.route_by_parity(t.score_requests, "ensemble", "challenger")


@query("h15_shadow_difference", "compared:i mean_difference:f4 mean_abs_difference:f4 max_abs_difference:f4", """
select count(*) as compared, avg(pred_b - pred_a) as mean_difference, avg(abs(pred_b - pred_a)) as mean_abs_difference,
 max(abs(pred_b - pred_a)) as max_abs_difference from scores""", ("scores",))
def _(t):
    return M.shadow_difference(t.scores, "pred_a", "pred_b")


@query("h_train_and_compare", "model:s RMSE:f MAE:f R2:f best_params:s")
def _(t):
    small = {"maxIter": [3, 5], "maxDepth": [3, 4]}
    trained = jobs.train_models(
        order_rows(t), "o_orderkey", ("boosted", "forest"), TARGET, NUMBERS, draws=2, folds=2,
        narrow={"boosted": small, "forest": {"numTrees": [4, 6], "maxDepth": [3, 4]}})
    return trained.metrics
