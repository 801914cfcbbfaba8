"""Yield regressors with Spark ML: exact split, random search, comparison, registry tables, scoring."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from agrospark import schemas as S
from agrospark.functions import columns as C
from agrospark.sources.files import cut_lineage, store

TARGET = "dry_harvest_kg/ha"
# Identifiers and the near copy of the target stay out of the features.
NOT_FEATURES = ("plot_id", "Planting_Date", "planting_date", "VT", "match_tier", "wet_harvest_kg/ha")


# --- split ---------------------------------------------------------------------------------

def exact_split(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds `is_test`: exactly ceil(share * n) rows, the ones with the least hash of seed and key.

    `key` identifies a row. Hashes spread evenly over 65,536 prefixes, whose counts decide every
    prefix but the one the cut falls into; only that one is sorted.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    hashed = df.withColumn("_hash", digest).withColumn("_prefix", F.substring("_hash", 1, 4))
    sizes = hashed.groupBy("_prefix").agg(F.count("*").alias("_rows"))
    whole = W.partitionBy()
    upto = W.orderBy("_prefix").rowsBetween(W.unboundedPreceding, 0)
    # At most 65,536 rows by construction of the prefix.
    cut = sizes.select(
        "_prefix", "_rows", F.sum("_rows").over(upto).alias("_upto"),
        F.ceil(F.sum("_rows").over(whole) * F.lit(test_share)).alias("_wanted"))
    decided = hashed.join(F.broadcast(cut), "_prefix").withColumn(
        "_inside", F.when(F.col("_upto") <= F.col("_wanted"), True)
        .when(F.col("_upto") - F.col("_rows") >= F.col("_wanted"), False))
    helpers = ["_hash", "_prefix", "_rows", "_upto", "_wanted", "_inside"]
    plain = decided.where(F.col("_inside").isNotNull()).withColumn("is_test", F.col("_inside"))
    place = F.row_number().over(W.partitionBy("_prefix").orderBy("_hash", key))
    border = decided.where(F.col("_inside").isNull()).withColumn(
        "is_test", place <= F.col("_wanted") - (F.col("_upto") - F.col("_rows")))
    return plain.drop(*helpers).unionByName(border.drop(*helpers))


# --- learners ------------------------------------------------------------------------------

@dataclass(frozen=True)
class Learner:
    """A regressor with its default and its search space (parameter name -> values)."""

    name: str
    make: Callable[[], Estimator]
    space: dict[str, Sequence] = field(default_factory=dict)


def _steps(low: float, high: float, n: int) -> list[float]:
    return [round(low + i * (high - low) / (n - 1), 6) for i in range(n)]


# The defaults and search ranges of the four profiles.

def boosted() -> Learner:
    """Boosted trees with row and column sampling."""
    return Learner(
        "boosted",
        lambda: GBTRegressor(maxIter=600, stepSize=0.05, maxDepth=8, subsamplingRate=0.8,
                             featureSubsetStrategy="0.8", seed=42),
        {
            "maxIter": list(range(400, 1501, 100)),
            "stepSize": _steps(0.01, 0.2, 10),
            "maxDepth": list(range(4, 13)),
            "subsamplingRate": _steps(0.6, 1.0, 9),
            "featureSubsetStrategy": [str(v) for v in _steps(0.6, 1.0, 9)],
        },
    )


def boosted_leafwise() -> Learner:
    """The second boosted profile. Spark grows trees level by level: the leaf count the search
    space is stated in becomes the depth that holds as many leaves."""
    return Learner(
        "boosted_leafwise",
        lambda: GBTRegressor(maxIter=600, stepSize=0.05, maxDepth=5, subsamplingRate=0.8,
                             featureSubsetStrategy="0.8", seed=42),
        {
            "maxIter": list(range(400, 1501, 100)),
            "stepSize": _steps(0.01, 0.2, 10),
            "maxDepth": list(range(5, 9)),
            "subsamplingRate": _steps(0.6, 1.0, 9),
            "featureSubsetStrategy": [str(v) for v in _steps(0.6, 1.0, 9)],
        },
    )


def boosted_categorical() -> Learner:
    """Boosted trees meant for a pipeline whose category codes are marked as categorical."""
    return Learner(
        "boosted_categorical",
        lambda: GBTRegressor(maxIter=1000, stepSize=0.03, maxDepth=6, seed=42),
        {
            "maxDepth": list(range(4, 11)),
            "stepSize": _steps(0.01, 0.2, 10),
            "maxIter": list(range(500, 2001, 250)),
        },
    )


def forest() -> Learner:
    return Learner(
        "forest",
        lambda: RandomForestRegressor(numTrees=100, maxDepth=10, minInstancesPerNode=2, seed=42),
        {
            "numTrees": list(range(100, 601, 50)),
            "maxDepth": [*range(6, 15), 30],
            "minInstancesPerNode": list(range(1, 6)),
            "featureSubsetStrategy": ["sqrt", "log2", "0.5", "0.7", "all"],
        },
    )


LEARNERS: dict[str, Callable[[], Learner]] = {
    "boosted": boosted,
    "boosted_leafwise": boosted_leafwise,
    "boosted_categorical": boosted_categorical,
    "forest": forest,
}


def numeric_features(df: DataFrame, target: str = TARGET, drop: Sequence[str] = NOT_FEATURES) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name != target and f.name not in drop
    ]


def training_rows(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows with a target."""
    return df.where(F.col(f"`{target}`").isNotNull())


def spread(rows: DataFrame, most: int = 500_000, least: int = 5_000, near: Sequence[str] = ()) -> DataFrame:
    """The rows stored in even parts, at most `most` to a part, as many to each core; few rows use fewer cores.

    Trees are fitted in many passes over the same parts, each as long as its longest task; so is a forest's prediction.
    A part's rows lie in order of the columns `near`: with features there, rows that follow each other are in the same
    nodes of a tree mostly, and a pass finds the counts of these nodes where it just was, however many nodes there are.
    """
    stored = store(rows, "even-rows")
    n, cores = stored.count(), rows.sparkSession.sparkContext.defaultParallelism
    parts = min(cores * max(1, math.ceil(n / (cores * most))), max(1, math.ceil(n / least)))
    even = stored.repartition(parts)
    return cut_lineage(even.sortWithinPartitions(*[F.col(f"`{c}`") for c in near]) if near else even)


def forest_parts(forest: RandomForestRegressor, at_once: int) -> list[RandomForestRegressor]:
    """The forest as smaller ones of at most `at_once` trees, each with its own seed; `forest_mean` joins them.

    For every row Spark holds a weight for each tree of a fit, and passes get slower the more trees they switch between.
    With few trees at once their nodes can be held too, so that no pass walks rows down from the root. Without
    checkpoints of them, a lost part is worked out again from its rows.
    """
    trees = forest.getNumTrees()
    sizes = [min(at_once, trees - a) for a in range(0, trees, at_once)]
    # Spark seeds the weights of part i of the rows with seed + i, so that seeds lie far apart.
    return [
        forest.copy().setNumTrees(n).setSeed(forest.getSeed() + i * 1_000_003).setPredictionCol(f"prediction_{i}")
        .setCacheNodeIds(True).setCheckpointInterval(-1)
        for i, n in enumerate(sizes)]


def forest_mean(parts: Sequence[RandomForestRegressor]) -> SQLTransformer:
    """`prediction`: the mean over the trees of all parts."""
    total = " + ".join(f"{p.getPredictionCol()} * {p.getNumTrees()}" for p in parts)
    return SQLTransformer(statement=f"SELECT *, ({total}) / {sum(p.getNumTrees() for p in parts)} AS prediction FROM __THIS__")


def pipeline(
    estimator: Estimator, features: Sequence[str], target: str, categories: Sequence[str] = (), bins: int = 32,
    trees_at_once: int | None = None,
) -> Pipeline:
    """Impute, index categories, assemble, fit; StringIndexer metadata marks codes as categorical.

    A tree needs a bin for every category: pass `bins_needed` of the training rows. With `trees_at_once`, a forest of
    more trees is fitted in parts, for tables whose rows and trees do not fit into memory together.
    """
    filled = [f"{c}__filled" for c in features]
    coded = [f"{c}__code" for c in categories]
    stages: list = [Imputer(inputCols=list(features), outputCols=filled, strategy="mean")]
    if categories:
        stages.append(StringIndexer(
            inputCols=list(categories), outputCols=coded, stringOrderType="alphabetAsc", handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=filled + coded, outputCol="features", handleInvalid="keep"))
    tree = estimator.copy().setFeaturesCol("features").setLabelCol(target)
    tree = tree.setMaxBins(max(bins, tree.getMaxBins())) if categories else tree
    if trees_at_once and isinstance(tree, RandomForestRegressor) and tree.getNumTrees() > trees_at_once:
        parts = forest_parts(tree, trees_at_once)
        return Pipeline(stages=[*stages, *parts, forest_mean(parts)])
    return Pipeline(stages=[*stages, tree])


def fit_prepared(flow: Pipeline, rows: DataFrame) -> PipelineModel:
    """`flow.fit(rows)`, with the rows as the learners take them stored: each reads them several times.

    They lie in the same parts and order as the rows.
    """
    stages = flow.getStages()
    first = next(i for i, s in enumerate(stages) if hasattr(s, "getLabelCol"))
    ready = Pipeline(stages=stages[:first]).fit(rows)
    prepared = cut_lineage(ready.transform(rows).select("features", F.col(f"`{stages[first].getLabelCol()}`")))
    return PipelineModel([*ready.stages, *[s.fit(prepared) if isinstance(s, Estimator) else s for s in stages[first:]]])


def bins_needed(rows: DataFrame, categories: Sequence[str], most: int = 10_000) -> int:
    """Bins for the column with the most categories and its unknown ones; beyond `most` it is no category."""
    if not categories:
        return 32
    counts = rows.agg(*[F.count_distinct(f"`{c}`").alias(c) for c in categories]).first()
    wide = {c: counts[c] for c in categories if counts[c] > most}
    if wide:
        raise ValueError(f"too many categories for a tree: {wide}")
    return max(32, max(counts) + 1)


def as_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in columns})


def draw_params(learner: Learner, estimator: Estimator, draws: int, seed: int = 42) -> list[dict]:
    """Distinct random points of the search space as ParamMaps; all points of a space that has no more."""
    rng = random.Random(seed)
    seen: dict[tuple, dict] = {}
    points = math.prod(len({str(v) for v in values}) for values in learner.space.values()) if learner.space else 0
    while len(seen) < min(draws, points):
        point = {name: rng.choice(list(values)) for name, values in learner.space.items()}
        key = tuple(sorted((k, str(v)) for k, v in point.items()))
        seen.setdefault(key, {estimator.getParam(k): v for k, v in point.items()})
    return list(seen.values())


def random_search(
    train: DataFrame, learner: Learner, features: Sequence[str], target: str = TARGET,
    categories: Sequence[str] = (), draws: int = 20, folds: int = 3, parallelism: int = 4, seed: int = 42,
) -> CrossValidatorModel:
    """Random draws of the space, k folds, least mean RMSE; the winner is refitted on all rows."""
    estimator = learner.make()
    flow = pipeline(estimator, features, target, categories, bins_needed(train, categories))
    tree = flow.getStages()[-1]
    grid = draw_params(learner, tree, draws, seed) or ParamGridBuilder().build()
    search = CrossValidator(
        estimator=flow, estimatorParamMaps=grid, numFolds=folds, parallelism=parallelism, seed=seed,
        evaluator=RegressionEvaluator(labelCol=target, metricName="rmse"))
    return search.fit(as_double(train, [*features, target]))


def best_params(search: CrossValidatorModel) -> dict[str, object]:
    scores = search.avgMetrics
    winner = search.getEstimatorParamMaps()[scores.index(min(scores))]
    return {param.name: value for param, value in winner.items()}


def predict_all(
    df: DataFrame, models: dict[str, PipelineModel], features: Sequence[str], target: str = TARGET,
    ensemble: str | None = "ensemble",
) -> DataFrame:
    """`actual` and one `pred_<model>` per model; the ensemble is their equal-weight mean."""
    out = as_double(df, [*features, *([target] if target in df.columns else [])])
    keep = list(df.columns)
    for name, model in models.items():
        scored = model.transform(out)
        out = scored.withColumnRenamed("prediction", f"pred_{name}").select(*[f"`{c}`" for c in keep], f"pred_{name}")
        keep.append(f"pred_{name}")
    if ensemble:
        total = sum((F.col(f"pred_{m}") for m in list(models)[1:]), F.col(f"pred_{next(iter(models))}"))
        out = out.withColumn(f"pred_{ensemble}", total / len(models))
    return out.withColumnRenamed(target, "actual") if target in df.columns else out


# --- evaluation ----------------------------------------------------------------------------

def evaluate(predictions: DataFrame, actual: str = "actual", prefix: str = "pred_") -> DataFrame:
    """RMSE, MAE and R2 of every prediction column, in one pass over the rows."""
    columns = [c for c in predictions.columns if c.startswith(prefix)]
    long = predictions.unpivot(actual, columns, "model", "prediction").where(
        F.col(actual).isNotNull() & F.col("prediction").isNotNull())
    error = F.col("prediction") - F.col(actual)
    return long.groupBy("model").agg(
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        F.avg(F.abs(error)).alias("MAE"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(actual))).alias("R2"),
    ).withColumn("model", F.substr("model", F.lit(len(prefix) + 1)))


def leaderboard(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("RMSE", "model")


def best_model(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.min_by("model", F.struct("RMSE", "model")).alias("best_model"), F.min("RMSE").alias("RMSE"))


def feature_importance(model: PipelineModel, scored: DataFrame, n: int = 20) -> DataFrame:
    """The n most important inputs of a fitted tree model, by name."""
    attrs = scored.schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    weights = model.stages[-1].featureImportances
    rows = [(names[i].removesuffix("__filled").removesuffix("__code"), float(w)) for i, w in enumerate(weights.toArray())]
    table = scored.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(n)


# --- runs, versions, scoring ---------------------------------------------------------------

def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def run_rows(metrics: DataFrame, day: str, suffix: str = "_RandomSearch") -> DataFrame:
    """Rows of the `model_runs` table from a comparison: name, parameters, metrics and start."""
    scores = F.create_map(*[x for m in ("RMSE", "MAE", "R2") for x in (F.lit(m), F.col(m))])
    return metrics.select(
        F.concat_ws("-", "model", F.lit(day)).alias("run_id"), F.concat("model", F.lit(suffix)).alias("run_name"),
        F.col("best_params").alias("params"), scores.alias("metrics"), F.lit(day).cast("timestamp_ntz").alias("start_time"))


def newest_run(runs: DataFrame, prefix: str) -> DataFrame:
    """The latest started run whose name begins with the prefix."""
    others = [c for c in runs.columns]
    return (
        runs.where(F.col("run_name").startswith(prefix))
        .agg(F.max_by(F.struct(*others), F.struct("start_time", "run_id")).alias("run"))
        .where(F.col("run").isNotNull()).select("run.*")
    )


def register_version(versions: DataFrame, name: str, run_id: Column) -> DataFrame:
    """The versions with one more of the model, numbered after its highest; `run_id` is a constant."""
    added = versions.agg(
        F.lit(name).alias("name"),
        (F.coalesce(F.max(F.when(F.col("name") == name, F.col("version"))), F.lit(0)) + 1).alias("version"),
        F.lit("None").alias("stage"),
    ).withColumn("run_id", run_id)
    return versions.unionByName(added)


def promote(versions: DataFrame, name: str, version: Column | int, stage: str = "Production") -> DataFrame:
    """Give one version the stage; other Production versions of the model become Archived."""
    same = F.col("name") == name
    chosen = same & (F.col("version") == version)
    return versions.withColumn("stage", F.when(chosen, stage).when(
        same & (F.col("stage") == "Production"), "Archived").otherwise(F.col("stage")))


def scoring_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in S.SCORING_DROPPED]


def as_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text features as numbers, unreadable text NULL."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: C.to_number(F.col(c)) for c in texts})


def score_batch(rows: DataFrame, predict: Callable[[DataFrame], DataFrame], model: str) -> DataFrame:
    """Predictions per plot, rounded to 2 places; `predict` adds a `prediction` column."""
    ready = as_numeric(rows, scoring_columns(rows))
    scored = predict(ready)
    return scored.select(
        "plot_id", F.round("prediction", 2).alias("predicted_yield_kg_per_ha"), F.lit(model).alias("model_name"))


def score_counts(scored: DataFrame) -> DataFrame:
    value = F.col("predicted_yield_kg_per_ha")
    return scored.agg(
        F.count("*").alias("total_plots"),
        F.count_if(value.isNotNull()).alias("successful"),
        F.count_if(value.isNull()).alias("failed"),
    )


def route_by_parity(df: DataFrame, even: str, odd: str) -> DataFrame:
    """A/B test: even plot ids go to one model, odd ones to the other."""
    return df.withColumn("model_name", F.when(F.col("plot_id") % 2 == 0, even).otherwise(odd))


def shadow_difference(scored: DataFrame, live: str, shadow: str) -> DataFrame:
    """How far the shadow model is from the live one."""
    gap = F.col(shadow) - F.col(live)
    return scored.agg(
        F.count(gap).alias("compared"), F.avg(gap).alias("mean_difference"),
        F.avg(F.abs(gap)).alias("mean_abs_difference"), F.max(F.abs(gap)).alias("max_abs_difference"))
