"""The daily and weekly runs: stages, satellite samples, features, training, scoring, drift."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from agrospark.functions import columns as C
from agrospark.operators import drift as D
from agrospark.operators import features as X
from agrospark.operators import indices as I
from agrospark.operators import models as M
from agrospark.operators import normalize as N
from agrospark.operators import phenology as P
from agrospark.operators import quality as Q
from agrospark.operators import training_set as G
from agrospark.sources import files, payload, registry, snapshots
from agrospark.streaming import intake


@dataclass(frozen=True)
class Tables:
    """Folders of the dated tables under one root.

    With `buckets`, weather, planting dates, stages, samples and daily features are placed by plot in that many files a
    day, and the runs between them do not shuffle weather or daily rows again.
    """

    root: str
    buckets: int | None = None

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def store(
    spark: SparkSession, tables: Tables, name: str, df: DataFrame, day: str | dt.date, cluster: Sequence[str] = (),
    date: str | None = None, keyed: bool = False, placed: bool = False,
) -> DataFrame:
    """Write the day of a table, and its profile from what the write has counted.

    `keyed`: a row per plot; `placed`: in the buckets of `tables`, if it has any, by plot.
    """
    metrics = Q.table_metrics(df.drop(snapshots.DAY), date)
    if keyed:
        metrics |= {"plot_count": F.count("plot_id"), "duplicate_count": F.lit(0) * F.count(F.lit(1))}
    buckets = tables.buckets if placed else None
    seen = snapshots.write_snapshot(df, tables.path(name), day, ["plot_id"] if buckets else cluster, metrics, buckets)
    store_profile(spark, tables, name, df.drop(snapshots.DAY).columns, seen, day)
    return snapshots.read_snapshot(spark, tables.path(name), day)


def store_profile(spark: SparkSession, tables: Tables, name: str, columns: Sequence[str], seen: dict, day: str | dt.date) -> None:
    """One row per stored table and day; a table that is written again replaces its own."""
    row = spark.createDataFrame([Q.profile_row(name, columns, seen)], Q.PROFILE)
    row.withColumn(snapshots.DAY, F.lit(str(day)).cast("date")).coalesce(1).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(snapshots.DAY, "table").parquet(tables.path("profiles"))


def plot_list(spark: SparkSession, tables: Tables, source: str | DataFrame, day: str | dt.date) -> tuple[DataFrame, DataFrame]:
    """A plot list as it is kept (a table, or the path of a CSV) to one clean row per plot; rows that break a rule go, with
    their reasons, to `rejected_plots`."""
    raw = files.read_plots(spark, source) if isinstance(source, str) else source
    checked = files.store(N.validate_plots(N.load_plots(raw)), "plots")
    good, bad = N.split_valid(checked)
    plots = store(spark, tables, "plots", good, day, keyed=True)
    return plots, store(spark, tables, "rejected_plots", bad, day)


def payloads_to_weather(
    spark: SparkSession, tables: Tables, landing: str, day: str | dt.date
) -> tuple[DataFrame, DataFrame]:
    """Landed payload documents to gated weather, without a stream.

    Days and documents that cannot be used are stored with their reasons; of repeated days `unique_days` keeps one.
    """
    days = files.store(intake.weather_days(payload.read_payloads(spark, landing)), "payload-days")
    good = F.size("reasons") == 0
    rejects = store(spark, tables, "rejected_weather", days.where(~good), day)
    snapshots.write_snapshot(days.where(good).drop("reasons", "unread"), tables.path("raw_weather"), day, ["plot_id"],
                             buckets=tables.buckets)
    return validate_weather(spark, tables, day), rejects


def season_table(
    spark: SparkSession, tables: Tables, harvest: DataFrame, plots: DataFrame, day: str | dt.date
) -> DataFrame:
    """The training set of whole seasons: season summary of the validated weather, yields of the harvest sheet and index
    totals of the stored samples, a row per plot and harvest."""
    weather = snapshots.read_first_weather(spark, tables.path("validated_weather"), tables.path("raw_weather"), day)
    samples = snapshots.read_latest(spark, tables.path("satellite_indices"), day)
    if weather is None or samples is None:
        raise FileNotFoundError("weather and satellite samples are needed")
    labels = G.tidy_keys(G.yield_labels(harvest)).withColumn("plot_id", C.to_long(F.col("plot_id")))
    summary = P.season_summary_from_weather(weather.drop(snapshots.DAY), plots)
    table = X.yield_table(summary, labels, X.index_totals(samples.drop(snapshots.DAY)))
    return store(spark, tables, "season_table", table, day, date="planting_date")


def validate_weather(spark: SparkSession, tables: Tables, day: str | dt.date) -> DataFrame:
    """Raw weather to validated weather: one read of the raw day counts everything that gate and profile need while a
    staged copy is written; the copy is published if the gate holds, else the counts are raised."""
    raw = snapshots.read_snapshot(spark, tables.path("raw_weather"), day).drop(snapshots.DAY)
    staged = tables.path("staged_weather")
    seen = snapshots.write_snapshot(
        Q.counted_days(raw), staged, day, ["plot_id"] if tables.buckets else (), Q.gate_metrics(raw.columns), tables.buckets)
    store_profile(spark, tables, "raw_weather", raw.columns, seen, day)
    try:
        Q.check_gate(seen)
        snapshots.publish_snapshot(spark, staged, tables.path("validated_weather"), day)
    finally:
        snapshots.discard_snapshot(spark, staged, day)
    store_profile(spark, tables, "validated_weather", raw.columns, seen, day)
    return snapshots.read_snapshot(spark, tables.path("validated_weather"), day)


def weather_to_stages(
    spark: SparkSession, tables: Tables, weather: DataFrame, plots: DataFrame, day: str | dt.date
) -> dict[str, DataFrame]:
    """Gate the weather, then store weather, planting dates, stages and VT dates of the day.

    Planting dates and stages come of one read of the validated weather.
    """
    snapshots.write_snapshot(weather, tables.path("raw_weather"), day, ["plot_id"], buckets=tables.buckets)
    checked = validate_weather(spark, tables, day).drop(snapshots.DAY)
    both = files.store(P.planting_and_stages(checked, plots), "planting-and-stages")
    planting = store(spark, tables, "planting_dates", P.planting_rows(both), day, date="inferred_planting_date", keyed=True, placed=True)
    Q.require_rows(planting, "planting dates inferred")
    stages = store(spark, tables, "crop_stages", both.drop("day"), day, date="planting_date", keyed=True, placed=True)
    vt = store(spark, tables, "vt_stages", P.vt_dates(stages.drop(snapshots.DAY)), day, date="vt_stage_date", keyed=True)
    return {"planting_dates": planting, "crop_stages": stages, "vt_stages": vt}


def satellite_samples(
    spark: SparkSession, tables: Tables, pixels: DataFrame, day: str | dt.date
) -> DataFrame:
    """Stored stages and VT dates to index statistics per sample day."""
    stages = snapshots.read_latest(spark, tables.path("crop_stages"), day)
    vt = snapshots.read_latest(spark, tables.path("vt_stages"), day)
    if stages is None or vt is None:
        raise FileNotFoundError("no crop stages or VT dates; run weather_to_stages first")
    samples = I.plot_indices(pixels, I.satellite_input(stages, vt))
    return Q.require_rows(store(spark, tables, "satellite_indices", samples, day, placed=True), "satellite samples")


def materialize_features(spark: SparkSession, tables: Tables, day: str | dt.date) -> dict[str, DataFrame]:
    """Daily features, and plot features from the stored daily ones."""
    weather = snapshots.read_first_weather(
        spark, tables.path("validated_weather"), tables.path("raw_weather"), day)
    planting = snapshots.read_latest(spark, tables.path("planting_dates"), day)
    stages = snapshots.read_latest(spark, tables.path("crop_stages"), day)
    samples = snapshots.read_latest(spark, tables.path("satellite_indices"), day)
    if weather is None or planting is None or stages is None:
        raise FileNotFoundError("weather, planting dates and crop stages are needed")
    daily = X.daily_features(weather, planting, stages, samples, buckets=tables.buckets)
    stored = store(spark, tables, "daily_features", daily, day, ["plot_id"], "date", placed=True)
    store_sketches(spark, tables, day)
    return {"daily_features": stored, "plot_features": store(spark, tables, "plot_features", X.plot_features(stored, stages), day, keyed=True)}


def store_labels(spark: SparkSession, tables: Tables, harvest: DataFrame, day: str | dt.date) -> DataFrame:
    return store(spark, tables, "labels", G.yield_labels(harvest), day)


def training_table(labels: DataFrame, features: DataFrame, mode: str = "row") -> DataFrame:
    """Labels with features: nearest plot for missing ids, then the merge cascade, then calendar fields."""
    keyed = G.assign_nearest_plot(N.normalize_plot_id(G.tidy_keys(labels)), features)
    merged = G.merge_features(keyed, features, mode)
    return X.with_planting_calendar(merged, "Planting_Date")


@dataclass
class Trained:
    models: dict[str, PipelineModel]
    predictions: DataFrame
    metrics: DataFrame


def train_models(
    table: DataFrame, key: str, learners: Sequence[str] = tuple(M.LEARNERS), target: str = M.TARGET,
    features: Sequence[str] | None = None, categories: Sequence[str] = (), draws: int = 20, folds: int = 3,
    parallelism: int = 4, seed: int = 42, narrow: dict[str, dict] | None = None,
) -> Trained:
    """Split, search every learner, compare them and their equal-weight mean on the test rows.

    The table is read by every fold of every draw, so its lineage is cut once, in shared storage.
    `narrow` replaces search-space entries per learner.
    """
    numbers = list(features or M.numeric_features(table, target))
    rows = files.cut_lineage(M.exact_split(M.training_rows(table, target), key, seed=seed))
    train = rows.where(~F.col("is_test")).drop("is_test")
    test = rows.where("is_test").drop("is_test")
    fitted: dict[str, PipelineModel] = {}
    chosen: dict[str, str] = {}
    for name in learners:
        learner = M.LEARNERS[name]()
        if narrow and name in narrow:
            learner = M.Learner(learner.name, learner.make, {**learner.space, **narrow[name]})
        search = M.random_search(train, learner, numbers, target, categories, draws, folds, parallelism, seed)
        fitted[name] = search.bestModel
        chosen[name] = str(M.best_params(search))
    predictions = M.predict_all(test, fitted, numbers, target)
    pairs = [x for name, text in chosen.items() for x in (F.lit(name), F.lit(text))]
    metrics = M.leaderboard(M.evaluate(predictions).withColumn(
        "best_params", F.create_map(*pairs)[F.col("model")]))
    return Trained(fitted, predictions, metrics)


def training_run(
    spark: SparkSession, tables: Tables, day: str | dt.date, key: str = "plot_id", name: str = "yield",
    learners: Sequence[str] = tuple(M.LEARNERS), **options,
) -> Trained | None:
    """Labels and features of the day, or the newest ones, to models, runs, results and versions.

    Without labels the run ends quietly. Every model is saved under its run id; the best one (least RMSE) becomes
    the next version of `name`, and Production if no better one is there: its RMSE is compared with that of
    the version in Production.
    """
    labels = files.read_labels(spark, tables.path("labels"), day)
    if labels is None:
        return None
    features = snapshots.read_latest(spark, tables.path("plot_features"), day)
    if features is None:
        raise FileNotFoundError("no plot features; run materialize_features first")
    table = training_table(labels.drop(snapshots.DAY), features.drop(snapshots.DAY))
    trained = train_models(table, key, learners, **options)
    for model, fitted in trained.models.items():
        M.save_model(fitted, f"{tables.path('models')}/{model}-{day}")
    metrics = files.store(trained.metrics, "metrics")
    files.write_training_results(tables.path("training_results"), day, metrics, trained.predictions)
    runs = M.run_rows(metrics, str(day))
    store(spark, tables, "model_runs", runs, day)
    single = metrics.where(F.col("model").isin(*trained.models))
    best = single.orderBy("RMSE", "model").first()
    register_best(spark, tables, name, f"{best['model']}-{day}", best["RMSE"], str(day))
    return trained


def register_best(spark: SparkSession, tables: Tables, name: str, run_id: str, rmse: float, at: str) -> int:
    """The run as the next version of the model; Production if no version there has a lower RMSE."""
    root = tables.path("registry")
    version = registry.register(spark, root, name, run_id, f"{tables.path('models')}/{run_id}", at)
    live = registry.current_versions(spark, root).where((F.col("name") == name) & (F.col("stage") == "Production"))
    runs = spark.read.parquet(tables.path("model_runs")).select("run_id", F.col("metrics")["RMSE"].alias("live_rmse"))
    score = live.join(runs, "run_id").agg(F.min("live_rmse")).first()[0]
    if score is None or rmse <= score:
        registry.set_stage(spark, root, name, version, "Production", at)
    return version


def score_plots(
    spark: SparkSession, tables: Tables, requests: DataFrame, model: PipelineModel, columns: Sequence[str],
    name: str, day: str | dt.date,
) -> tuple[DataFrame, DataFrame]:
    """Score requests on the newest plot features; the day's predictions are the prediction log."""
    features = snapshots.read_latest(spark, tables.path("plot_features"), day)
    if features is None:
        raise FileNotFoundError("no plot features; run materialize_features first")
    rows = X.features_for_scoring(requests, features.drop(snapshots.DAY))
    scored = M.score_batch(rows, lambda df: model.transform(M.as_double(df, columns)), name)
    snapshots.write_snapshot(scored, tables.path("predictions"), day)
    stored = snapshots.read_snapshot(spark, tables.path("predictions"), day)
    return stored, M.score_counts(stored)


def store_sketches(spark: SparkSession, tables: Tables, day: str | dt.date) -> None:
    """Quantile sketches and category counts of the day's daily features, kept beside them for later drift checks."""
    daily = snapshots.read_snapshot(spark, tables.path("daily_features"), day).drop(snapshots.DAY)
    numeric, other = D.choose_features(daily)
    snapshots.write_snapshot(D.sketches(daily, numeric), tables.path("feature_sketches"), day)
    snapshots.write_snapshot(D.category_counts(daily, other), tables.path("category_counts"), day)


def stored_sketches(
    spark: SparkSession, tables: Tables, days: Sequence[dt.date], current: dt.date, numeric: Sequence[str], other: Sequence[str]
) -> tuple[DataFrame | None, tuple[DataFrame, DataFrame] | None]:
    """Merged sketches of the reference days, and category counts of both sides; None where a day or feature lacks its own."""
    def read(name: str, wanted: Sequence[dt.date], features: Sequence[str]) -> DataFrame | None:
        root = tables.path(name)
        if not features or not set(wanted) <= set(snapshots.list_days(spark, root)):
            return None
        rows = spark.read.parquet(root).where(F.col(snapshots.DAY).isin(*wanted) & F.col("feature").isin(*features))
        # One row per feature and day.
        return rows if rows.select("feature", snapshots.DAY).distinct().count() == len(wanted) * len(features) else None

    sketch = read("feature_sketches", days, numeric)
    counts = read("category_counts", [*days, current], other)
    here = F.col(snapshots.DAY) == F.lit(current)
    return (None if sketch is None else D.merged(sketch),
            None if counts is None else (counts.where(~here).drop(snapshots.DAY), counts.where(here).drop(snapshots.DAY)))


def score_requests(
    spark: SparkSession, tables: Tables, requests: DataFrame, models: dict[str, PipelineModel], columns: Sequence[str],
    day: str | dt.date, default: str = "ensemble",
) -> tuple[DataFrame, DataFrame]:
    """Check requests, score the valid ones with the model each of them names, and store both.

    Returns the predictions and the rejected requests with their reasons.
    """
    checked = files.store(N.validate_requests(requests, list(models), default), "requests")
    good, bad = N.split_valid(checked)
    store(spark, tables, "rejected_requests", bad, day)
    features = snapshots.read_latest(spark, tables.path("plot_features"), day)
    if features is None:
        raise FileNotFoundError("no plot features; run materialize_features first")
    parts = None
    for name, model in models.items():
        rows = X.features_for_scoring(good.where(F.col("model_name") == name).drop("model_name"), features.drop(snapshots.DAY))
        scored = M.score_batch(rows, lambda df, m=model: m.transform(M.as_double(df, columns)), name)
        parts = scored if parts is None else parts.unionByName(scored)
    return (store(spark, tables, "predictions", parts, day),
            snapshots.read_snapshot(spark, tables.path("rejected_requests"), day))


def drift_check(
    spark: SparkSession, tables: Tables, day: str | dt.date, reference_days: int = 30
) -> tuple[DataFrame | None, DataFrame]:
    """Report and summary of the day's daily features against the days before.

    Stored sketches bracket the edges, so that both sides are read once; days without sketches are read for them.
    Reference days that cannot be read are left out, and listed in the `quarantine` table.
    """
    root = tables.path("daily_features")
    chosen = snapshots.pick_day(snapshots.list_days(spark, root), day)
    if chosen is None:
        return None, D.empty_summary(spark, str(day), "no_data")
    days = snapshots.last_days(spark, root, chosen, reference_days)
    damaged = snapshots.damaged_files(spark, root, days)
    if damaged:
        quarantine = spark.createDataFrame(damaged, "damaged_day date, file string, reason string")
        snapshots.write_snapshot(quarantine.coalesce(1), tables.path("quarantine"), chosen)
    days = [d for d in days if d not in {bad for bad, _, _ in damaged}]
    if not days:
        return None, D.empty_summary(spark, str(chosen), "no_reference")
    reference = snapshots.read_days(spark, root, days)
    current = snapshots.read_snapshot(spark, root, chosen).drop(snapshots.DAY)
    sketch, categories = stored_sketches(spark, tables, days, chosen, *D.choose_features(current))
    report = D.drift_report(reference.drop(snapshots.DAY), current, sketch=sketch, categories=categories)
    stored = store(spark, tables, "drift_report", report, chosen)
    return stored, D.drift_summary(stored, str(chosen))


def local_stage_run(
    spark: SparkSession, weather_path: str, planting_path: str, out: str
) -> tuple[DataFrame, DataFrame]:
    """Stages and VT dates from two files (CSV or Parquet) into two CSV folders."""
    weather = files.read_table(spark, weather_path)
    numbers = [c for c in ("latitude", "longitude", "max_temp_c", "min_temp_c") if c in weather.columns]
    weather = weather.withColumns({
        "plot_id": C.to_long(F.col("plot_id")), "date": C.to_day(F.col("date")),
        **{c: C.to_number(F.col(c)) for c in numbers}})
    planting = files.read_table(spark, planting_path)
    date = N.find_planting_column(planting)
    planting = planting.withColumns({
        "plot_id": C.to_long(F.col("plot_id")), date: C.to_day(F.col(date)),
        **({"altitude": C.to_number(F.col("altitude"))} if "altitude" in planting.columns else {})})
    stages = P.stage_dates(weather, planting)
    files.text_safe(stages).write.mode("overwrite").option("header", True).csv(f"{out}/crop_stages")
    vt = P.vt_dates(stages)
    files.text_safe(vt).write.mode("overwrite").option("header", True).csv(f"{out}/vt_stage_dates")
    return stages, vt
