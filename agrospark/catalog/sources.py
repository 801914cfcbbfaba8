"""A: readers, snapshots, payloads, lookups, profiles and writers."""

import datetime as dt

from pyspark.sql import functions as F

from agrospark import schemas as S
from agrospark.catalog.base import Tables, query
from agrospark.operators import features as X
from agrospark.operators import models as M
from agrospark.operators import normalize as N
from agrospark.operators import phenology as P
from agrospark.operators import quality as Q
from agrospark.operators import training_set as G
from agrospark.plans import jobs
from agrospark.sources import files, payload, snapshots

MIDDLE_DAY = dt.date(2024, 1, 15)
ABSENT_DAY = dt.date(2030, 1, 1)
SNAP_SPEC = "ds:d plot_id:i gdd:f ndvi:f stage:s precip:f event_id:i"
LABEL_SQL = """select plot_id, planting_date as "Planting_Date", crop_type, latitude, longitude,
 round((w1 + w2) / 80 * 10000, 2) as "wet_harvest_kg/ha", round((w3 + w4) / 80 * 10000, 2) as "dry_harvest_kg/ha" from harvest"""
LABEL_SPEC = "plot_id:i Planting_Date:d crop_type:s latitude:f longitude:f wet_harvest_kg/ha:f dry_harvest_kg/ha:f"


@query("a1_read_plots", "plot_id:i latitude:f longitude:f altitude:f season:s year:i", "select * from plots", ("plots",))
def _(t: Tables):
    path = files.scratch_dir(t.spark, "plots.csv")
    t.plots.write.option("header", True).csv(path)
    raw = files.read_plots(t.spark, path)
    return raw.select(
        "season", *[F.col(c).cast("double").alias(c) for c in ("plot_id", "latitude", "longitude", "altitude", "year")])


@query("a2_read_snapshot", SNAP_SPEC, "select * from snapshots where ds = date '2024-01-15'", ("snapshots",))
def _(t):
    root = files.scratch_dir(t.spark, "snapshots")
    t.snapshots.write.partitionBy("ds").parquet(root)
    return snapshots.read_snapshot(t.spark, root, MIDDLE_DAY)


@query("a3_resolve_snapshot", SNAP_SPEC, "select * from snapshots where ds = (select max(ds) from snapshots)", ("snapshots",))
def _(t):
    return snapshots.resolve_snapshot(t.snapshots, ABSENT_DAY)


@query("a3_resolve_snapshot_present", SNAP_SPEC, "select * from snapshots where ds = date '2024-01-15'", ("snapshots",))
def _(t):
    return snapshots.resolve_snapshot(t.snapshots, MIDDLE_DAY)


@query("a4_resolve_weather", "tier:s ds:d", """
select tier, ds from (select distinct case when plot_id % 2 = 0 then 'validated' else 'raw' end as tier, ds from snapshots)
order by case when ds = date '2024-01-15' then 0 else 1 end, case when tier = 'validated' then 0 else 1 end, ds desc limit 1""",
       ("snapshots",))
def _(t):
    tier = F.when(F.col("plot_id") % 2 == 0, "validated").otherwise("raw")
    return snapshots.resolve_weather(t.snapshots.select(tier.alias("tier"), "ds"), MIDDLE_DAY)


@query("a5_read_harvest", LABEL_SPEC, LABEL_SQL, ("harvest",))
def _(t):
    root = files.scratch_dir(t.spark, "harvest")
    t.harvest.write.option("header", True).csv(f"{root}/{MIDDLE_DAY}/harvest.csv")
    return G.yield_labels(files.read_harvest(t.spark, root, MIDDLE_DAY))


@query("a6_export_labels", "plot_id:i Planting_Date:d gdd:f", """
select plot_id, planting_date as "Planting_Date", s_suppkey * 2.0 as gdd from labels_in join supplier on label_no = s_suppkey""", ("labels_in",))
def _(t):
    base = files.scratch_dir(t.spark, "labels")
    ready = t.labels_in.select(
        F.col("plot_id").alias("plot_no"), F.col("Planting_Date").cast("string").alias("planting_date"),
        (F.col("label_no") * 2.0).alias("gdd"))
    ready.write.parquet(f"{base}/ready.parquet")
    files.export_labels(t.spark, f"{base}/ready.parquet", f"{base}/table", MIDDLE_DAY)
    return snapshots.read_snapshot(t.spark, f"{base}/table", MIDDLE_DAY)


@query("a7_write_snapshot", "plot_id:i date:d precip_mm:f", "select * from weather", ("weather",))
def _(t):
    root = files.scratch_dir(t.spark, "weather")
    for _ in range(2):  # a rerun replaces the day
        snapshots.write_snapshot(t.weather, root, MIDDLE_DAY, ["plot_id"])
    return snapshots.read_latest(t.spark, root)


@query("a7_placed_day", "plot_id:i days:i rain:f", "select plot_id, count(*) as days, sum(precip_mm) as rain from weather group by plot_id",
       ("weather",))
def _(t):
    root = files.scratch_dir(t.spark, "weather")
    for _ in range(2):
        snapshots.write_snapshot(t.weather, root, MIDDLE_DAY, ["plot_id"], buckets=8)
    return snapshots.read_latest(t.spark, root).groupBy("plot_id").agg(
        F.count("*").alias("days"), F.sum("precip_mm").alias("rain"))


@query("a8_union_last_n", SNAP_SPEC, """
select * from snapshots where ds in (select ds from (select distinct ds from snapshots
 where ds <= (select max(ds) from snapshots) - 1) order by ds desc limit 7)""", ("snapshots",))
def _(t):
    return snapshots.union_last_n(t.snapshots, n=7)


@query("a8_skip_damaged_day", SNAP_SPEC, """
select * from snapshots where ds in (select ds from (select distinct ds from snapshots
 where ds <= (select max(ds) from snapshots) - 1) order by ds desc limit 7) and ds <> (select max(ds) from snapshots) - 3""", ("snapshots",))
def _(t):
    """Stored by day; one of the days has a file that is no Parquet, and is left out as a whole."""
    root = files.scratch_dir(t.spark, "damaged")
    t.snapshots.where(F.col("ds") >= t.snapshots.agg(F.date_sub(F.max("ds"), 20)).scalar()) \
        .write.partitionBy("ds").parquet(root)
    newest = snapshots.list_days(t.spark, root)[-1]
    bad = t.spark.createDataFrame([("no footer",)], "value string").coalesce(1)
    damaged = f"{root}/ds={newest - dt.timedelta(days=3)}"
    bad.write.mode("append").text(f"{root}/_text")
    jvm = t.spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/_text")
    fs = folder.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    fs.rename(part, jvm.org.apache.hadoop.fs.Path(f"{damaged}/part-damaged.parquet"))
    found = snapshots.read_last_n(t.spark, root, newest, n=7, skip_unreadable=True)
    return found.select(*t.snapshots.columns)


WEATHER_SPEC = ("plot_id:i latitude:f longitude:f date:d max_temp_c:f min_temp_c:f mean_temp_c:f precip_mm:f humidity_pct:f "
                "solar_energy_mjm2:f wind_speed_kmh:f cloud_cover_pct:f")


def payloads_of(t: Tables):
    """The weather as provider documents: one per plot and month, so at most 31 days each."""
    return documents_of(t.weather)


def documents_of(weather, *placed: str):
    """`placed`: columns that follow from plot and month and by which the days lie together already."""
    theirs = {ours: name for name, ours in S.PAYLOAD_NAMES.items()}
    day = F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("datetime"),
        *[F.col(c).alias(theirs[c]) for c in weather.columns if c in theirs])
    docs = weather.groupBy("plot_id", "latitude", "longitude", F.trunc("date", "month").alias("month"), *placed).agg(
        F.collect_list(day).alias("days"))
    return docs.select(F.to_json(F.struct("plot_id", "latitude", "longitude", "days")).alias("payload"))


@query("a9_flatten_payload", WEATHER_SPEC, "select * from weather", ("weather",))
def _(t):
    return payload.flatten_weather_payload(payloads_of(t))


@query("a10_lookup_asof", "event_id:i plot_id:i ts:t gdd:f ndvi:f", """
with v as (select plot_id, ds, min((gdd, ndvi)) as best from (select user_id as plot_id, cast(ts as date) as ds, value as gdd,
  (event_id % 13)::double as ndvi from events where event_type = 'purchase') group by plot_id, ds)
select e.event_id, e.user_id as plot_id, e.ts, v.best[1] as gdd, v.best[2] as ndvi from events e asof left join v
 on e.user_id = v.plot_id and e.ts >= v.ds""")
def _(t):
    bought = t.events.where(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("plot_id"), F.col("ts").cast("date").alias("date"), F.col("value").alias("gdd"),
        (F.col("event_id") % 13).cast("double").alias("ndvi"))
    entities = t.events.select("event_id", F.col("user_id").alias("plot_id"), "ts")
    return X.lookup_asof(entities, X.feature_view(bought, ["gdd", "ndvi"]), block="week")


AS_OF_DAY = """
with v as (select plot_id, ds, min((gdd, ndvi)) as best from (select user_id as plot_id, cast(ts as date) as ds, value as gdd,
  (event_id % 13)::double as ndvi from events where event_type = 'purchase') group by plot_id, ds)"""


@query("a10_repeated_rows", "event_id:i plot_id:i ts:t gdd:f ndvi:f", AS_OF_DAY + """
select e.event_id, e.user_id as plot_id, e.ts, v.best[1] as gdd, v.best[2] as ndvi from events e asof left join v
 on e.user_id = v.plot_id and e.ts >= v.ds""")
def _(t):
    """Every offered day comes once more without its values; the complete row is the one that is found."""
    bought = t.events.where(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("plot_id"), F.col("ts").cast("date").alias("date"), F.col("value").alias("gdd"),
        (F.col("event_id") % 13).cast("double").alias("ndvi"))
    empty = bought.withColumns({c: F.lit(None).cast("double") for c in ("gdd", "ndvi")})
    entities = t.events.select("event_id", F.col("user_id").alias("plot_id"), "ts")
    return X.lookup_asof(entities, X.feature_view(bought.unionByName(empty), ["gdd", "ndvi"]))


@query("a10_lookup_by_time", "event_id:i plot_id:i ts:t gdd:f ndvi:f", """
with v as (select plot_id, ts, min((gdd, ndvi)) as best from (select user_id as plot_id, ts, value as gdd,
  (event_id % 13)::double as ndvi from events where event_type = 'purchase') group by plot_id, ts)
select e.event_id, e.user_id as plot_id, e.ts, v.best[1] as gdd, v.best[2] as ndvi from events e asof left join v
 on e.user_id = v.plot_id and e.ts >= v.ts""")
def _(t):
    bought = t.events.where(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("plot_id"), "ts", F.col("value").alias("gdd"), (F.col("event_id") % 13).cast("double").alias("ndvi"))
    entities = t.events.select("event_id", F.col("user_id").alias("plot_id"), "ts")
    return X.lookup_asof(entities, X.feature_view(bought, ["gdd", "ndvi"], ts="ts"), view_ts="ts")


@query("a11_lookup_features", SNAP_SPEC, """
select * from snapshots where ds = (select max(ds) from snapshots) and plot_id in (select plot_id from plots)""", ("snapshots", "plots"))
def _(t):
    return X.lookup_features(snapshots.resolve_snapshot(t.snapshots), t.plots)


@query("a12_profile", "row_count:i plot_count:i date_start:d date_end:d null_max_temp_c:i null_precip_mm:i duplicate_count:i", """
select count(*) as row_count, count(distinct plot_id) as plot_count, min(date) as date_start, max(date) as date_end,
 count(*) - count(max_temp_c) as null_max_temp_c, count(*) - count(precip_mm) as null_precip_mm,
 count(*) - (select count(*) from (select distinct * from raw_weather)) as duplicate_count from raw_weather""", ("raw_weather",))
def _(t):
    p = Q.profile(t.raw_weather)
    return p.select("*", *[F.col("null_counts")[c].alias(f"null_{c}") for c in ("max_temp_c", "precip_mm")])


@query("a12_planting_profile", "plot_count:i average_confidence:f min_confidence:f max_confidence:f earliest_planting:d latest_planting:d", """
select count(*) as plot_count, avg(confidence_score) as average_confidence, min(confidence_score) as min_confidence,
 max(confidence_score) as max_confidence, min(inferred_planting_date) as earliest_planting,
 max(inferred_planting_date) as latest_planting from planting""", ("planting",))
def _(t):
    return Q.planting_profile(P.infer_planting_dates(t.weather, t.plots))


@query("a13_training_results", "total_models:i best_model:s", """
select count(*) as total_models, arg_min(model, rmse) as best_model from (
 select 'a' as model, sqrt(avg(pow(pred_a - actual, 2))) as rmse from scores
 union all select 'b', sqrt(avg(pow(pred_b - actual, 2))) from scores)""", ("scores",))
def _(t):
    root = files.scratch_dir(t.spark, "models")
    paths = files.write_training_results(root, MIDDLE_DAY, M.evaluate(t.scores), t.scores)
    return t.spark.read.schema("total_models long, models_trained array<string>, best_model string").json(paths["summary"])


@query("a13_training_files", "model:s RMSE:f MAE:f compared:i predictions:i best_model:s", """
with m as (select 'a' as model, sqrt(avg(pow(pred_a - actual, 2))) as "RMSE", avg(abs(pred_a - actual)) as "MAE" from scores
 union all select 'b', sqrt(avg(pow(pred_b - actual, 2))), avg(abs(pred_b - actual)) from scores)
select m.*, (select count(*) from m) as compared, (select count(*) from scores) as predictions, (select arg_min(model, "RMSE") from m) as best_model
from m""", ("scores",))
def _(t):
    """All four files of a run, read back: metrics, comparison, summary and predictions."""
    paths = files.write_training_results(files.scratch_dir(t.spark, "results"), MIDDLE_DAY, M.evaluate(t.scores), t.scores)
    metrics = t.spark.read.schema("model string, RMSE double, MAE double, R2 double").json(paths["metrics"])
    compared = t.spark.read.option("header", True).csv(paths["comparison"]).agg(F.count("*")).scalar()
    predictions = t.spark.read.parquet(paths["predictions"]).agg(F.count("*")).scalar()
    best = t.spark.read.schema("best_model string").json(paths["summary"]).select("best_model").scalar()
    return metrics.select("model", "RMSE", "MAE", compared.alias("compared"), predictions.alias("predictions"), best.alias("best_model"))


@query("a14_text_safe", "plot_id:i date:s sample:s precip_mm:f", """
select plot_id, strftime(date, '%Y-%m-%d') as date, strftime(date, '%Y-%m-%dT00:00:00') as sample,
 case when precip_mm <> 0 then precip_mm end as precip_mm from weather""", ("weather",))
def _(t):
    w = t.weather.select(
        "plot_id", "date", F.col("date").cast("timestamp_ntz").alias("sample"),
        F.when(F.col("precip_mm") == 0, float("nan")).otherwise(F.col("precip_mm")).alias("precip_mm"))
    text = files.to_json_rows(w)
    return text.select(F.from_json("json", "plot_id long, date string, sample string, precip_mm double").alias("r")).select("r.*")


@query("a15_local_run", "plot_id:i vt_stage_date:d source:s", "select * from vt", ("vt",))
def _(t):
    base = files.scratch_dir(t.spark, "local")
    t.weather.write.parquet(f"{base}/weather.parquet")
    P.with_plot_metadata(P.infer_planting_dates(t.weather, t.plots), t.plots).drop("criteria_met").write.option(
        "header", True).csv(f"{base}/planting.csv")
    jobs.local_stage_run(t.spark, f"{base}/weather.parquet", f"{base}/planting.csv", f"{base}/out")
    return files.read_text_table(t.spark, f"{base}/out/vt_stage_dates").withColumn(
        "vt_stage_date", F.col("vt_stage_date").cast("date"))


@query("a16_resolve_labels", LABEL_SPEC, LABEL_SQL, ("harvest",))
def _(t):
    base = files.scratch_dir(t.spark, "labels")
    snapshots.write_snapshot(G.yield_labels(t.harvest), f"{base}/labels", MIDDLE_DAY)
    return files.read_labels(t.spark, f"{base}/labels", ABSENT_DAY)
