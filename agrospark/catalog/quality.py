"""C: quality gates."""

from pyspark.sql import functions as F

from agrospark.catalog.base import query
from agrospark.operators import quality as Q
from agrospark.operators import training_set as G
from agrospark.plans import jobs
from agrospark.sources import files, snapshots as A

NULLS = ", ".join(f"count(*) - count({c}) as null_{c}" for c in ("max_temp_c", "min_temp_c", "precip_mm"))
RANGE = "count(*) filter (max_temp_c > 60 or max_temp_c < -50) as out_of_range"
DUPES = "count(*) - count(distinct (plot_id, date)) as duplicates"


@query("c1_null_gate", "null_max_temp_c:i null_min_temp_c:i null_precip_mm:i", f"select {NULLS} from raw_weather", ("raw_weather",))
def _(t):
    return Q.null_gate(t.raw_weather)


@query("c2_range_gate", "out_of_range:i", f"select {RANGE} from raw_weather", ("raw_weather",))
def _(t):
    return Q.range_gate(t.raw_weather)


@query("c3_duplicate_gate", "duplicates:i", f"select {DUPES} from raw_weather", ("raw_weather",))
def _(t):
    return Q.duplicate_gate(t.raw_weather)


@query("c3_unique_days", "plot_id:i date:d max_temp_c:f min_temp_c:f mean_temp_c:f precip_mm:f", """
select plot_id, date, m.* from (select plot_id, date, max_temp_c, min_temp_c, mean_temp_c, precip_mm, row_number() over (
 partition by plot_id, date order by max_temp_c nulls last, min_temp_c nulls last, mean_temp_c nulls last, precip_mm nulls last) as rn
 from raw_weather) m where rn = 1""".replace("plot_id, date, m.*", "m.*"), ("raw_weather",))
def _(t):
    return Q.unique_days(t.raw_weather)


@query("c4_weather_verdict", "null_max_temp_c:i null_min_temp_c:i null_precip_mm:i out_of_range:i duplicates:i passed:b",
       f"""select *, null_max_temp_c + null_min_temp_c + null_precip_mm + out_of_range + duplicates = 0 as passed
 from (select {NULLS}, {RANGE}, {DUPES} from raw_weather)""", ("raw_weather",))
def _(t):
    return Q.weather_verdict(t.raw_weather)


@query("c4_weather_gate", "plot_id:i date:d max_temp_c:f", "select * from weather", ("weather",))
def _(t):
    return Q.weather_gate(t.weather)


@query("c4_staged_gate", "plot_id:i date:d max_temp_c:f", "select * from weather", ("weather",))
def _(t):
    """The weather is counted while it is staged, and published."""
    tables = jobs.Tables(files.scratch_dir(t.spark, "gate"))
    A.write_snapshot(t.weather, tables.path("raw_weather"), "2024-01-01")
    return jobs.validate_weather(t.spark, tables, "2024-01-01").drop(A.DAY)


@query("c4_observed_counts", "row_count:i plot_count:i date_start:d date_end:d null_max_temp_c:i null_min_temp_c:i null_precip_mm:i "
       "out_of_range:i duplicates:i duplicate_count:i", f"""
select count(*) as row_count, count(distinct plot_id) as plot_count, min(date) as date_start, max(date) as date_end, {NULLS}, {RANGE}, {DUPES},
 count(*) - count(distinct (plot_id, date, max_temp_c, min_temp_c, mean_temp_c, precip_mm)) as duplicate_count from raw_weather""", ("raw_weather",))
def _(t):
    """What a write has counted of weather that breaks the gates."""
    root = files.scratch_dir(t.spark, "counted")
    seen = A.write_snapshot(Q.counted_days(t.raw_weather), root, "2024-01-01", metrics=Q.gate_metrics(t.raw_weather.columns))
    names = ["row_count", "plot_count", "date_start", "date_end", "null_max_temp_c", "null_min_temp_c", "null_precip_mm", "out_of_range",
             "duplicates", "duplicate_count"]
    return t.spark.createDataFrame([tuple(seen[n] for n in names)], ", ".join(
        f"{n} {'date' if n.startswith('date') else 'bigint'}" for n in names))


@query("a12_stored_profiles", "table:s row_count:i plot_count:i date_start:d date_end:d null_vt:i duplicate_count:i", """
select 'validated_weather' as "table", count(*) as row_count, count(distinct plot_id) as plot_count, min(date) as date_start, max(date) as date_end,
 null::bigint as null_vt, count(*) - count(distinct (plot_id, date)) as duplicate_count from weather
union all select 'crop_stages', count(*), count(distinct plot_id), min(planting_date), max(planting_date), count(*) - count("VT"), 0 from stages
union all select 'planting_dates', count(*), count(distinct plot_id), min(inferred_planting_date), max(inferred_planting_date), null, 0 from planting""",
       ("weather", "planting", "stages"))
def _(t):
    tables = jobs.Tables(files.scratch_dir(t.spark, "profiles"))
    jobs.weather_to_stages(t.spark, tables, t.weather, t.plots, "2024-01-01")
    rows = t.spark.read.parquet(tables.path("profiles")).where(F.col("table").isin("validated_weather", "crop_stages", "planting_dates"))
    return rows.select("table", "row_count", "plot_count", "date_start", "date_end", F.col("null_counts")["VT"].alias("null_vt"), "duplicate_count")


@query("c5_missing_summary", "column:s missing_count:i missing_pct:f", """
select c as "column", n as missing_count, n * 100.0::double / total as missing_pct from (
 select count(*) as total, unnest(['plot_id', 'date', 'max_temp_c', 'min_temp_c', 'mean_temp_c', 'precip_mm']) as c,
 unnest([count(*) - count(plot_id), count(*) - count(date), count(*) - count(max_temp_c), count(*) - count(min_temp_c),
  count(*) - count(mean_temp_c), count(*) - count(precip_mm)]) as n from raw_weather)""", ("raw_weather",))
def _(t):
    return Q.missing_summary(t.raw_weather)


@query("c6_missing_rates", "feature:s missing_ref:f missing_cur:f", """
select f as feature, r as missing_ref, c as missing_cur from (select unnest(['gdd', 'precip']) as f,
 unnest([avg((gdd is null)::int) filter (not cur), avg((precip is null)::int) filter (not cur)]) as r,
 unnest([avg((gdd is null)::int) filter (cur), avg((precip is null)::int) filter (cur)]) as c
 from (select *, ds = (select max(ds) from snapshots) as cur from snapshots))""", ("snapshots",))
def _(t):
    return Q.missing_rates(A.union_last_n(t.snapshots), A.resolve_snapshot(t.snapshots), ["gdd", "precip"])


@query("c7_unmatched_features", "total:i missing:i", """
select count(*) as total, count(*) filter (f.precip_total is null and f.gdd_sum is null) as missing from labels_in l
 left join feature_rows f on f.plot_id = l.plot_id and f.planting_date = l.planting_date""", ("labels_in", "feature_rows"))
def _(t):
    merged = G.join_on_plot_and_date(t.labels_in, t.feature_rows)
    return Q.unmatched_features(merged, ["precip_total", "gdd_sum"])
