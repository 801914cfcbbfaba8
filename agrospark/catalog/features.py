"""F: feature tables."""

from pyspark.sql import functions as F

from agrospark.catalog.base import IDX, Tables, query
from agrospark.catalog.indices import inputs_of, stored_stages
from agrospark.catalog.phenology import SUMMARY_SPEC, SUMMARY_SQL, summary_of
from agrospark.operators import features as X
from agrospark.operators import indices as I
from agrospark.operators import phenology as P
from agrospark.operators import training_set as G
from agrospark.plans import jobs
from agrospark.sources import files

DAY = "2024-01-15"  # of the stored tables
PLOTS_A_BUCKET = 2000  # some years of days of so many plots are about 100 MB

DAILY_SPEC = ("plot_id:i date:d latitude:f longitude:f max_temp_c:f min_temp_c:f precip_mm:f daily_gdd:f gdd_cumulative:f "
              "days_since_planting:i current_stage:s " + " ".join(f"mean_{i}:f cumulative_{i}:f" for i in IDX))
TOTALS_SQL = ("select plot_id, coalesce(sum(precip_mm), 0) as precip_total, coalesce(sum(daily_gdd), 0) as gdd_sum, "
              "max(gdd_cumulative) as gdd_peak, arg_min(latitude, date) as latitude, arg_min(longitude, date) as longitude, "
              + ", ".join(f"avg(mean_{i}) as mean_{i}" for i in IDX) + " from daily group by plot_id")
TOTALS_SPEC = ("plot_id:i precip_total:f gdd_sum:f gdd_peak:f latitude:f longitude:f " + " ".join(f"mean_{i}:f" for i in IDX))


def daily_of(t: Tables, stages=None):
    stages = stored_stages(t) if stages is None else stages
    samples = I.plot_indices(t.pixels, I.satellite_input(stages, P.vt_dates(stages)))
    return X.daily_features(t.weather, stages, stages, samples)


def samples_of(t: Tables):
    return I.plot_indices(t.pixels, inputs_of(t))


@query("f1_daily_features", DAILY_SPEC, "select * from daily", ("daily",))
def _(t):
    return daily_of(t)


@query("f1_from_placed_tables", DAILY_SPEC, "select * from daily", ("daily",))
def _(t):
    buckets = max(8, -(-t.plots.count() // PLOTS_A_BUCKET))
    tables = jobs.Tables(files.scratch_dir(t.spark, "tables"), buckets=buckets)
    jobs.weather_to_stages(t.spark, tables, t.weather, t.plots, DAY)
    jobs.satellite_samples(t.spark, tables, t.pixels, DAY)
    return jobs.materialize_features(t.spark, tables, DAY)["daily_features"]


@query("f2_plot_totals", TOTALS_SPEC, TOTALS_SQL, ("daily",))
def _(t):
    return X.plot_totals(daily_of(t))


@query("f3_plot_features", TOTALS_SPEC + " planting_date:d VT:d confidence:f season:s altitude:f days_to_vt:i",
       f"""select a.*, s.planting_date, s."VT", s.confidence, s.season, s.altitude, s."VT" - s.planting_date as days_to_vt
 from ({TOTALS_SQL}) a left join stages s on s.plot_id = a.plot_id""", ("daily", "stages"))
def _(t):
    stages = stored_stages(t)
    return X.plot_features(daily_of(t, stages), stages)


def repeated_stages(t: Tables):
    """Every plot's stages a second time, without dates: the full row must win."""
    stages = stored_stages(t)
    dates = [c for c, kind in stages.dtypes if kind == "date"]
    return stages.unionByName(stages.withColumns({c: F.lit(None).cast("date") for c in dates}))


@query("f1_repeated_stages", "plot_id:i date:d days_since_planting:i current_stage:s",
       "select plot_id, date, days_since_planting, current_stage from daily", ("daily",))
def _(t):
    stages = repeated_stages(t)
    return X.daily_features(t.weather, stages, stages)


@query("f3_repeated_stages", "plot_id:i planting_date:d VT:d days_to_vt:i", """
select plot_id, planting_date, "VT", "VT" - planting_date as days_to_vt from (select distinct plot_id from daily) d
 left join (select plot_id as pid, planting_date, "VT" from stages) s on pid = plot_id""", ("daily", "stages"))
def _(t):
    stages = repeated_stages(t)
    return X.plot_features(X.daily_features(t.weather, stages, stages), stages)


@query("f2_totals_since_planting", "plot_id:i precip_total:f gdd_sum:f gdd_peak:f", """
select plot_id, sum(precip_mm) as precip_total, sum(daily_gdd) as gdd_sum, max(cum) as gdd_peak from cumulative
where date >= planting_date group by plot_id""", ("cumulative",))
def _(t):
    weather = t.weather
    daily = X.daily_features(weather, P.infer_planting_dates(weather, t.plots), stored_stages(t))
    return X.plot_totals(daily, since_planting=True)


F4_SQL = ("select plot_id, " + ", ".join(f"sum(mean_{i}) as total_mean_{i}" for i in IDX)
          + ", arg_max(cumulative_ndvi, sample_date) as cumulative_ndvi from sat group by plot_id")
F4_SPEC = "plot_id:i " + " ".join(f"total_mean_{i}:f" for i in IDX) + " cumulative_ndvi:f"


@query("f4_index_totals", F4_SPEC, F4_SQL, ("sat",))
def _(t):
    return X.index_totals(samples_of(t))


@query("f5_yield_table", SUMMARY_SPEC + " crop_type:s wet_harvest_kg/ha:f " + F4_SPEC.removeprefix("plot_id:i "), f"""
select * from ({SUMMARY_SQL}) s left join (select plot_id as hid, crop_type, round((w1 + w2) / 80 * 10000, 2) as "wet_harvest_kg/ha"
 from harvest) h on h.hid = s.plot_id left join (select plot_id as iid, * exclude (plot_id) from ({F4_SQL})) i on i.iid = s.plot_id""",
       ("weather", "cumulative", "harvest", "sat"))
def _(t):
    labels = G.yield_labels(t.harvest)
    typed = labels.withColumn("plot_id", F.col("plot_id").cast("long"))
    return X.yield_table(summary_of(t), typed, X.index_totals(samples_of(t)))


@query("f6_planting_calendar", "label_no:i plant_month:i plant_doy:i",
       "select label_no, month(planting_date) as plant_month, dayofyear(planting_date) as plant_doy from labels_in", ("labels_in",))
def _(t):
    return X.with_planting_calendar(t.labels_in, "Planting_Date")


@query("f7_category_code", "p_partkey:i p_type_enc:i", """
select p_partkey, dense_rank() over (order by p_type) - 1 as p_type_enc from (select p_partkey,
 case when p_size % 10 = 0 then 'nan' else p_type || ' ' || p_brand end as p_type from part)""")
def _(t):
    kind = F.when(F.col("p_size") % 10 != 0, F.concat_ws(" ", "p_type", "p_brand"))
    return X.with_category_code(t.part.select("p_partkey", kind.alias("p_type")), "p_type")


@query("f8_scoring_features",
       "plot_id:i request_id:i latitude:f longitude:f planting_date:d season:s altitude:f plant_month:i plant_doy:i precip_total:f "
       "gdd_sum:f gdd_peak:f mean_ndvi:f mean_evi:f days_to_vt:i has_features:b", """
select r.plot_id, r.request_id, case when f.plot_id is null then r.latitude else f.latitude end as latitude,
 case when f.plot_id is null then r.longitude else f.longitude end as longitude,
 case when f.plot_id is null then r.planting_date else f.planting_date end as planting_date,
 case when f.plot_id is null then coalesce(r.season, 'Short Rains') end as season,
 case when f.plot_id is null then case when coalesce(r.altitude, 0) = 0 then 1200 else r.altitude end end as altitude,
 case when f.plot_id is null then month(r.planting_date) end as plant_month,
 case when f.plot_id is null then dayofyear(r.planting_date) end as plant_doy,
 case when f.plot_id is null then 0 else f.precip_total end as precip_total,
 case when f.plot_id is null then 0 else f.gdd_sum end as gdd_sum,
 case when f.plot_id is null then 0 end as gdd_peak, case when f.plot_id is null then 0 end as mean_ndvi,
 case when f.plot_id is null then 0 end as mean_evi, case when f.plot_id is null then 0 end as days_to_vt,
 f.plot_id is not null as has_features from score_requests r left join feature_rows f on f.plot_id = r.plot_id""",
       ("score_requests", "feature_rows"))
def _(t):
    return X.features_for_scoring(t.score_requests, t.feature_rows)
