"""D: planting dates, degree days and growth stages."""

from pyspark.sql import functions as F

from agrospark import schemas as S
from agrospark.catalog.base import Tables, query
from agrospark.functions import columns as C
from agrospark.operators import phenology as P
from agrospark.sources import files

STAGE_SPEC = ("plot_id:i latitude:f longitude:f altitude:f season:s planting_date:d method:s confidence:f "
              "VE:d V2:d V6:d VT:d R1:d R4:d R6:d")


def stages_of(t: Tables):
    return P.stage_dates_from_weather(t.weather, t.plots)


def planted(t: Tables):
    planting = P.infer_planting_dates(t.weather, t.plots)
    return planting.select("plot_id", F.col("inferred_planting_date").alias("planting_date"))


def stored_planting(t: Tables):
    """Planting dates as the jobs keep them: one row per plot, stored once and used several times."""
    return files.store(planted(t), "planting_dates")


@query("d1_altitude_delay", "plot_id:i altitude:f delay_days:i",
       """select plot_id, altitude, case when altitude <= 1200 then 0 else floor((altitude - 1200) / 100) end as delay_days from plots""",
       ("plots",))
def _(t):
    return t.plots.withColumn("delay_days", C.altitude_delay(F.col("altitude")))


@query("d2_planting_test", "plot_id:i date:d rainfall_threshold:b temperature_threshold:b",
       """select plot_id, date, precip_mm >= 5 as rainfall_threshold, (max_temp_c + min_temp_c) / 2 >= 18 as temperature_threshold from weather""",
       ("weather",))
def _(t):
    tested = P.planting_test(t.weather)
    return tested.select("plot_id", "date", *[
        F.col("criteria_met")[c].alias(c) for c in ("rainfall_threshold", "temperature_threshold")])


PLANTING_SQL = """select plot_id, inferred_planting_date, confidence_score, 'rainfall_temperature_threshold' as method,
 altitude_adjustment_days from planting"""
PLANTING_SPEC = "plot_id:i inferred_planting_date:d confidence_score:f method:s altitude_adjustment_days:i"


@query("d3_infer_planting_date", "plot_id:i inferred_planting_date:d",
       "select plot_id, inferred_planting_date from planting", ("planting",))
def _(t):
    return P.infer_planting_dates(t.weather, t.plots)


@query("d4_planting_confidence", "plot_id:i date:d confidence:f", """
select plot_id, date, least(0.7::double + case when precip_mm > 15 then 0.15::double when precip_mm > 10 then 0.10::double else 0 end
 + case when (max_temp_c + min_temp_c) / 2 > 23 then 0.15::double when (max_temp_c + min_temp_c) / 2 > 20 then 0.10::double else 0 end, 1.0) as confidence
from weather where precip_mm >= 5 and (max_temp_c + min_temp_c) / 2 >= 18""", ("weather",))
def _(t):
    rain, hi, lo = F.col("precip_mm"), F.col("max_temp_c"), F.col("min_temp_c")
    return t.weather.where(C.rain_ok(rain) & C.warm_enough(hi, lo)).withColumn(
        "confidence", C.planting_confidence(rain, hi, lo))


@query("d5_infer_planting_batch", PLANTING_SPEC, PLANTING_SQL, ("planting",))
def _(t):
    return P.infer_planting_dates(t.weather, t.plots)


@query("d6_daily_gdd", "plot_id:i date:d daily_gdd:f",
       "select plot_id, date, greatest((max_temp_c + min_temp_c) / 2 - 10, 0) as daily_gdd from weather", ("weather",))
def _(t):
    return P.with_daily_gdd(t.weather)


@query("d7_cumulative_gdd", "plot_id:i date:d gdd_cumulative:f",
       "select plot_id, date, cum as gdd_cumulative from cumulative", ("cumulative",))
def _(t):
    return P.with_cumulative_gdd(P.with_daily_gdd(t.weather.join(planted(t), "plot_id", "left")))


@query("d8_maturity_class", "plot_id:i maturity_class:s",
       "select plot_id, case when altitude < 1200 then 'early' when altitude <= 1600 then 'medium' else 'late' end as maturity_class from plots",
       ("plots",))
def _(t):
    return P.stage_thresholds(t.plots)


@query("d9_stage_thresholds", "plot_id:i VE:i V2:i V6:i VT:i R1:i R4:i R6:i",
       """select plot_id, ve as "VE", v2 as "V2", v6 as "V6", vt as "VT", r1 as "R1", r4 as "R4", r6 as "R6" from plots p join thresholds t
 on t.cls = case when p.altitude < 1200 then 'early' when p.altitude <= 1600 then 'medium' else 'late' end""",
       ("plots", "thresholds"))
def _(t):
    return P.stage_thresholds(t.plots)


STAGE_SQL = "select *, 'gdd' as method from stages"


@query("d10_stage_dates", "plot_id:i VE:d V2:d V6:d VT:d R1:d R4:d R6:d", STAGE_SQL, ("stages",))
def _(t):
    planting = P.with_plot_metadata(P.infer_planting_dates(t.weather, t.plots), t.plots)
    return P.stage_dates(t.weather, planting)


@query("d11_batch_stages", STAGE_SPEC, STAGE_SQL, ("stages",))
def _(t):
    return stages_of(t)


@query("d12_stage_confidence", "plot_id:i confidence:f", "select plot_id, confidence from stages", ("stages",))
def _(t):
    return stages_of(t)


@query("d13_vt_dates", "plot_id:i vt_stage_date:d planting_date:d source:s confidence:f note:s",
       "select * from vt", ("vt",))
def _(t):
    return P.vt_dates(stages_of(t))


@query("d14_reached_vt", "plot_id:i vt_stage_date:d planting_date:d source:s confidence:f",
       """select plot_id, "VT" as vt_stage_date, planting_date, 'gdd_calculated' as source, confidence from stages where "VT" is not null""",
       ("stages",))
def _(t):
    return P.reached_vt(stages_of(t))


@query("d15_stage_summary",
       "plot_count:i vt_stage_found:i vt_percentage:f average_confidence:f found_VE:i found_R6:i earliest_planting:d "
       "latest_planting:d earliest_vt:d latest_vt:d", """
select count(*) as plot_count, count("VT") as vt_stage_found, count("VT") * 100.0::double / count(*) as vt_percentage,
 avg(confidence) as average_confidence, count("VE") as "found_VE", count("R6") as "found_R6",
 min(planting_date) as earliest_planting, max(planting_date) as latest_planting, min("VT") as earliest_vt, max("VT") as latest_vt
from stages""", ("stages",))
def _(t):
    return P.stage_summary(stages_of(t))


@query("d15_vt_source_summary", "source:s plots:i average_confidence:f percentage:f", """
select source, count(*) as plots, avg(confidence) as average_confidence,
 count(*) * 100.0::double / (select count(*) from vt) as percentage from vt group by source""", ("vt",))
def _(t):
    return P.vt_source_summary(P.vt_dates(stages_of(t)))


@query("d15_run_metadata", "execution_date:s plot_count:i vt_stage_found:i average_confidence:f sources:s", """
select '2024-01-01' as execution_date, count(*) as plot_count, count("VT") as vt_stage_found, avg(confidence) as average_confidence,
 (select string_agg(source || ':' || n, ',' order by source) from (select source, count(*) as n from vt group by source)) as sources
from stages""", ("stages", "vt"))
def _(t):
    stages = stages_of(t)
    rows = P.run_metadata(stages, P.vt_dates(stages), "2024-01-01")
    listed = F.array_sort(F.transform(F.map_entries("source_distribution"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))))
    return rows.select("execution_date", "plot_count", "vt_stage_found", "average_confidence", F.array_join(listed, ",").alias("sources"))


@query("d16_plot_metadata", "plot_id:i planting_date:d altitude:f season:s",
       "select plot_id, inferred_planting_date as planting_date, altitude, season from planting", ("planting",))
def _(t):
    return P.with_plot_metadata(P.infer_planting_dates(t.weather, t.plots), t.plots)


LONG_VALUES = ", ".join(f"('{n}', {v})" for n, v in S.LONG_FORM_STAGES.items())
LONG_SQL = f"""select plot_id, latitude, longitude, planting_date, crop_stage, min(date) as stage_date,
 arg_min(cum, date) as gdd, need as ideal_gdd from (select c.*, l.* from
 (select *, arg_min(latitude, date) over (partition by plot_id) as la from cumulative where planting_date is not null) c
 join (values {LONG_VALUES}) l(crop_stage, need) on c.cum >= l.need) group by plot_id, latitude, longitude, planting_date, crop_stage, need"""


@query("d17_long_form_stages",
       "plot_id:i latitude:f longitude:f planting_date:d crop_stage:s stage_date:d gdd:f ideal_gdd:i",
       LONG_SQL, ("cumulative",))
def _(t):
    return P.long_form_stages(t.weather, planted(t))


LATEST_SQL = f"""select plot_id, arg_max(crop_stage, (stage_date, ideal_gdd)) as crop_stage, max(stage_date) as stage_date,
 any_value(planting_date) as planting_date from ({LONG_SQL}) group by plot_id"""


@query("d18_latest_stage", "plot_id:i crop_stage:s stage_date:d", LATEST_SQL, ("cumulative",))
def _(t):
    return P.latest_stage(P.long_form_stages(t.weather, planted(t)))


SUMMARY_SQL = f"""select w.plot_id, arg_min(w.latitude, date) as latitude, arg_min(w.longitude, date) as longitude,
 any_value(l.planting_date) as planting_date, any_value(crop_stage) as latest_stage, any_value(stage_date) as latest_stage_date,
 max(max_temp_c) as max_temp_c, min(min_temp_c) as min_temp_c, avg(mean_temp_c) as mean_temp_c, sum(precip_mm) as precip_mm,
 avg(humidity_pct) as humidity_pct, sum(solar_energy_mjm2) as solar_energy_mjm2, avg(wind_speed_kmh) as wind_speed_kmh,
 avg(cloud_cover_pct) as cloud_cover_pct from weather w join ({LATEST_SQL}) l on l.plot_id = w.plot_id
 and w.date between l.planting_date and l.stage_date group by w.plot_id"""
# Means of coarse values over 2^k days end in ...5 at the sixth place; nine places avoid such ties.
SUMMARY_SPEC = ("plot_id:i latitude:f longitude:f planting_date:d max_temp_c:f min_temp_c:f mean_temp_c:f9 precip_mm:f "
                "humidity_pct:f9 solar_energy_mjm2:f wind_speed_kmh:f9 cloud_cover_pct:f9")


def summary_of(t: Tables):
    return P.season_summary_from_weather(t.weather, t.plots)


@query("d19_season_summary", SUMMARY_SPEC + " latest_stage:s latest_stage_date:d", SUMMARY_SQL, ("weather", "cumulative"))
def _(t):
    return summary_of(t)


@query("d19_season_summary_of_stages", SUMMARY_SPEC + " latest_stage:s latest_stage_date:d", SUMMARY_SQL, ("weather", "cumulative"))
def _(t):
    """From stored planting dates and long-form stages."""
    planting = stored_planting(t)
    return P.season_summary(t.weather, P.latest_stage(P.long_form_stages(t.weather, planting)), planting)


@query("d20_current_stage", "plot_id:i date:d current_stage:s",
       """select w.plot_id, w.date, case when w.date < s.planting_date then 'pre_planting' when w.date >= "R6" then 'R6'
 when w.date >= "R4" then 'R4' when w.date >= "R1" then 'R1' when w.date >= "VT" then 'VT' when w.date >= "V6" then 'V6'
 when w.date >= "V2" then 'V2' when w.date >= "VE" then 'VE' when s.planting_date is not null then 'post_planting_pre_VE'
 else 'unknown' end as current_stage from weather w left join stages s on s.plot_id = w.plot_id""", ("weather", "stages"))
def _(t):
    return P.with_current_stage(t.weather.select("plot_id", "date"), stages_of(t))


@query("d21_days_since_planting", "plot_id:i date:d days_since_planting:i",
       "select plot_id, date, date - planting_date as days_since_planting from cumulative", ("cumulative",))
def _(t):
    return P.with_days_since_planting(t.weather.select("plot_id", "date").join(planted(t), "plot_id", "left"))
