"""B: input tables into logical form."""

from pyspark.sql import functions as F

from agrospark.catalog.base import query
from agrospark.functions import columns as C
from agrospark.operators import normalize as N
from agrospark.operators import phenology as P

NORM = """case when lower(trim(season)) in ('short rains', 'short', 'sr', 'short_rains', 'short-rains') then 'Short Rains'
 when lower(trim(season)) in ('long rains', 'long', 'lr', 'long_rains', 'long-rains') then 'Long Rains' end"""
DERIVED = "case when month(planting_date) between 2 and 5 then 'Long Rains' else 'Short Rains' end"
SEASON = f"coalesce({NORM}, {DERIVED})"
FILLED = f"""select *, try_cast(plot_no as bigint) as pid from raw_plots"""
YEARS = f"""select *, coalesce(year(planting_date),
 first_value(year(planting_date) ignore nulls) over (order by pid nulls last, planting_date nulls last rows between current row and unbounded following),
 last_value(year(planting_date) ignore nulls) over (order by pid nulls last, planting_date nulls last rows between unbounded preceding and current row),
 2021) as year from ({FILLED})"""
CLEAN = f"""select * exclude (rn) from (select pid as plot_id, latitude, longitude, altitude, {SEASON} as season, year,
 row_number() over (partition by pid order by planting_date nulls last, longitude, latitude, altitude) as rn
 from ({YEARS}) where pid is not null and latitude is not null and longitude is not null) where rn = 1"""
PLOT_SPEC = "plot_id:i latitude:f longitude:f altitude:f season:s year:i"


@query("b1_plot_columns", "plot_id:s latitude:f longitude:f altitude:f", "select plot_no as plot_id, * from raw_plots", ("raw_plots",))
def _(t):
    return N.normalize_plot_columns(t.raw_plots)


@query("b2_planting_date", "Plot_No:s planting_date:d", 'select plot_no as "Plot_No", planting_date from raw_plots', ("raw_plots",))
def _(t):
    return N.with_planting_date(t.raw_plots)


@query("b3_normalize_season", "Plot_No:s season:s", f'select plot_no as "Plot_No", {NORM} as season from raw_plots', ("raw_plots",))
def _(t):
    return t.raw_plots.withColumn("season", C.normalize_season(F.col("season")))


@query("b4_derive_season", "Plot_No:s season:s", f'select plot_no as "Plot_No", {SEASON} as season from raw_plots', ("raw_plots",))
def _(t):
    return N.with_season(N.with_planting_date(t.raw_plots))


@query("b5_strict_season", "l_orderkey:i season:s", """
select l_orderkey, case when month(l_shipdate) between 3 and 5 then 'Long Rains' when month(l_shipdate) between 10 and 12
 then 'Short Rains' else 'Off Season' end as season from lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", C.derive_season_strict(F.col("l_shipdate")).alias("season"))


@query("b6_derive_year", "plot_id:s planting_date:d year:i",
       f"select plot_no as plot_id, planting_date, year from ({YEARS})", ("raw_plots",))
def _(t):
    rows = N.with_planting_date(N.normalize_plot_columns(t.raw_plots))
    return N.with_year(rows)


@query("b7_clean_plots", PLOT_SPEC, CLEAN, ("raw_plots",))
def _(t):
    return N.load_plots(t.raw_plots)


VALID = """select *, coalesce(altitude, 1200) as alt2, list_filter(['plot_id', 'longitude', 'latitude', 'altitude', 'season', 'year'],
 lambda x: not case x when 'plot_id' then plot_id > 0 when 'longitude' then longitude between -180 and 180
 when 'latitude' then latitude between -90 and 90 when 'altitude' then coalesce(altitude, 1200) between 0 and 10000
 when 'season' then season in ('Short Rains', 'Long Rains') else year between 2000 and 2100 end) as bad from plots"""


@query("b8_validate_plots", "plot_id:i altitude:f reasons:s",
       f"select plot_id, alt2 as altitude, array_to_string(bad, ',') as reasons from ({VALID})", ("plots",))
def _(t):
    return N.validate_plots(t.plots).withColumn("reasons", F.concat_ws(",", "reasons"))


@query("b8_valid_plots", "plot_id:i season:s year:i", f"select * from ({VALID}) where len(bad) = 0", ("plots",))
def _(t):
    return N.split_valid(N.validate_plots(t.plots))[0]


@query("b8_score_requests", "request_id:i model_name:s altitude:f reasons:s", """
select request_id, case when request_id % 5 = 0 then 'forest' when request_id % 5 = 1 then 'oracle' else 'ensemble' end as model_name, altitude,
 concat_ws(',', case when plot_id % 9 = 0 then 'plot_id' end, case when request_id % 7 = 0 then 'latitude' end,
  case when request_id % 6 = 0 then 'planting_date' end, case when altitude < 0 or altitude > 10000 then 'altitude' end,
  case when request_id % 5 = 1 then 'model_name' end) as reasons from score_requests""", ("score_requests",))
def _(t):
    """Requests as they come: dates as text, some of them unreadable, plots and places out of range, unknown models."""
    i = F.col("request_id")
    raw = t.score_requests.withColumns({
        "plot_id": F.when(F.col("plot_id") % 9 == 0, -F.col("plot_id")).otherwise(F.col("plot_id")),
        "latitude": F.when(i % 7 == 0, 91.0).otherwise(F.col("latitude")),
        "planting_date": F.when(i % 6 == 0, "soon").otherwise(F.col("planting_date").cast("string")),
        "model_name": F.when(i % 5 == 0, "forest").when(i % 5 == 1, "oracle")})
    out = N.validate_requests(raw, ["forest", "ensemble"])
    return out.select("request_id", "model_name", "altitude", F.concat_ws(",", "reasons").alias("reasons"))


@query("b8_stage_input", "request_id:i altitude:f reasons:s", """
select request_id, a as altitude, concat_ws(',', case when a < 0 or a > 5000 then 'altitude' end,
  case when season is null then 'season' end, case when request_id % 6 = 0 then 'planting_date' end) as reasons
from (select *, coalesce(altitude, 1200) as a from score_requests)""", ("score_requests",))
def _(t):
    dated = t.score_requests.withColumn("planting_date", F.when(F.col("request_id") % 6 != 0, F.col("planting_date")))
    return N.validate_stage_input(dated).select("request_id", "altitude", F.concat_ws(",", "reasons").alias("reasons"))


@query("b9_normalize_labels",
       "plot_id:i Planting_Date:d crop_type:s latitude:f longitude:f wet_kgs_crop_box1:f wet_kgs_crop_box2:f "
       "dry_box1_dry_weight:f dry_box2_dry_weight:f",
       """select plot_id, planting_date as "Planting_Date", crop_type, latitude, longitude, w1 as wet_kgs_crop_box1,
 w2 as wet_kgs_crop_box2, w3 as dry_box1_dry_weight, w4 as dry_box2_dry_weight from harvest""", ("harvest",))
def _(t):
    return N.normalize_labels(t.harvest)


@query("b10_validate_weather", "plot_id:i date:d max_temp_c:f precip_mm:f reasons:s", """
select plot_id, date, max_temp_c, coalesce(precip_mm, 0) as precip_mm, concat_ws(',',
 case when coalesce(max_temp_c between -50 and 60, false) then null else 'max_temp_c' end,
 case when coalesce(min_temp_c between -50 and 60, false) then null else 'min_temp_c' end,
 case when coalesce(mean_temp_c between -50 and 60, false) then null else 'mean_temp_c' end) as reasons from raw_weather""", ("raw_weather",))
def _(t):
    return N.validate_weather(t.raw_weather).withColumn("reasons", F.concat_ws(",", "reasons"))


WINDOWS = """select *, case when season = 'Short Rains' then make_date(year, 9, 1) else make_date(year, 2, 1) end as season_start,
 case when season = 'Short Rains' then make_date(year, 12, 31) else make_date(year, 5, 31) end as season_end from plots"""


@query("b11_season_window", "plot_id:i season_start:d season_end:d", WINDOWS, ("plots",))
def _(t):
    return N.season_windows(t.plots)


@query("b11_within_season", "plot_id:i date:d max_temp_c:f",
       f"select w.plot_id, date, max_temp_c from weather w join ({WINDOWS}) p on p.plot_id = w.plot_id and date between season_start and season_end",
       ("plots", "weather"))
def _(t):
    return N.within_season(t.weather, N.season_windows(t.plots))


@query("b11_missing_days", "plot_id:i date:d", f"""
select plot_id, date from (select plot_id, unnest(generate_series(season_start, season_end, interval 1 day))::date as date from ({WINDOWS})) e
where not exists (select 1 from weather w where w.plot_id = e.plot_id and w.date = e.date)""", ("plots", "weather"))
def _(t):
    return N.missing_days(t.weather, N.season_windows(t.plots))


@query("b12_find_planting_column", "plot_id:i planted:d",
       "select plot_id, inferred_planting_date as planted from planting", ("planting",))
def _(t):
    planting = P.infer_planting_dates(t.weather, t.plots)
    odd = planting.select("plot_id", F.col("inferred_planting_date").alias("When_Planted"))
    return odd.withColumnRenamed(N.find_planting_column(odd), "planted")


@query("b13_plot_defaults", "plot_id:i altitude:f season:s", "select plot_id, 1200 as altitude, 'Short Rains' as season from plots", ("plots",))
def _(t):
    return N.with_plot_defaults(t.plots.select("plot_id"))


@query("b14_plot_id", "l_orderkey:i l_linenumber:i plot_id:i", """
select l_orderkey, l_linenumber, case when l_quantity / 2 = floor(l_quantity / 2) then cast(l_quantity / 2 as bigint) end as plot_id from lineitem""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 2).cast("string").alias("plot_id"))
    return N.normalize_plot_id(rows)


@query("b15_utc_naive", "event_id:i ts:t", "select event_id, ts - interval 3 hour as ts from events")
def _(t):
    text = t.events.select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+03:00")).alias("ts"))
    return N.utc_naive(text, ["ts"])


@query("b16_cast_all_numeric", "plot_no:f latitude:f season:f", "select try_cast(plot_no as double) as plot_no, latitude, null as season from raw_plots", ("raw_plots",))
def _(t):
    return N.cast_all_numeric(t.raw_plots.withColumn("Unnamed: 0", F.lit(1)))


@query("b17_tidy_harvest_sheet", "Plot_No:i crop_type:s planting_date:d season:s county:s", """
select row_number() over (order by o_orderkey) as "Plot_No", o_orderpriority as crop_type, cast(o_orderdate as date) as planting_date,
 case when month(o_orderdate) between 3 and 5 then 'Long Rains' when month(o_orderdate) between 10 and 12 then 'Short Rains'
 else 'Off Season' end as season, o_orderstatus as county from orders""")
def _(t):
    sheet = t.orders.select(
        (F.col("o_orderkey") * 7 + 3).alias("key"), F.col("o_orderpriority").alias("boxes_crop"),
        F.col("o_orderdate").cast("date").cast("string").alias("boxes_planting_date"),
        F.col("o_orderstatus").alias("boxes_farmer_district"), F.lit("0,0").alias("boxes_box1_gps"))
    return N.tidy_harvest_sheet(sheet, "key")


@query("b17_farm_columns", "Plot_No:i Altitude:f crop_type:s planting_date:d season:s county:s columns:i", """
select row_number() over (order by o_orderkey) as "Plot_No", o_totalprice / 100 as "Altitude", o_orderpriority as crop_type, cast(o_orderdate as date) as planting_date,
 case when month(o_orderdate) between 3 and 5 then 'Long Rains' when month(o_orderdate) between 10 and 12 then 'Short Rains'
 else 'Off Season' end as season, o_orderstatus as county, 6 as columns from orders""")
def _(t):
    """The farm's own columns of a tidied sheet, in their order; weights and comments stay out."""
    sheet = t.orders.select(
        (F.col("o_orderkey") * 7 + 3).alias("key"), F.col("o_orderpriority").alias("boxes_crop"), F.lit(1.0).alias("wet_kgs_crop_box1"),
        F.col("o_orderdate").cast("date").cast("string").alias("boxes_planting_date"), (F.col("o_totalprice") / 100).alias("Altitude"),
        F.col("o_orderstatus").alias("boxes_farmer_district"), F.lit("0,0").alias("boxes_box1_gps"), F.lit("x").alias("comment"))
    farm = N.select_farm_columns(N.tidy_harvest_sheet(sheet, "key"))
    return farm.withColumn("columns", F.lit(len(farm.columns)))


@query("b18_validate_stages", "plot_id:i reasons:s", """
select plot_id, concat_ws(',', case when altitude is null then 'altitude' end, case when planting_date is null then 'planting_date' end,
 case when confidence between 0 and 1 then null else 'confidence' end) as reasons from stages""", ("stages",))
def _(t):
    stages = P.stage_dates_from_weather(t.weather, t.plots)
    return N.validate_stages(stages).withColumn("reasons", F.concat_ws(",", "reasons"))


@query("b18_validate_vt", "plot_id:i source:s reasons:s", "select plot_id, source, '' as reasons from vt", ("vt",))
def _(t):
    vt = P.vt_dates(P.stage_dates_from_weather(t.weather, t.plots))
    return N.validate_vt(vt).withColumn("reasons", F.concat_ws(",", "reasons"))


@query("b19_growing_period", "plot_no:s latitude:f planting_date:d", """
select plot_no, latitude, planting_date from raw_plots where latitude is not null and longitude is not null
 and c_custkey % 11 <> 1""", ("raw_plots",))
def _(t):
    rows = t.raw_plots.withColumnRenamed("boxes_planting_date", "Planting_Date ").withColumn("Wet_Completed_Time", F.lit("2022-01-01"))
    return N.require_growing_period(rows)


@query("b20_require_coordinates", "Plot_No:s latitude:f planting_date:d", """
select plot_no as "Plot_No", latitude, planting_date from raw_plots where latitude is not null and longitude is not null""", ("raw_plots",))
def _(t):
    rows = t.raw_plots.withColumnsRenamed({"boxes_planting_date": "planting_date", "Latitude": "latitude", "Longitude": "longitude"})
    return N.require_coordinates(rows)
