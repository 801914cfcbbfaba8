"""Adapters from the driver's tables to domain tables, in DataFrame form and as DuckDB CTEs.

Both forms are written by hand; the comparison of a query with its SQL twin covers the adapter too.
No adapter drops a row of its table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from agrospark.session import configure


class Tables:
    """The driver's tables of one scale factor, read on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # --- domain tables ---------------------------------------------------------------------

    @property
    def plots(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.supplier.select(
            (s + 1).alias("plot_id"),
            (F.lit(-1.0) + s * F.lit(0.001)).alias("latitude"),
            (F.lit(37.0) + (s % 25) * F.lit(0.05)).alias("longitude"),
            (F.lit(900.0) + F.col("s_acctbal") / 10).alias("altitude"),
            F.when(s % 2 == 0, "Short Rains").otherwise("Long Rains").alias("season"),
            (F.lit(1995) + s % 7).cast("int").alias("year"),
        )

    @property
    def raw_plots(self) -> DataFrame:
        """An untidy text plot list: two rows per plot, odd names, seasons and dates."""
        k = F.col("c_custkey")
        day = F.date_add(F.lit("2021-01-01").cast("date"), (k % 400).cast("int"))
        return self.customer.select(
            F.when(k % 50 == 7, F.concat(F.lit("x"), k.cast("string")))
            .otherwise((F.floor(k / 2) + 1).cast("string")).alias("Plot_No"),
            F.when(k % 61 != 3, (F.lit(-1.0) + k * F.lit(0.001)).cast("string")).alias("Latitude"),
            (F.lit(37.0) + F.col("c_nationkey") * F.lit(0.05)).cast("string").alias("Longitude"),
            (F.col("c_acctbal") + 1000).cast("string").alias("Altitude"),
            F.element_at(F.array(*[F.lit(v) for v in (
                "Short Rains", " short", "LR", "long-rains", "Off Season", None, "sr")]),
                (k % 7 + 1).cast("int")).alias("season"),
            F.when(k % 11 == 0, "n/a").when(k % 11 == 1, None)
            .when(k % 11 < 6, F.date_format(day, "M/d/yyyy"))
            .otherwise(F.date_format(day, "yyyy-MM-dd")).alias("boxes_planting_date"),
        )

    @property
    def weather(self) -> DataFrame:
        """One row per plot and day; partial aggregation absorbs busy plot-days before the shuffle."""
        s = F.col("l_suppkey")
        daily = self.lineitem.groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("date")).agg(
            F.max(F.col("l_quantity") * F.lit(0.6) - 3).alias("max_temp_c"),
            F.min(F.col("l_discount") * 250 - 5).alias("min_temp_c"),
            F.max(F.col("l_tax") * 200).alias("precip_mm"),
            F.max(F.col("l_partkey") % 100).cast("double").alias("humidity_pct"),
            F.max(F.col("l_extendedprice") / 5000).alias("solar_energy_mjm2"),
            F.max(F.col("l_linenumber") * F.lit(5.0)).alias("wind_speed_kmh"),
            F.min(F.col("l_orderkey") % 101).cast("double").alias("cloud_cover_pct"),
        )
        return daily.select(
            (s + 1).alias("plot_id"),
            (F.lit(-1.0) + s * F.lit(0.001)).alias("latitude"),
            (F.lit(37.0) + (s % 25) * F.lit(0.05)).alias("longitude"),
            "date", "max_temp_c", "min_temp_c",
            ((F.col("max_temp_c") + F.col("min_temp_c")) / 2).alias("mean_temp_c"),
            "precip_mm", "humidity_pct", "solar_energy_mjm2", "wind_speed_kmh", "cloud_cover_pct")

    @property
    def raw_weather(self) -> DataFrame:
        """Deliveries as they come: repeated plot-days, missing rain, impossible temperatures."""
        q = F.col("l_quantity") * F.lit(0.6) - 3
        return self.lineitem.select(
            (F.col("l_suppkey") + 1).alias("plot_id"),
            F.col("l_shipdate").cast("date").alias("date"),
            F.when(F.col("l_partkey") % 500 == 0, q + 60).when(F.col("l_partkey") % 500 != 1, q).alias("max_temp_c"),
            (F.col("l_discount") * 250 - 5).alias("min_temp_c"),
            ((q + F.col("l_discount") * 250 - 5) / 2).alias("mean_temp_c"),
            F.when(F.col("l_orderkey") % 97 != 0, F.col("l_tax") * 200).alias("precip_mm"),
        )

    @property
    def pixels(self) -> DataFrame:
        return self.lineitem.select(
            (F.col("l_suppkey") + 1).alias("plot_id"),
            F.col("l_shipdate").cast("date").alias("date"),
            F.col("l_linenumber").cast("long").alias("pixel_id"),
            (F.col("l_orderkey") % 100).cast("double").alias("cloud_pct"),
            F.col("l_tax").alias("B2"),
            F.col("l_discount").alias("B3"),
            (F.col("l_quantity") / 100).alias("B4"),
            ((F.col("l_partkey") % 100).cast("double") / 100).alias("B5"),
            (F.col("l_extendedprice") / 105000).alias("B8"),
            ((F.col("l_partkey") % 37).cast("double") / 37).alias("B11"),
        )

    @property
    def pixel_points(self) -> DataFrame:
        """Pixel centres scattered around the plot points."""
        k = F.col("c_custkey")
        return self.customer.select(
            k.alias("pixel_id"),
            (F.lit(-1.0) + F.floor(k / 15) * F.lit(0.001) + (k % 15 - 7) * F.lit(0.0001)).alias("latitude"),
            (F.lit(37.0) + (F.floor(k / 15) % 25) * F.lit(0.05) + F.col("c_nationkey") * F.lit(0.00002)).alias("longitude"),
        )

    @property
    def harvest(self) -> DataFrame:
        """Harvest sheet with text weights; every fifth row lacks its plot number."""
        line = F.col("l_linenumber")
        boxes = self.lineitem.groupBy("l_suppkey").agg(*[
            F.sum(F.when(line == i, F.col("l_quantity"))).alias(f"w{i}") for i in (1, 2, 3, 4)])
        s = F.col("s_suppkey")
        return (
            self.supplier.join(self.nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(boxes, F.col("l_suppkey") == s)
            .select(
                F.when(s % 5 != 0, s + 1).cast("string").alias("plot_no"),
                (F.lit(-1.0) + s * F.lit(0.001) + F.lit(0.0003)).alias("Latitude"),
                (F.lit(37.0) + (s % 25) * F.lit(0.05)).alias("Longitude"),
                F.col("n_name").alias("boxes_crop"),
                F.date_add(F.lit("1995-01-01").cast("date"), (s % 30).cast("int")).cast("string")
                .alias("boxes_planting_date"),
                F.col("w1").cast("string").alias("wet_kgs_crop_box1"),
                F.col("w2").cast("string").alias("wet_kgs_crop_box2"),
                F.when(s % 9 == 4, "12,x").otherwise(F.col("w3").cast("string")).alias("dry_box1_dry_weight"),
                F.when(s % 10 != 3, F.col("w4").cast("string")).alias("dry_box2_dry_weight"),
            )
        )

    @property
    def labels_in(self) -> DataFrame:
        """Typed labels as the joins take them."""
        s = F.col("s_suppkey")
        return self.supplier.select(
            F.when(s % 5 != 0, s + 1).alias("plot_id"),
            F.date_add(F.lit("1995-01-01").cast("date"), (s % 30).cast("int")).alias("Planting_Date"),
            (F.lit(-1.0) + s * F.lit(0.001) + F.lit(0.0003)).alias("latitude"),
            (F.lit(37.0) + (s % 25) * F.lit(0.05)).alias("longitude"),
            s.alias("label_no"),
        )

    @property
    def feature_rows(self) -> DataFrame:
        """Plot features with foreign ids, shifted dates and empty rows among them."""
        s = F.col("s_suppkey")
        shift = F.when(s % 3 == 1, 1).otherwise(0)
        empty = s % 11 == 0
        return self.supplier.select(
            F.when(s % 7 == 0, s + 1_000_001).otherwise(s + 1).alias("plot_id"),
            F.date_add(F.lit("1995-01-01").cast("date"), (s % 30 + shift).cast("int")).alias("planting_date"),
            (F.lit(-1.0) + s * F.lit(0.001) + F.when(s % 7 == 0, 0.0003).otherwise(0.0)).alias("latitude"),
            (F.lit(37.0) + (s % 25) * F.lit(0.05)).alias("longitude"),
            F.when(~empty, F.col("s_acctbal")).alias("precip_total"),
            F.when(~empty, s * F.lit(2.0)).alias("gdd_sum"),
        )

    @property
    def snapshots(self) -> DataFrame:
        e = F.col("event_id")
        return self.events.select(
            F.col("ts").cast("date").alias("ds"), F.col("user_id").alias("plot_id"), F.col("value").alias("gdd"),
            (e % 13).cast("double").alias("ndvi"), F.col("event_type").alias("stage"),
            F.when(e % 17 != 0, F.col("value") * 2).alias("precip"), e)

    @property
    def requests(self) -> DataFrame:
        return self.events.select(
            "ts", F.col("event_type").alias("endpoint"),
            F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
            (F.col("value") / 100).alias("latency_s"))

    @property
    def scores(self) -> DataFrame:
        price, k = F.col("o_totalprice"), F.col("o_orderkey")
        return self.orders.select(
            k.alias("row_id"), price.alias("actual"),
            (price * ((F.lit(90) + k % 21).cast("double") / 100)).alias("pred_a"),
            (price + (F.col("o_custkey") % 101).cast("double") * 10).alias("pred_b"))

    @property
    def score_requests(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.customer.select(
            k.alias("request_id"), (F.floor(k / 12) + 1).alias("plot_id"),
            (F.lit(-1.0) + F.floor(k / 12) * F.lit(0.001)).alias("latitude"), F.lit(37.0).alias("longitude"),
            F.date_add(F.lit("2021-01-01").cast("date"), (k % 400).cast("int")).alias("planting_date"),
            F.when(k % 3 == 0, "Long Rains").alias("season"),
            F.when(k % 4 == 1, 0.0).when(k % 4 > 1, F.col("c_acctbal")).alias("altitude"))


# Common table expressions; `needs` names the ones that must come before.
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (sql, needs)


cte("plots", """
select s_suppkey + 1 as plot_id, -1.0::double + s_suppkey * 0.001::double as latitude,
 37.0::double + (s_suppkey % 25) * 0.05::double as longitude, 900.0::double + s_acctbal / 10 as altitude,
 case when s_suppkey % 2 = 0 then 'Short Rains' else 'Long Rains' end as season, 1995 + s_suppkey % 7 as year
from supplier""")
cte("raw_plots", """
select case when c_custkey % 50 = 7 then 'x' || c_custkey else cast(c_custkey // 2 + 1 as varchar) end as plot_no,
 case when c_custkey % 61 <> 3 then -1.0::double + c_custkey * 0.001::double end as latitude,
 37.0::double + c_nationkey * 0.05::double as longitude, c_acctbal + 1000 as altitude,
 (['Short Rains', ' short', 'LR', 'long-rains', 'Off Season', null, 'sr'])[(c_custkey % 7 + 1)::int] as season,
 case when c_custkey % 11 >= 2 then date '2021-01-01' + (c_custkey % 400)::int end as planting_date, c_custkey
from customer""")
cte("weather", """
select l_suppkey + 1 as plot_id, -1.0::double + l_suppkey * 0.001::double as latitude,
 37.0::double + (l_suppkey % 25) * 0.05::double as longitude, d as date, max_temp_c, min_temp_c,
 (max_temp_c + min_temp_c) / 2 as mean_temp_c, precip_mm, humidity_pct, solar_energy_mjm2, wind_speed_kmh, cloud_cover_pct
from (select l_suppkey, cast(l_shipdate as date) as d, max(l_quantity * 0.6::double - 3) as max_temp_c,
 min(l_discount * 250 - 5) as min_temp_c, max(l_tax * 200) as precip_mm, max(l_partkey % 100)::double as humidity_pct,
 max(l_extendedprice / 5000) as solar_energy_mjm2, max(l_linenumber * 5.0::double) as wind_speed_kmh,
 min(l_orderkey % 101)::double as cloud_cover_pct from lineitem group by l_suppkey, cast(l_shipdate as date))""")
cte("raw_weather", """
select l_suppkey + 1 as plot_id, cast(l_shipdate as date) as date,
 case when l_partkey % 500 = 0 then l_quantity * 0.6::double - 3 + 60
      when l_partkey % 500 <> 1 then l_quantity * 0.6::double - 3 end as max_temp_c,
 l_discount * 250 - 5 as min_temp_c, (l_quantity * 0.6::double - 3 + l_discount * 250 - 5) / 2 as mean_temp_c,
 case when l_orderkey % 97 <> 0 then l_tax * 200 end as precip_mm from lineitem""")
cte("pixels", """
select l_suppkey + 1 as plot_id, cast(l_shipdate as date) as date, l_linenumber as pixel_id,
 (l_orderkey % 100)::double as cloud_pct, l_tax as blue, l_discount as green, l_quantity / 100 as red,
 (l_partkey % 100)::double / 100 as red_edge, l_extendedprice / 105000 as nir, (l_partkey % 37)::double / 37 as swir
from lineitem""")
cte("pixel_points", """
select c_custkey as pixel_id,
 -1.0::double + (c_custkey // 15) * 0.001::double + (c_custkey % 15 - 7) * 0.0001::double as latitude,
 37.0::double + ((c_custkey // 15) % 25) * 0.05::double + c_nationkey * 0.00002::double as longitude from customer""")
cte("harvest", """
select case when s_suppkey % 5 <> 0 then s_suppkey + 1 end as plot_id,
 -1.0::double + s_suppkey * 0.001::double + 0.0003::double as latitude,
 37.0::double + (s_suppkey % 25) * 0.05::double as longitude, n_name as crop_type,
 date '1995-01-01' + (s_suppkey % 30)::int as planting_date, b.w1, b.w2,
 case when s_suppkey % 9 <> 4 then b.w3 end as w3, case when s_suppkey % 10 <> 3 then b.w4 end as w4
from supplier join nation on s_nationkey = n_nationkey join (select l_suppkey,
 sum(case when l_linenumber = 1 then l_quantity end) as w1, sum(case when l_linenumber = 2 then l_quantity end) as w2,
 sum(case when l_linenumber = 3 then l_quantity end) as w3, sum(case when l_linenumber = 4 then l_quantity end) as w4
 from lineitem group by l_suppkey) b on l_suppkey = s_suppkey""")
cte("labels_in", """
select case when s_suppkey % 5 <> 0 then s_suppkey + 1 end as plot_id,
 date '1995-01-01' + (s_suppkey % 30)::int as planting_date,
 -1.0::double + s_suppkey * 0.001::double + 0.0003::double as latitude,
 37.0::double + (s_suppkey % 25) * 0.05::double as longitude, s_suppkey as label_no from supplier""")
cte("feature_rows", """
select case when s_suppkey % 7 = 0 then s_suppkey + 1000001 else s_suppkey + 1 end as plot_id,
 date '1995-01-01' + (s_suppkey % 30 + case when s_suppkey % 3 = 1 then 1 else 0 end)::int as planting_date,
 -1.0::double + s_suppkey * 0.001::double + case when s_suppkey % 7 = 0 then 0.0003::double else 0.0::double end as latitude,
 37.0::double + (s_suppkey % 25) * 0.05::double as longitude,
 case when s_suppkey % 11 <> 0 then s_acctbal end as precip_total,
 case when s_suppkey % 11 <> 0 then s_suppkey * 2.0::double end as gdd_sum from supplier""")
cte("snapshots", """
select cast(ts as date) as ds, user_id as plot_id, value as gdd, (event_id % 13)::double as ndvi, event_type as stage,
 case when event_id % 17 <> 0 then value * 2 end as precip, event_id from events""")
cte("requests", """
select ts, event_type as endpoint, case when event_type = 'error' then 500 else 200 end as status,
 value / 100 as latency_s from events""")
cte("scores", """
select o_orderkey as row_id, o_totalprice as actual, o_totalprice * ((90 + o_orderkey % 21)::double / 100) as pred_a,
 o_totalprice + (o_custkey % 101)::double * 10 as pred_b from orders""")
cte("score_requests", """
select c_custkey as request_id, c_custkey // 12 + 1 as plot_id, -1.0::double + (c_custkey // 12) * 0.001::double as latitude,
 37.0::double as longitude, date '2021-01-01' + (c_custkey % 400)::int as planting_date,
 case when c_custkey % 3 = 0 then 'Long Rains' end as season,
 case when c_custkey % 4 = 1 then 0.0::double when c_custkey % 4 > 1 then c_acctbal end as altitude from customer""")
# Derived tables of the agronomic chain.
cte("planting", """
select f.plot_id, f.d + f.delay as inferred_planting_date, f.delay as altitude_adjustment_days, f.altitude, f.season,
 least(0.7::double + case when precip_mm - 5 > 10 then 0.15::double when precip_mm - 5 > 5 then 0.10::double else 0 end
 + case when (max_temp_c + min_temp_c) / 2 - 18 > 5 then 0.15::double when (max_temp_c + min_temp_c) / 2 - 18 > 2 then 0.10::double else 0 end, 1.0::double)
 as confidence_score
from (select g.plot_id, d, p.altitude, p.season,
  case when coalesce(p.altitude, 1200) <= 1200 then 0 else cast(floor((p.altitude - 1200) / 100) as int) end as delay
  from (select plot_id, min(date) as d from weather where precip_mm >= 5 and (max_temp_c + min_temp_c) / 2 >= 18 group by plot_id) g
  left join plots p on p.plot_id = g.plot_id) f
join weather w on w.plot_id = f.plot_id and w.date = f.d""", "plots", "weather")
cte("cumulative", """
select *, case when date >= planting_date then sum(case when date >= planting_date
  then cast(daily_gdd as decimal(18,6)) else 0 end) over (partition by plot_id order by date rows unbounded preceding) end as cum
from (select w.*, p.inferred_planting_date as planting_date, p.altitude, p.season,
  greatest((max_temp_c + min_temp_c) / 2 - 10, 0) as daily_gdd from weather w left join planting p on p.plot_id = w.plot_id)""",
    "weather", "planting")
cte("thresholds", """
select * from (values ('early', 80, 150, 350, 850, 950, 1150, 1300), ('medium', 100, 180, 400, 1000, 1100, 1350, 1500),
 ('late', 120, 210, 450, 1150, 1250, 1550, 1800)) t(cls, ve, v2, v6, vt, r1, r4, r6)""")
cte("stages", """
select *, least(round((ve_n + v2_n + v6_n + vt_n + r1_n + r4_n + r6_n) / 7.0::double + vt_n * 0.2::double, 2), 1.0) as confidence
from (select *, ("VE" is not null)::int as ve_n, ("V2" is not null)::int as v2_n, ("V6" is not null)::int as v6_n,
 ("VT" is not null)::int as vt_n, ("R1" is not null)::int as r1_n, ("R4" is not null)::int as r4_n, ("R6" is not null)::int as r6_n
 from (select plot_id, arg_min(latitude, date) as latitude, arg_min(longitude, date) as longitude, any_value(altitude) as altitude,
  any_value(season) as season, any_value(planting_date) as planting_date,
  min(date) filter (cum >= ve) as "VE", min(date) filter (cum >= v2) as "V2", min(date) filter (cum >= v6) as "V6",
  min(date) filter (cum >= vt) as "VT", min(date) filter (cum >= r1) as "R1", min(date) filter (cum >= r4) as "R4",
  min(date) filter (cum >= r6) as "R6"
  from cumulative c join thresholds t on t.cls = case when c.altitude < 1200 then 'early' when c.altitude <= 1600 then 'medium' else 'late' end
  where planting_date is not null group by plot_id))""", "cumulative", "thresholds")
cte("vt", """
select plot_id, coalesce("VT", "R1", planting_date + 55) as vt_stage_date, planting_date,
 case when "VT" is not null then 'gdd_calculated' when "R1" is not null then 'r1_fallback' else 'estimated' end as source,
 case when "VT" is not null then confidence when "R1" is not null then greatest(confidence - 0.2::double, 0)
  else greatest(confidence - 0.4::double, 0) end as confidence,
 case when "VT" is not null then null when "R1" is not null then 'VT_not_found_used_R1' else 'VT_not_found_estimated_55_days' end as note
from stages""", "stages")
cte("indexed", """
select plot_id, date, pixel_id, (nir - red) / nullif(nir + red, 0) as ndvi,
 (nir - red) * 2.5::double / nullif(nir + red * 6 - blue * 7.5::double + 1, 0) as evi,
 (nir - red) / nullif(nir + red + 0.5::double, 0) * 1.5::double as savi,
 (nir - red_edge) / nullif(nir + red_edge, 0) as ndre, (green - nir) / nullif(green + nir, 0) as ndwi,
 (nir - swir) / nullif(nir + swir, 0) as ndmi from pixels where cloud_pct < 60""", "pixels")
cte("samples", """
select plot_id, planting_date, vt_date, n as sample_no, planting_date + (n * 5)::int as sample_date
from (select s.plot_id, s.planting_date, case when v.vt_stage_date >= s.planting_date then v.vt_stage_date else s.planting_date + 60 end as vt_date,
 unnest(generate_series(0, ((case when v.vt_stage_date >= s.planting_date then v.vt_stage_date else s.planting_date + 60 end) - s.planting_date) // 5)) as n
 from stages s left join vt v on v.plot_id = s.plot_id)""", "stages", "vt")
cte("matched", """
select i.*, s.sample_date from samples s join indexed i on i.plot_id = s.plot_id
 and i.date >= s.sample_date - 10 and i.date < s.sample_date + 10""", "samples", "indexed")
IDX = ("ndvi", "evi", "savi", "ndre", "ndwi", "ndmi")
cte("median_image", "select plot_id, sample_date, pixel_id, " + ", ".join(f"median({i}) as {i}" for i in IDX)
    + " from matched group by plot_id, sample_date, pixel_id", "matched")
cte("image_stats", "select plot_id, sample_date, " + ", ".join(
    f"avg({i}) as mean_{i}, stddev_pop({i}) as std_{i}, min({i}) as min_{i}, max({i}) as max_{i}" for i in IDX)
    + " from median_image group by plot_id, sample_date", "median_image")
cte("sat", "select *, " + ", ".join(
    f"sum(coalesce(mean_{i}, 0)) over (partition by plot_id order by sample_date rows unbounded preceding) as cumulative_{i}"
    for i in IDX) + " from image_stats", "image_stats")
cte("daily", "select c.plot_id, c.date, c.latitude, c.longitude, c.max_temp_c, c.min_temp_c, c.precip_mm, c.daily_gdd, "
    "c.cum::double as gdd_cumulative, c.date - c.planting_date as days_since_planting, "
    "case when c.date < s.planting_date then 'pre_planting' when c.date >= \"R6\" then 'R6' when c.date >= \"R4\" then 'R4' "
    "when c.date >= \"R1\" then 'R1' when c.date >= \"VT\" then 'VT' when c.date >= \"V6\" then 'V6' when c.date >= \"V2\" then 'V2' "
    "when c.date >= \"VE\" then 'VE' when s.planting_date is not null then 'post_planting_pre_VE' else 'unknown' end as current_stage, "
    + ", ".join(f"m.mean_{i}, m.cumulative_{i}" for i in IDX)
    + " from cumulative c left join stages s on s.plot_id = c.plot_id left join sat m on m.plot_id = c.plot_id and m.sample_date = c.date",
    "cumulative", "stages", "sat")


def _with(names: tuple[str, ...]) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][1]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return "with " + ",\n".join(f"{n} as ({CTES[n][0].strip()})" for n in ordered) + "\n" if ordered else ""


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}

# Output types of a spec "name:type": i whole number, f double to 6 places (f<k> to k), d day,
# t time to the second, s text, b truth value.


def _spark_column(name: str, kind: str):
    col = F.col(f"`{name}`")
    if kind == "i":
        return col.cast("long").alias(name)
    if kind.startswith("f"):
        return (F.round(col.cast("double"), int(kind[1:] or 6)) + F.lit(0.0)).alias(name)
    if kind == "d":
        return F.date_format(col, "yyyy-MM-dd").alias(name)
    if kind == "t":
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(name)
    return col.cast("boolean" if kind == "b" else "string").alias(name)


def _sql_column(name: str, kind: str) -> str:
    col = f'"{name}"'
    if kind == "i":
        text = f"cast({col} as bigint)"
    elif kind.startswith("f"):
        text = f"round(cast({col} as double), {int(kind[1:] or 6)}) + 0.0::double"
    elif kind == "d":
        text = f"strftime(cast({col} as date), '%Y-%m-%d')"
    elif kind == "t":
        text = f"strftime(cast({col} as timestamp), '%Y-%m-%d %H:%M:%S')"
    else:
        text = f"cast({col} as {'boolean' if kind == 'b' else 'varchar'})"
    return f"{text} as {col}"


def _parse(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.rsplit(":", 1)) for part in spec.split()]


def query(name: str, spec: str, sql: str | None = None, needs: tuple[str, ...] = ()):
    """Register a query: a function of Tables, its output columns, and its SQL twin."""
    columns = _parse(spec)

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir)).select(*[_spark_column(n, k) for n, k in columns])

        twin = None
        if sql is not None:
            shown = ", ".join(_sql_column(n, k) for n, k in columns)
            twin = f"{_with(needs)}select {shown} from ({sql.strip()}) q"
        REGISTRY[name] = Query(run, twin)
        return fn
    return register
