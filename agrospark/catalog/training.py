"""G: yield labels and training-set joins."""

from pyspark.sql import functions as F

from agrospark.catalog.base import query
from agrospark.catalog.sources import LABEL_SPEC, LABEL_SQL
from agrospark.operators import training_set as G

NEAREST = """select l.label_no, coalesce(l.plot_id, n.plot_id) as plot_id from labels_in l left join (
 select label_no, arg_min(pid, (d, pid)) as plot_id from (select l.label_no, f.plot_id as pid,
  sqrt(pow(l.latitude - f.latitude, 2) + pow(l.longitude - f.longitude, 2)) as d from labels_in l
  join feature_rows f on abs(l.latitude - f.latitude) <= 0.0101 where l.plot_id is null) where d <= 0.01 group by label_no) n
 on n.label_no = l.label_no"""
FEATURES = "precip_total:f gdd_sum:f"


@query("g1_yield_labels", LABEL_SPEC, LABEL_SQL, ("harvest",))
def _(t):
    return G.yield_labels(t.harvest)


@query("g2_nearest_plot", "label_no:i plot_id:i", NEAREST, ("labels_in", "feature_rows"))
def _(t):
    return G.assign_nearest_plot(t.labels_in, t.feature_rows)


@query("g2_nearest_point_all", "pixel_id:i plot_id:i", """
select x.pixel_id, arg_min(pid, (d, pid)) as plot_id from pixel_points x left join (select x.pixel_id, p.plot_id as pid,
 sqrt(pow(x.latitude - p.latitude, 2) + pow(x.longitude - p.longitude, 2)) as d from pixel_points x
 join plots p on abs(x.latitude - p.latitude) <= 0.0101 where sqrt(pow(x.latitude - p.latitude, 2) + pow(x.longitude - p.longitude, 2)) <= 0.01) n
 on n.pixel_id = x.pixel_id group by x.pixel_id""", ("pixel_points", "plots"))
def _(t):
    points = t.pixel_points.withColumn("plot_id", F.lit(None).cast("long"))
    return G.assign_nearest_plot(points, t.plots)


@query("g2_nearest_in_a_crowd", "label_no:i plot_id:i", """
with x as (select s_suppkey as label_no, -1.0::double + (s_suppkey % 10) * 0.0011::double as latitude, 37.0::double + (s_suppkey // 10) * 0.0007::double as longitude from supplier),
 p as (select c_custkey as plot_id, -0.995::double + (c_custkey * 7919 % 10007) * 0.00000002::double as latitude,
  37.003::double + (c_custkey * 104729 % 10009) * 0.00000002::double as longitude from customer),
 d as (select label_no, plot_id, sqrt(pow(x.latitude - p.latitude, 2) + pow(x.longitude - p.longitude, 2)) as d from x, p)
select x.label_no, n.plot_id from x left join (select label_no, arg_min(plot_id, (d, plot_id)) as plot_id from d where d <= 0.01 group by 1) n on n.label_no = x.label_no""")
def _(t):
    """All plots within some twenty metres, seen by the labels from up to a kilometre away."""
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    labels = t.supplier.select(s.alias("label_no"), F.lit(None).cast("bigint").alias("plot_id"), (F.lit(-1.0) + (s % 10) * F.lit(0.0011)).alias("latitude"),
                               (F.lit(37.0) + F.floor(s / 10) * F.lit(0.0007)).alias("longitude"))
    plots = t.customer.select(c.alias("plot_id"), (F.lit(-0.995) + (c * 7919 % 10007) * F.lit(0.00000002)).alias("latitude"),
                              (F.lit(37.003) + (c * 104729 % 10009) * F.lit(0.00000002)).alias("longitude"))
    return G.assign_nearest_plot(labels, plots).select("label_no", "plot_id")


@query("g3_join_plot_and_date", f"label_no:i plot_id:i {FEATURES}", """
select l.label_no, l.plot_id, f.precip_total, f.gdd_sum from labels_in l left join feature_rows f
 on f.plot_id = l.plot_id and f.planting_date = l.planting_date""", ("labels_in", "feature_rows"))
def _(t):
    return G.join_on_plot_and_date(t.labels_in, t.feature_rows)


@query("g3_join_null_safe", f"event_id:i {FEATURES}", """
select e.event_id, f.precip_total, f.gdd_sum from (select event_id, nullif(user_id % 40, 0) as plot_id, date '1995-01-01' + (user_id % 30)::int as d from events) e
 left join (select k, planting_date, m[2] as precip_total, m[4] as gdd_sum from (select nullif(plot_id % 40, 0) as k, planting_date,
  min((precip_total is null, precip_total, gdd_sum is null, gdd_sum)) as m from feature_rows group by 1, 2)) f
 on f.k is not distinct from e.plot_id and f.planting_date = e.d""", ("feature_rows",))
def _(t):
    day = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("user_id") % 30).cast("int"))
    labels = t.events.select("event_id", F.expr("nullif(user_id % 40, 0)").alias("plot_id"), day.alias("Planting_Date"))
    features = t.feature_rows.select(
        F.expr("nullif(plot_id % 40, 0)").alias("plot_id"), "planting_date", "precip_total", "gdd_sum")
    return G.join_on_plot_and_date(labels, features, null_safe=True)


G3_SQL = """
select l.label_no, l.plot_id, f.precip_total, f.gdd_sum from labels_in l left join feature_rows f
 on f.plot_id = l.plot_id and f.planting_date = l.planting_date"""
G4_SQL = """
select l.label_no, l.plot_id, f.precip_total, f.gdd_sum from labels_in l left join feature_rows f on f.plot_id = l.plot_id"""


def repeated_features(t):
    """Every feature row a second time, without its values: the full one must win."""
    rows = t.feature_rows
    return rows.unionByName(rows.withColumns({c: F.lit(None).cast("double") for c in ("precip_total", "gdd_sum")}))


@query("g3_join_repeated_features", f"label_no:i plot_id:i {FEATURES}", G3_SQL, ("labels_in", "feature_rows"))
def _(t):
    return G.join_on_plot_and_date(t.labels_in, repeated_features(t))


@query("g4_join_repeated_features", f"label_no:i plot_id:i {FEATURES}", G4_SQL, ("labels_in", "feature_rows"))
def _(t):
    return G.join_on_plot(t.labels_in, repeated_features(t))


@query("g4_join_plot", f"label_no:i plot_id:i {FEATURES}", """
select l.label_no, l.plot_id, f.precip_total, f.gdd_sum from labels_in l left join feature_rows f on f.plot_id = l.plot_id""",
       ("labels_in", "feature_rows"))
def _(t):
    return G.join_on_plot(t.labels_in, t.feature_rows)


COORDS = """round(f.latitude, 4) = round(l.latitude, 4) and round(f.longitude, 4) = round(l.longitude, 4)
 and f.planting_date = l.planting_date"""


@query("g5_join_coordinates", f"label_no:i plot_id:i {FEATURES}", f"""
select l.label_no, l.plot_id, f.precip_total, f.gdd_sum from labels_in l left join feature_rows f on {COORDS}""",
       ("labels_in", "feature_rows"))
def _(t):
    return G.join_on_coordinates(t.labels_in, t.feature_rows)


@query("g5_join_repeated_features", f"label_no:i plot_id:i {FEATURES}", f"""
select l.label_no, l.plot_id, f.precip_total, f.gdd_sum from labels_in l left join feature_rows f on {COORDS}""",
       ("labels_in", "feature_rows"))
def _(t):
    return G.join_on_coordinates(t.labels_in, repeated_features(t))


TIERS = f"""select l.label_no, a.precip_total as p1, b.precip_total as p2, c.precip_total as p3,
 a.gdd_sum as g1, b.gdd_sum as g2, c.gdd_sum as g3 from labels_in l
 left join feature_rows a on a.plot_id = l.plot_id and a.planting_date = l.planting_date
 left join feature_rows b on b.plot_id = l.plot_id
 left join (select label_no as no3, f.precip_total, f.gdd_sum from labels_in l join feature_rows f on {COORDS}) c on c.no3 = l.label_no"""


@query("g6_merge_row_mode", f"label_no:i {FEATURES} match_tier:i", f"""
select label_no, coalesce(p1, p2, p3) as precip_total, coalesce(g1, g2, g3) as gdd_sum,
 case when p1 is not null then 1 when p2 is not null then 2 when p3 is not null then 3 else 0 end as match_tier from ({TIERS})""",
       ("labels_in", "feature_rows"))
def _(t):
    return G.merge_features(t.labels_in, t.feature_rows, "row")


@query("g6_merge_table_mode", f"label_no:i {FEATURES} match_tier:i", f"""
with x as ({TIERS}), s as (select case when count(*) filter (p1 is null) = 0 then 1 when count(*) filter (p2 is null) = 0 then 2 else 3 end as step from x)
select label_no, case step when 1 then p1 when 2 then p2 else p3 end as precip_total,
 case step when 1 then g1 when 2 then g2 else g3 end as gdd_sum,
 case when case step when 1 then p1 when 2 then p2 else p3 end is not null then step else 0 end as match_tier from x, s""",
       ("labels_in", "feature_rows"))
def _(t):
    return G.merge_features(t.labels_in, t.feature_rows, "table")


@query("g7_tidy_keys", "plot_id:i label_no:i", "select plot_id, label_no from labels_in", ("labels_in",))
def _(t):
    return G.tidy_keys(t.labels_in.withColumnRenamed("plot_id", "plot_no").withColumn("Unnamed: 0", F.lit(0)))
