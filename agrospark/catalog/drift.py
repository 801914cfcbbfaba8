"""I: drift of a day's features against the days before."""

from pyspark.sql import functions as F

from agrospark.catalog.base import Tables, query
from agrospark.operators import drift as D
from agrospark.sources import files, snapshots as A

NUMERIC = ("gdd", "ndvi", "precip")


def sides(t: Tables):
    table = t.snapshots.drop("event_id")
    return (A.union_last_n(table).drop("ds"), A.resolve_snapshot(table).drop("ds"))


NUMERIC_SQL = """
with v as (select ds = (select max(ds) from snapshots) as cur, unnest(['gdd', 'ndvi', 'precip']) as feature, unnest([gdd, ndvi, precip]) as value
  from snapshots where ds = (select max(ds) from snapshots) or ds in (select ds from (select distinct ds from snapshots) order by ds desc limit 31)),
 e as (select feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as edges
  from v where not cur and value is not null group by feature),
 b as (select v.feature, len(list_filter(edges, lambda x: x <= value)) as bin, count(*) filter (not cur) as r, count(*) filter (cur) as c
  from v join e on e.feature = v.feature where value is not null group by 1, 2),
 s as (select feature, case when r = 0 then 1e-6::double else r / sum(r) over (partition by feature) end as rs,
  case when c = 0 then 1e-6::double else c / sum(c) over (partition by feature) end as cs from b)
select feature, sum((cs - rs) * ln(cs / rs)) as psi from s group by feature"""
CATEGORY_SQL = """
with v as (select ds = (select max(ds) from snapshots) as cur, stage as value from snapshots),
 b as (select value, count(*) filter (not cur) as r, count(*) filter (cur) as c from v where value is not null group by 1),
 s as (select case when r = 0 then 1e-6::double else r / sum(r) over () end as rs, case when c = 0 then 1e-6::double else c / sum(c) over () end as cs from b)
select 'stage' as feature, sum((cs - rs) * ln(cs / rs)) as psi from s"""
RATES = """select unnest(['gdd', 'ndvi', 'precip', 'stage']) as feature,
 unnest([avg((gdd is null)::int) filter (not cur), avg((ndvi is null)::int) filter (not cur), avg((precip is null)::int) filter (not cur), avg((stage is null)::int) filter (not cur)]) as missing_ref,
 unnest([avg((gdd is null)::int) filter (cur), avg((ndvi is null)::int) filter (cur), avg((precip is null)::int) filter (cur), avg((stage is null)::int) filter (cur)]) as missing_cur
 from (select *, ds = (select max(ds) from snapshots) as cur from snapshots)"""
REPORT = f"""select p.*, r.missing_ref, r.missing_cur, case when psi >= 0.25 then 'high' when psi >= 0.1 then 'medium' else 'low' end as level
 from (select *, 'numeric' as type from ({NUMERIC_SQL}) union all select *, 'categorical' as type from ({CATEGORY_SQL})) p
 join ({RATES}) r on r.feature = p.feature"""
REPORT_SPEC = "feature:s type:s psi:f missing_ref:f missing_cur:f level:s"


@query("i1_choose_features", "feature:s type:s present:i", """
select unnest(['gdd', 'ndvi', 'precip', 'stage']) as feature, unnest(['numeric', 'numeric', 'numeric', 'categorical']) as type,
 unnest([count(gdd), count(ndvi), count(precip), count(stage)]) as present from snapshots""", ("snapshots",))
def _(t):
    kinds = D.feature_types(t.snapshots.drop("event_id", "ds"))
    present = t.snapshots.agg(*[F.count(c).alias(c) for c in kinds]).unpivot([], list(kinds), "feature", "present")
    return present.withColumn("type", F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])[F.col("feature")])


@query("i2_numeric_psi", "feature:s psi:f", NUMERIC_SQL, ("snapshots",))
def _(t):
    return D.numeric_psi(*sides(t), NUMERIC)


SMALL_SQL = """
with v as (select event_id % 4 = 0 as cur, 1e-12::double * (event_id * 7919 % 1000 + case when event_id % 4 = 0 then 500 else 0 end) as value from events),
 e as (select quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as edges from v where not cur),
 b as (select len(list_filter(edges, lambda x: x <= value)) as bin, count(*) filter (not cur) as r, count(*) filter (cur) as c from v, e group by 1),
 s as (select case when r = 0 then 1e-6::double else r / sum(r) over () end as rs, case when c = 0 then 1e-6::double else c / sum(c) over () end as cs from b)
select 'value' as feature, sum((cs - rs) * ln(cs / rs)) as psi from s"""


@query("i2_psi_of_a_small_feature", "feature:s psi:f", SMALL_SQL)
def _(t):
    current = F.col("event_id") % 4 == 0
    number = F.col("event_id") * 7919 % 1000 + F.when(current, 500).otherwise(0)
    rows = t.events.select(current.alias("cur"), (F.lit(1e-12) * number).alias("value"))
    return D.numeric_psi(rows.where(~F.col("cur")), rows.where("cur"), ["value"])


@query("i2_bin_edges", "feature:s edge:f", """
select feature, unnest(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) as edge from (
 select unnest(['l_quantity', 'l_extendedprice', 'l_discount']) as feature, unnest([l_quantity, l_extendedprice, l_discount]) as value
 from lineitem) group by feature""")
def _(t):
    edges = D.bin_edges(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    return edges.select("feature", F.explode("edges").alias("edge"))


@query("i3_categorical_psi", "feature:s psi:f", CATEGORY_SQL, ("snapshots",))
def _(t):
    return D.categorical_psi(*sides(t), ["stage"])


@query("i4_drift_report", REPORT_SPEC, REPORT, ("snapshots",))
def _(t):
    return D.drift_report(*sides(t))


@query("i5_drift_summary", "ds:s status:s n_features:i n_high:i n_medium:i alert:s", f"""
select '2024-01-30' as ds, 'ok' as status, count(*) as n_features, count(*) filter (level = 'high') as n_high,
 count(*) filter (level = 'medium') as n_medium, case when count(*) filter (level = 'high') > 0 then 'high_drift' else 'none' end as alert
from ({REPORT})""", ("snapshots",))
def _(t):
    return D.drift_summary(D.drift_report(*sides(t)), "2024-01-30")


@query("i6_top_drift", REPORT_SPEC, f"select * from ({REPORT}) order by psi desc, feature limit 20", ("snapshots",))
def _(t):
    return D.top_drift(D.drift_report(*sides(t)))


@query("i4_report_from_sketches", REPORT_SPEC, REPORT, ("snapshots",))
def _(t):
    """The report from sketches and category counts that were stored day by day."""
    reference, current = sides(t)
    numeric, other = D.choose_features(current)
    root = files.scratch_dir(t.spark, "sketches")
    for name, rows in (("ref", reference), ("cur", current)):
        D.category_counts(rows, other).write.parquet(f"{root}/categories/{name}")
    # Several parts of the reference, as days are.
    for k in range(3):
        D.sketches(reference.where(F.pmod(F.xxhash64("plot_id", "gdd"), F.lit(3)) == k), numeric).write.mode("append").parquet(f"{root}/sketches")
    stored = tuple(t.spark.read.parquet(f"{root}/categories/{n}") for n in ("ref", "cur"))
    return D.drift_report(reference, current, sketch=D.merged(t.spark.read.parquet(f"{root}/sketches")), categories=stored)
