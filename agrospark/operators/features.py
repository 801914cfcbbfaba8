"""Daily and plot-level feature tables, point-in-time lookups and defaults for scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from agrospark import schemas as S
from agrospark.functions import columns as C
from agrospark.functions.ordering import number_rows
from agrospark.operators import phenology as P

MEANS = tuple(f"mean_{i}" for i in S.INDICES)
CUMULATIVES = tuple(f"cumulative_{i}" for i in S.INDICES)
PLOT_RENAMES = {"precip_mm": "precip_total", "daily_gdd": "gdd_sum", "gdd_cumulative": "gdd_peak"}
# What a plot without features is scored with.
SCORING_DEFAULTS = {
    "precip_total": 0.0, "gdd_sum": 0.0, "gdd_peak": 0.0,
    "mean_ndvi": 0.0, "mean_evi": 0.0, "days_to_vt": 0,
}


def one_per_plot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The least row per plot by a total order, missing values last, as a partial aggregate."""
    return df.groupBy("plot_id").agg(F.min(C.complete_row(columns)).alias("row")).select(
        "plot_id", *[F.col(f"row.`{c}`").alias(c) for c in columns])


def daily_features(
    weather: DataFrame, planting: DataFrame, stages: DataFrame, indices: DataFrame | None = None,
    dedupe: bool = True, base: float = S.GDD_BASE_C, buckets: int | None = None,
) -> DataFrame:
    """One row per plot-day with GDD, stage label and the indices of sample days.

    Days and samples are placed by plot_id once; the joins on plot and on (plot, date) and the
    running sum all work on that placement. Duplicate plots or samples on the right are reduced to
    one unless `dedupe` is off. Tables that lie in that many `buckets` by plot_id stay where they are.
    """
    place = [buckets, "plot_id"] if buckets else ["plot_id"]
    planted = planting.withColumnsRenamed(
        {"inferred_planting_date": "planting_date"}).select("plot_id", "planting_date")
    calendar = stages.select("plot_id", "planting_date", *S.STAGES)
    if dedupe:
        planted = planted.groupBy("plot_id").agg(F.min("planting_date").alias("planting_date"))
        calendar = one_per_plot(calendar, ["planting_date", *S.STAGES])
    days = weather.select(
        "plot_id", "date", "latitude", "longitude", "max_temp_c", "min_temp_c", "precip_mm"
    ).repartition(*place)
    extra: list[str] = []
    if indices is not None:
        extra = [c for pair in zip(MEANS, CUMULATIVES) for c in pair if c in indices.columns]
        samples = indices.select("plot_id", "date", *extra).repartition(*place)
        if dedupe:
            samples = samples.groupBy("plot_id", "date").agg(F.min(C.complete_row(extra)).alias("row")).select(
                "plot_id", "date", *[F.col(f"row.`{c}`").alias(c) for c in extra])
        days = days.join(samples, ["plot_id", "date"], "left")
    days = P.with_current_stage(days.join(planted, "plot_id", "left"), calendar)
    days = P.with_cumulative_gdd(P.with_daily_gdd(days, base))
    return P.with_days_since_planting(days).select(
        "plot_id", "date", "latitude", "longitude", "max_temp_c", "min_temp_c", "precip_mm",
        "daily_gdd", "gdd_cumulative", "days_since_planting", "current_stage", *extra)


def plot_totals(daily: DataFrame, since_planting: bool = False) -> DataFrame:
    """Rain and GDD totals, peak GDD, first known coordinates and index means per plot."""
    def first_known(c: str) -> Column:
        return F.min_by(c, F.when(F.col(c).isNotNull(), F.col("date"))).alias(c)

    if since_planting:
        daily = daily.where(F.col("days_since_planting") >= 0)
    return daily.groupBy("plot_id").agg(
        F.coalesce(F.sum("precip_mm"), F.lit(0.0)).alias("precip_total"),
        F.coalesce(F.sum("daily_gdd"), F.lit(0.0)).alias("gdd_sum"),
        F.max("gdd_cumulative").alias("gdd_peak"),
        first_known("latitude"),
        first_known("longitude"),
        *[F.avg(c).alias(c) for c in MEANS if c in daily.columns],
    )


def plot_features(daily: DataFrame, stages: DataFrame, since_planting: bool = False) -> DataFrame:
    """Totals with planting date, VT, days to VT and what the stage table knows of the plot."""
    known = [c for c in ("confidence", "season", "altitude") if c in stages.columns]
    calendar = one_per_plot(stages, ["planting_date", "VT", *known])
    return (
        plot_totals(daily, since_planting).join(calendar, "plot_id", "left")
        .withColumn("days_to_vt", F.datediff("VT", "planting_date"))
    )


def index_totals(indices: DataFrame) -> DataFrame:
    """Sum of every mean and the last running NDVI per plot."""
    return indices.groupBy("plot_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(f"total_{c}") for c in MEANS if c in indices.columns],
        F.max_by("cumulative_ndvi", F.when(F.col("cumulative_ndvi").isNotNull(), F.col("date")))
        .alias("cumulative_ndvi"),
    )


def yield_table(summary: DataFrame, harvest: DataFrame, totals: DataFrame) -> DataFrame:
    """Season summary, harvest and index totals side by side, without the columns training drops."""
    yields = harvest.select("plot_id", "crop_type", "wet_harvest_kg/ha", "dry_harvest_kg/ha")
    return (
        summary.join(yields, "plot_id", "left")
        .drop("data_planting_date", "latest_stage", "latest_stage_date", "evapotranspiration_mm")
        .join(totals, "plot_id", "left")
    )


def with_planting_calendar(df: DataFrame, planting: str = "planting_date") -> DataFrame:
    return df.withColumns({"plant_month": F.month(planting), "plant_doy": F.dayofyear(planting)})


def with_category_code(df: DataFrame, column: str = "crop_type", name: str | None = None) -> DataFrame:
    """Codes 0..k-1 by sorted text; a missing value is the category 'nan'.

    Only distinct values are numbered, by ranges of the text.
    """
    text = F.coalesce(F.col(column).cast("string"), F.lit("nan"))
    values = df.select(text.alias("_category")).distinct()
    codes = number_rows(values, F.col("_category"), name="_code", start=0)
    return (
        df.withColumn("_category", text).join(codes, "_category", "left")
        .withColumn(name or f"{column}_enc", F.col("_code").cast("int")).drop("_category", "_code")
    )


def feature_view(table: DataFrame, columns: Sequence[str], key: str = "plot_id", ts: str = "date") -> DataFrame:
    """Key, time and the declared feature columns that the table has."""
    return table.select(key, ts, *[c for c in columns if c in table.columns and c not in (key, ts)])


def lookup_asof(
    entities: DataFrame, view: DataFrame, key: str = "plot_id", ts: str = "ts", view_ts: str = "date",
    block: str = "day",
) -> DataFrame:
    """For each entity row the newest features of its key at or before its time.

    No entity-feature pairs are formed. Features are first reduced to one row per key and time, a complete one
    before one with missing values.

    A view by day needs no ordering of entities at all: a timeline of the days that are offered or
    asked for is read with a running `last` (a key has no more of them than the calendar), and
    entities take their day's answer by an equi-join. A view by time merges both sides into one
    timeline per (key, calendar `block`); what earlier blocks end with is carried in from one row per
    block, so a busy key is spread over its blocks.
    """
    features = [c for c in view.columns if c not in (key, view_ts)]
    offers = (
        view.where(F.col(view_ts).isNotNull())
        .groupBy(F.col(key).alias("_key"), F.col(view_ts).alias("_at")).agg(F.min(C.complete_row(features)).alias("_row"))
        .select("_key", "_at", F.struct(*[F.col(f"_row.`{c}`").alias(c) for c in features]).alias("_features"))
    )
    by_day = isinstance(view.schema[view_ts].dataType, T.DateType)
    found = _asof_by_day(entities, offers, key, ts) if by_day else _asof_by_time(entities, offers, key, ts, block)
    return found.select(
        *[F.col(f"`{c}`") for c in entities.columns], *[F.col(f"_found.{c}").alias(c) for c in features])


def _asof_by_day(entities: DataFrame, offers: DataFrame, key: str, ts: str) -> DataFrame:
    asked = entities.select(F.col(key).alias("_key"), F.col(ts).cast("date").alias("_at")).distinct()
    empty = F.lit(None).cast(offers.schema["_features"].dataType)
    line = offers.unionByName(asked.withColumn("_features", empty)).groupBy("_key", "_at").agg(
        F.max("_features").alias("_features"), F.count_if(F.col("_features").isNull()).alias("_asks"))
    so_far = W.partitionBy("_key").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    answers = line.select(
        "_key", "_at", "_asks", F.last("_features", ignorenulls=True).over(so_far).alias("_found")
    ).where((F.col("_asks") > 0) & F.col("_found").isNotNull())
    same = (F.col(key) == F.col("_key")) & (F.col(ts).cast("date") == F.col("_at"))
    # Answers lie by key; placed by key and day, a key with most of the entities is spread over its days.
    return entities.join(answers.drop("_asks").repartition("_key", "_at"), same, "left")


def _asof_by_time(entities: DataFrame, offers: DataFrame, key: str, ts: str, block: str) -> DataFrame:
    offered = offers.withColumn("_at", F.col("_at").cast("timestamp_ntz")).withColumn(
        "_row", F.lit(None).cast(entities.schema))
    asked = entities.select(
        F.col(key).alias("_key"), F.col(ts).cast("timestamp_ntz").alias("_at"),
        F.lit(None).cast(offers.schema["_features"].dataType).alias("_features"),
        F.struct(*[F.col(f"`{c}`") for c in entities.columns]).alias("_row"),
    )
    line = offered.unionByName(asked).withColumn("_block", F.date_trunc(block, "_at"))
    before = W.partitionBy("_key").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carried = line.groupBy("_key", "_block").agg(
        F.max_by("_features", F.when(F.col("_features").isNotNull(), F.col("_at"))).alias("_tail"),
        F.count("_row").alias("_asks"),
    ).withColumn("_carried", F.last("_tail", ignorenulls=True).over(before)).where(
        F.col("_asks") > 0).select(F.col("_key").alias("_k"), F.col("_block").alias("_b"), "_carried")
    # One small row per block goes to the timeline, which must not be placed by key alone.
    carried = carried.repartition("_k", "_b")
    inside = W.partitionBy("_key", "_block").orderBy("_at", F.col("_row").isNotNull()).rowsBetween(
        W.unboundedPreceding, 0)
    seen = line.withColumn("_seen", F.last("_features", ignorenulls=True).over(inside)).where(
        F.col("_row").isNotNull())
    same = (F.col("_key") == F.col("_k")) & (F.col("_block") == F.col("_b"))
    return seen.join(carried, same, "left").select(
        "_row.*", F.coalesce(F.col("_seen"), F.col("_carried")).alias("_found"))


def lookup_features(snapshot: DataFrame, requested: DataFrame) -> DataFrame:
    """Rows of the snapshot whose plot is among the requested ones."""
    return snapshot.join(requested.select("plot_id").distinct(), "plot_id", "left_semi")


def features_for_scoring(requests: DataFrame, features: DataFrame) -> DataFrame:
    """Stored features per request; a plot without any gets the defaults and its own details."""
    stored = [c for c in features.columns if c != "plot_id"]
    known = features.select("plot_id", F.struct(*stored).alias("_stored"))
    joined = requests.join(known, "plot_id", "left")
    absent = F.col("_stored").isNull()
    altitude = F.when(F.coalesce(F.col("altitude"), F.lit(0.0)) != 0, F.col("altitude")).otherwise(S.BASE_ALTITUDE_M)
    own = {
        "latitude": F.col("latitude"),
        "longitude": F.col("longitude"),
        "planting_date": F.col("planting_date"),
        "season": F.coalesce(F.when(F.col("season") != "", F.col("season")), F.lit(S.SHORT_RAINS)),
        "altitude": altitude,
        "plant_month": F.month("planting_date"),
        "plant_doy": F.dayofyear("planting_date"),
        **{c: F.lit(v) for c, v in SCORING_DEFAULTS.items()},
    }
    names = list(dict.fromkeys([*own, *stored]))
    carried = [c for c in requests.columns if c not in (*own, "plot_id")]

    def pick(c: str) -> Column:
        default = own.get(c, F.lit(None))
        return (F.when(absent, default).otherwise(F.col(f"_stored.{c}")) if c in stored
                else F.when(absent, default)).alias(c)

    return joined.select("plot_id", *carried, *[pick(c) for c in names], (~absent).alias("has_features"))
