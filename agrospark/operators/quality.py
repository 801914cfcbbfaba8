"""Quality gates and table profiles, one aggregate pass each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from agrospark import schemas as S
from agrospark.functions import columns as C

GATE_COLUMNS = ("max_temp_c", "min_temp_c", "precip_mm")


class QualityError(ValueError):
    """The weather of a run broke a gate."""


def missing(name: str) -> Column:
    return F.count_if(F.col(f"`{name}`").isNull())


def extra_copies(columns: Sequence[str]) -> Column:
    """Rows beyond the first of each combination; a struct makes NULLs count as values."""
    return F.count("*") - F.count_distinct(F.struct(*[F.col(f"`{c}`") for c in columns]))


def out_of_range(name: str = "max_temp_c") -> Column:
    col = F.col(name)
    return F.count_if((col > S.TEMP_MAX_C) | (col < S.TEMP_MIN_C))


def null_gate(df: DataFrame, columns: Sequence[str] = GATE_COLUMNS) -> DataFrame:
    return df.agg(*[missing(c).alias(f"null_{c}") for c in columns])


def range_gate(df: DataFrame, column: str = "max_temp_c") -> DataFrame:
    return df.agg(out_of_range(column).alias("out_of_range"))


def duplicate_gate(df: DataFrame, keys: Sequence[str] = ("plot_id", "date")) -> DataFrame:
    return df.agg(extra_copies(keys).alias("duplicates"))


def weather_verdict(df: DataFrame) -> DataFrame:
    """All gates in one pass, with `passed`."""
    counts = df.agg(
        *[missing(c).alias(f"null_{c}") for c in GATE_COLUMNS],
        out_of_range().alias("out_of_range"),
        extra_copies(["plot_id", "date"]).alias("duplicates"),
    )
    total = sum((F.col(c) for c in counts.columns[1:]), F.col(counts.columns[0]))
    return counts.withColumn("passed", total == 0)


def weather_gate(df: DataFrame) -> DataFrame:
    """Hand the weather on, or raise with the counts; the one action is a single aggregate row."""
    verdict = weather_verdict(df).first().asDict()
    if not verdict.pop("passed"):
        raise QualityError(f"weather validation failed: { {k: v for k, v in verdict.items() if v} }")
    return df


COPIES, NEW_DAY, NEW_PLOT = "_count_copies", "_count_new_day", "_count_new_plot"


def counted_days(weather: DataFrame) -> DataFrame:
    """The distinct rows of the weather with what `gate_metrics` counts: how often a row came, and whether it is the
    first of its day and of its plot.

    Equal rows are counted before they are shuffled. Then a plot's rows, which the calendar bounds unless days were
    delivered with different values, lie in order in one partition, as they are stored.
    """
    rows = weather.groupBy(*[F.col(f"`{c}`") for c in weather.columns]).agg(F.count("*").alias(COPIES))
    place = Window.partitionBy("plot_id").orderBy("date")
    return rows.withColumn(NEW_DAY, ~F.lag(F.struct("date")).over(place).eqNullSafe(F.struct("date"))) \
        .withColumn(NEW_PLOT, F.row_number().over(place) == 1)


def gate_metrics(columns: Sequence[str], date: str = "date") -> dict[str, Column]:
    """Profile and gates of `counted_days`, as aggregates that a write can collect: nothing is distinct in them."""
    copies = F.col(COPIES)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    beyond = (F.col("max_temp_c") > S.TEMP_MAX_C) | (F.col("max_temp_c") < S.TEMP_MIN_C)
    return {
        "row_count": total(copies), "plot_count": F.count_if(F.col(NEW_PLOT) & F.col("plot_id").isNotNull()),
        "date_start": F.min(date), "date_end": F.max(date),
        **{f"null_{c}": total(F.when(F.col(f"`{c}`").isNull(), copies)) for c in columns},
        "duplicate_count": total(copies - 1), "duplicates": total(copies) - F.count_if(NEW_DAY),
        "out_of_range": total(F.when(beyond, copies)),
    }


def check_gate(seen: dict) -> None:
    """Raise with the counts if a gate is broken."""
    counts = {k: seen[k] for k in (*[f"null_{c}" for c in GATE_COLUMNS], "out_of_range", "duplicates") if seen[k]}
    if counts:
        raise QualityError(f"weather validation failed: {counts}")


def table_metrics(df: DataFrame, date: str | None = None) -> dict[str, Column]:
    """Profile of a table with at most one row per plot and day, as aggregates that a write can collect."""
    when = {"date_start": F.min(date), "date_end": F.max(date)} if date else {}
    return {"row_count": F.count(F.lit(1)), **when, **{f"null_{c}": missing(c) for c in df.columns}}


PROFILE = ("table string, row_count bigint, plot_count bigint, date_start date, date_end date, columns array<string>, "
           "null_counts map<string, bigint>, duplicate_count bigint")


def profile_row(table: str, columns: Sequence[str], seen: dict) -> tuple:
    """A row of `PROFILE`; what a write has not counted is missing."""
    return (table, seen.get("row_count"), seen.get("plot_count"), seen.get("date_start"), seen.get("date_end"), list(columns),
            {c: seen[f"null_{c}"] for c in columns if f"null_{c}" in seen}, seen.get("duplicate_count"))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Hand a stored result on, or raise when a run produced nothing."""
    if df.isEmpty():
        raise ValueError(f"no {what}")
    return df


def unique_days(weather: DataFrame) -> DataFrame:
    """One row per (plot_id, date): the least row, by a total order over all other columns, missing last.

    Bounds a plot's history by the calendar, however often its days were delivered.
    """
    rest = [c for c in weather.columns if c not in ("plot_id", "date")]
    return (
        weather.groupBy("plot_id", "date").agg(F.min(C.complete_row(rest)).alias("row"))
        .select("plot_id", "date", *[F.col(f"row.`{c}`").alias(c) for c in rest])
        .select(*weather.columns)
    )


def missing_summary(df: DataFrame) -> DataFrame:
    """Column, missing count and percent, worst first."""
    counts = df.agg(F.count("*").alias("_rows"), *[missing(c).alias(c) for c in df.columns])
    long = counts.unpivot("_rows", [f"`{c}`" for c in df.columns], "column", "missing_count")
    return long.select(
        "column", "missing_count",
        F.when(F.col("_rows") > 0, F.col("missing_count") * 100.0 / F.col("_rows")).alias("missing_pct"),
    ).orderBy(F.desc("missing_pct"), "column")


def missing_rates(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Share of missing values per feature in both tables."""
    def side(df: DataFrame, name: str) -> DataFrame:
        shares = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(c) for c in features])
        return shares.unpivot([], [f"`{c}`" for c in features], "feature", name)
    # One row per column on either side.
    return side(reference, "missing_ref").join(F.broadcast(side(current, "missing_cur")), "feature")


def unmatched_features(merged: DataFrame, features: Sequence[str]) -> DataFrame:
    """How many merged rows carry no feature at all."""
    empty = F.coalesce(*[F.col(c).cast("string") for c in features]).isNull()
    return merged.agg(F.count("*").alias("total"), F.count_if(empty).alias("missing"))


def profile(df: DataFrame, date: str = "date") -> DataFrame:
    """Run metadata in one row: rows, plots, date range, columns, null counts, full-row duplicates."""
    nulls = [x for c in df.columns for x in (F.lit(c), missing(c))]
    counted = df.agg(
        F.count("*").alias("row_count"),
        F.count_distinct("plot_id").alias("plot_count"),
        F.min(date).alias("date_start"),
        F.max(date).alias("date_end"),
        F.create_map(*nulls).alias("null_counts"),
    )
    # A separate aggregate: the wide distinct must not drag the counts through its shuffle.
    copies = df.agg(extra_copies(df.columns).alias("duplicate_count"))
    return counted.select(
        "*",
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
        copies.scalar().alias("duplicate_count"),
    )


def planting_profile(planting: DataFrame) -> DataFrame:
    return planting.agg(
        F.count("*").alias("plot_count"),
        F.avg("confidence_score").alias("average_confidence"),
        F.min("confidence_score").alias("min_confidence"),
        F.max("confidence_score").alias("max_confidence"),
        F.min("inferred_planting_date").alias("earliest_planting"),
        F.max("inferred_planting_date").alias("latest_planting"),
    )
