"""Global order without a global sort in one task: row numbers, neighbours and exact quantiles.

Each helper works in two levels. Rows are placed by ranges of the sort key and stored; a block is what
one partition holds, so there are as many blocks as partitions whatever the keys are. Only one row per
block (a count, a first and a last value) meets in a single window, and the row level work runs inside
blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from agrospark.sources.files import store


def in_ranges(df: DataFrame, key: Column) -> DataFrame:
    """The rows with the number of their key range as `_block`; stored, so that it stays what it is."""
    return store(df.repartitionByRange(key).withColumn("_block", F.spark_partition_id()), "key-ranges")


def number_rows(df: DataFrame, key: Column, name: str = "row_id", start: int = 1) -> DataFrame:
    """Consecutive numbers in the order of `key`, which must identify a row."""
    cut = in_ranges(df, key)
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        cut.groupBy("_block").agg(F.count("*").alias("_rows"))
        .select("_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.row_number().over(W.partitionBy("_block").orderBy(key))
    return (
        cut.withColumn("_position", position)
        .join(offsets, "_block")
        .withColumn(name, F.col("_offset") + F.col("_position") + (start - 1))
        .drop("_block", "_position", "_offset")
    )


def fill_from_neighbours(df: DataFrame, key: str, first_value: str, last_value: str, name: str) -> DataFrame:
    """Backward then forward fill along a unique key.

    `first_value` is what a row offers to rows before it, `last_value` what it offers to itself
    and to rows after it. The result takes the nearest following offer, else the nearest
    preceding one.
    """
    cut = in_ranges(df, F.col(key))
    inside = W.partitionBy("_block").orderBy(key)
    # Read backwards: a frame that ends with the last row would be gone through anew for every row.
    following = W.partitionBy("_block").orderBy(F.desc(key)).rowsBetween(W.unboundedPreceding, -1)
    preceding = inside.rowsBetween(W.unboundedPreceding, 0)
    blocks = cut.groupBy("_block").agg(
        F.min_by(first_value, F.when(F.col(first_value).isNotNull(), F.col(key))).alias("_head"),
        F.max_by(last_value, F.when(F.col(last_value).isNotNull(), F.col(key))).alias("_tail"),
    )
    before = (W.unboundedPreceding, -1)
    blocks = blocks.select(
        "_block",
        F.last("_head", ignorenulls=True).over(W.orderBy(F.desc("_block")).rowsBetween(*before)).alias("_next"),
        F.last("_tail", ignorenulls=True).over(W.orderBy("_block").rowsBetween(*before)).alias("_prev"),
    )
    return (
        cut.withColumn("_ahead", F.last(first_value, ignorenulls=True).over(following))
        .withColumn("_behind", F.last(last_value, ignorenulls=True).over(preceding))
        .join(blocks, "_block")
        .withColumn(name, F.coalesce("_ahead", "_next", "_behind", "_prev"))
        .drop("_block", "_ahead", "_behind", "_next", "_prev")
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    accuracy: int = 10_000,
    few_keys: bool = False,
) -> DataFrame:
    """Linear-interpolated quantiles per key, exact, with no group gathered in one place.

    A mergeable sketch first brackets every wanted rank; a second pass counts what lies outside
    the brackets and keeps the distinct values inside them (about 8 n / accuracy rows per
    bracket), which are then ranked. Groups smaller than 10 * accuracy use one bracket from the
    least to the greatest value. Set `few_keys` when keys are names of columns, so that the
    sketch (one row per key) may be broadcast.

    Returns keys, `n` and the array `quantiles` in the order of `probs`.
    """
    keys, probs = list(keys), sorted(probs)
    slack = 4.0 / accuracy
    points = [max(p - slack, 0.0) for p in probs] + [min(p + slack, 1.0) for p in probs]
    present = df.where(F.col(value).isNotNull())
    m = len(probs)

    sketch = present.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
        F.approx_percentile(value, points, accuracy).alias("_points"),
    )
    small = F.col("n") < 10 * accuracy
    low, high = F.slice("_points", 1, m), F.slice("_points", m + 1, m)
    brackets = sketch.select(
        *keys,
        F.when(small, F.array_repeat("_min", m)).otherwise(low).alias("_lo"),
        F.when(small, F.array_repeat("_max", m)).otherwise(high).alias("_hi"))
    if few_keys:
        brackets = F.broadcast(brackets)

    slot = F.size(F.filter("_hi", lambda h: h < F.col(value)))
    inside = (F.col("_slot") < m) & (F.get(F.col("_lo"), F.col("_slot")) <= F.col(value))
    counted = (
        present.join(brackets, keys)
        .withColumn("_slot", slot)
        .select(*keys, "_slot", F.when(inside, F.col(value)).alias("_value"))
        .groupBy(*keys, "_slot", "_value").agg(F.count("*").alias("_rows"))
    )
    at = F.array(*[F.lit(float(p)) for p in probs])
    # One row per key and slot (at most len(probs) + 1 slots): where a slot begins, the group size
    # and the ranks to look for.
    by_slot = W.partitionBy(*keys).orderBy("_slot")
    starts = (
        counted.groupBy(*keys, "_slot").agg(
            F.sum("_rows").alias("_all"),
            F.sum(F.when(F.col("_value").isNull(), F.col("_rows")).otherwise(0)).alias("_gap"),
        )
        .withColumn("_upto", F.sum("_all").over(by_slot.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("n", F.sum("_all").over(by_slot.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
        .select(
            *keys, "_slot", "n", (F.col("_upto") - F.col("_all") + F.col("_gap")).alias("_start"),
            F.array_distinct(F.flatten(F.transform(at, lambda p: F.array(
                F.floor(p * (F.col("n") - 1)).cast("bigint"), F.ceil(p * (F.col("n") - 1)).cast("bigint"))))
            ).alias("_wanted"),
        )
    )
    smaller = W.partitionBy(*keys, "_slot").orderBy("_value").rowsBetween(W.unboundedPreceding, -1)
    hits = (
        counted.where(F.col("_value").isNotNull())
        .withColumn("_smaller", F.coalesce(F.sum("_rows").over(smaller), F.lit(0)))
        .join(F.broadcast(starts) if few_keys else starts, [*keys, "_slot"])
        .withColumn("_from", F.col("_start") + F.col("_smaller"))
        .withColumn("_rank", F.explode(F.filter(
            "_wanted", lambda r: (r >= F.col("_from")) & (r < F.col("_from") + F.col("_rows")))))
    )
    found = hits.groupBy(*keys).agg(
        F.first("n").alias("n"),
        # At most two ranks per probability.
        F.map_from_entries(F.collect_list(F.struct("_rank", F.col("_value").cast("double")))).alias("_at"),
    )

    def interpolated(p: Column) -> Column:
        position = p * (F.col("n") - 1)
        below = F.element_at("_at", F.floor(position).cast("bigint"))
        above = F.element_at("_at", F.ceil(position).cast("bigint"))
        return below + (above - below) * (position - F.floor(position))

    return found.select(*keys, "n", F.transform(at, interpolated).alias("quantiles"))
