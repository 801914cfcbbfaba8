"""Feature drift: population stability of a day against the days before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from agrospark import schemas as S
from agrospark.functions import columns as C
from agrospark.functions.ordering import in_ranges
from agrospark.sources.files import store

SKETCH_SIZE = 8192
SLACK = 0.001  # in ranks, beyond the sketch's usual error at this size
WHOLE = 100_000  # values of a feature that are all counted


def choose_features(
    df: DataFrame, ignore: Sequence[str] = S.DRIFT_IGNORED
) -> tuple[list[str], list[str]]:
    """Numeric (booleans included) and other feature columns, from the schema alone."""
    fields = [f for f in df.schema.fields if f.name not in ignore]
    numeric = [f.name for f in fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    return numeric, [f.name for f in fields if f.name not in numeric]


def feature_types(df: DataFrame, ignore: Sequence[str] = S.DRIFT_IGNORED) -> dict[str, str]:
    numeric, other = choose_features(df, ignore)
    return {**dict.fromkeys(numeric, "numeric"), **dict.fromkeys(other, "categorical")}


def _number(df: DataFrame, name: str) -> Column:
    col = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.BooleanType):
        col = col.cast("int")
    return C.clean_nan(col.cast("double"))


def sketches(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per numeric feature: rows, present, least, greatest and a mergeable quantile sketch of its values.

    Rows of several days, or tables, add up with `merged`. A sketch of up to `SKETCH_SIZE` values is exact; beyond,
    its ranks are off by less than `SLACK`, nearly always.
    """
    return _long(df, features).groupBy("feature").agg(
        F.count("*").alias("rows"), F.count("number").alias("present"), F.min("number").alias("least"),
        F.max("number").alias("greatest"), F.kll_sketch_agg_double("number", SKETCH_SIZE).alias("sketch"))


def merged(stored: DataFrame) -> DataFrame:
    return stored.groupBy("feature").agg(
        F.sum("rows").alias("rows"), F.sum("present").alias("present"), F.min("least").alias("least"),
        F.max("greatest").alias("greatest"), F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch"))


def category_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows per feature and category; a missing value has none."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in features])
    return text.unpivot([], [f"`{c}`" for c in features], "feature", "category").groupBy("feature", "category").agg(
        F.count("*").alias("rows"))


def _long(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.select(*[_number(df, c).alias(c) for c in features]).unpivot([], [f"`{c}`" for c in features], "feature", "number")


def brackets(sketch: DataFrame, bins: int = 10, whole: int = WHOLE) -> DataFrame:
    """Between which values each inner edge lies, from one sketch per feature; up to `whole` values, between the least
    and the greatest."""
    probs = [i / bins for i in range(1, bins)]

    def at(move: float) -> Column:
        ranks = [min(1.0, max(0.0, p + move)) for p in probs]
        return F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(r)) for r in ranks])

    small = F.col("present") <= whole
    some = F.col("present") > 0
    return sketch.where(some).select(
        "feature", F.when(small, F.array_repeat("least", bins - 1)).otherwise(at(-SLACK)).alias("lo"),
        F.when(small, F.array_repeat("greatest", bins - 1)).otherwise(at(SLACK)).alias("hi"))


def _sure_brackets(reference: DataFrame, features: Sequence[str], bins: int, accuracy: int = 10_000) -> DataFrame:
    """The same from a pass over the values by a sketch whose error is bounded for certain."""
    slack = 4.0 / accuracy
    at = lambda move: F.approx_percentile(
        "number", [min(1.0, max(0.0, i / bins + move)) for i in range(1, bins)], accuracy)
    return _long(reference, features).where(F.col("number").isNotNull()).groupBy("feature").agg(at(-slack).alias("lo"), at(slack).alias("hi"))


def counted_cells(sides: dict[str, DataFrame], features: Sequence[str], between: DataFrame) -> DataFrame:
    """Rows per (feature, slot, value) on each side, in one pass over each.

    A value inside a bracket is a cell of its own. Of others, only the slot is kept, the number of brackets below
    them; a missing value has no slot. Without a bracket (no reference values), all present ones share slot 0.
    """
    both = None
    for name, df in sides.items():
        rows = _long(df, features).withColumn("side", F.lit(name))
        both = rows if both is None else both.unionByName(rows)
    # One row per feature: bounded by the number of columns.
    placed = both.join(F.broadcast(between), "feature", "left")
    slot = F.when(F.col("number").isNotNull(), F.coalesce(F.size(F.filter("hi", lambda h: h < F.col("number"))), F.lit(0)))
    placed = placed.withColumn("slot", slot)
    inside = F.get("lo", F.col("slot")) <= F.col("number")
    return placed.groupBy("feature", "slot", F.when(inside, F.col("number")).alias("value")).agg(
        *[F.count_if(F.col("side") == name).alias(name) for name in sides])


def cell_edges(cells: DataFrame, between: DataFrame, bins: int = 10) -> DataFrame:
    """Inner edges (feature, edges) by the exact ranks of the cells' `ref` rows; `edges` is null where a wanted rank does
    not lie in its bracket.

    Cells are ranked in ranges of (feature, slot, value), so that no task orders a feature, or a bracket, on its own.
    """
    known = cells.where(F.col("slot").isNotNull() & (F.col("ref") > 0)).select("feature", "slot", "value", "ref")
    cut = in_ranges(known, F.struct("feature", "slot", "value"))
    blocks = cut.groupBy("feature", "_block").agg(F.sum("ref").alias("_rows"))
    so_far = W.partitionBy("feature").orderBy("_block")
    # One row per feature and range.
    blocks = blocks.select(
        "feature", "_block", (F.sum("_rows").over(so_far) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(W.partitionBy("feature")).alias("_n"))
    inside = W.partitionBy("_block", "feature").orderBy("slot", "value").rowsBetween(W.unboundedPreceding, W.currentRow)
    ends = cut.withColumn("_upto", F.sum("ref").over(inside)).join(F.broadcast(blocks), ["feature", "_block"])
    ends = ends.withColumn("_upto", F.col("_upto") + F.col("_before"))
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    places = F.transform(probs, lambda p, i: F.struct(i.alias("edge"), (p * (F.col("_n") - 1)).alias("at")))
    hit = lambda rank: (rank < F.col("_upto")) & (rank >= F.col("_upto") - F.col("ref"))
    wanted = F.filter(places, lambda e: hit(F.floor(e["at"])) | hit(F.ceil(e["at"])))
    hits = ends.select("feature", "value", "_upto", "ref", F.explode(wanted).alias("e"))
    found = hits.groupBy("feature", "e.edge").agg(
        F.first("e.at").alias("at"), F.min_by("value", "_upto").alias("below"), F.max_by("value", "_upto").alias("above"),
        F.count_if(F.col("value").isNull()).alias("lost"))
    found = found.join(F.broadcast(between), "feature")
    kept = (F.col("lost") == 0) & (F.get("lo", "edge") <= F.col("below")) & (F.col("above") <= F.get("hi", "edge"))
    value = F.col("below") + (F.col("above") - F.col("below")) * (F.col("at") - F.floor("at"))
    listed = found.groupBy("feature").agg(
        F.sort_array(F.collect_list(F.struct("edge", F.when(kept, value).alias("value")))).alias("all"))  # bins - 1 of them
    edges = F.transform("all", lambda x: x["value"])
    return listed.select("feature", F.when(F.forall("all", lambda x: x["value"].isNotNull()), edges).alias("edges"))


def exact_edges(
    reference: DataFrame, sides: dict[str, DataFrame], features: Sequence[str], bins: int, sketch: DataFrame | None = None,
    between: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(cells, edges), both stored. Where a sketch has put an edge beside its bracket, which its error allows but hardly
    ever does, brackets that are sure are taken and the cells are counted again."""
    if between is None:
        between = brackets(sketches(reference, features) if sketch is None else sketch, bins)
    between = store(between.coalesce(1), "brackets")
    cells = store(counted_cells(sides, features, between), "cells")
    edges = store(cell_edges(cells, between, bins).coalesce(1), "edges")
    if not edges.where("edges is null").isEmpty():
        between = store(_sure_brackets(reference, features, bins).coalesce(1), "brackets")
        cells = store(counted_cells(sides, features, between), "cells")
        edges = store(cell_edges(cells, between, bins).coalesce(1), "edges")
    return cells, edges


def bin_edges(reference: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """Inner quantile edges of every feature, as they are: features may be of any size."""
    return exact_edges(reference, {"ref": reference}, features, bins)[1]


def tally(
    reference: DataFrame, current: DataFrame, numeric: Sequence[str], other: Sequence[str], bins: int = 10,
    sketch: DataFrame | None = None, categories: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Rows per (feature, bin) on both sides; a category is its own bin, a missing value has none.

    Numeric bins are [a, b), so repeated edges leave empty bins. The reference is read for its sketch, unless `sketch`
    has one row per feature, and each side once to count cells, which have all that bins need: an edge lies in its
    bracket, so a slot between brackets is a bin. `categories` are stored `category_counts` of both sides.
    """
    parts = []
    if numeric:
        cells, edges = exact_edges(reference, {"ref": reference, "cur": current}, numeric, bins, sketch)
        inside = F.size(F.filter(F.coalesce("edges", F.array().cast("array<double>")), lambda e: e <= F.col("value")))
        place = F.when(F.col("value").isNotNull(), inside).otherwise(F.col("slot")).cast("string")
        parts.append(cells.join(F.broadcast(edges), "feature", "left").groupBy("feature", place.alias("bin")).agg(
            F.sum("ref").alias("ref"), F.sum("cur").alias("cur")))
    if other:
        ref, cur = categories or (category_counts(reference, other), category_counts(current, other))
        both = ref.where(F.col("feature").isin(*other)).select("feature", F.col("category").alias("bin"), F.col("rows").alias("ref"), F.lit(0).alias("cur")) \
            .unionByName(cur.where(F.col("feature").isin(*other)).select("feature", F.col("category").alias("bin"), F.lit(0).alias("ref"), F.col("rows").alias("cur")))
        parts.append(both.groupBy("feature", "bin").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def stability(counts: DataFrame) -> DataFrame:
    """PSI and missing rates per feature from a tally; a side without values gives PSI 0."""
    known = F.col("bin").isNotNull()
    totals = counts.groupBy("feature").agg(
        *[F.sum(F.when(known, F.col(s)).otherwise(0)).alias(f"_{s}") for s in ("ref", "cur")],
        *[F.try_divide(F.sum(F.when(~known, F.col(s)).otherwise(0)), F.sum(s)).alias(f"missing_{s}")
          for s in ("ref", "cur")],
    )
    term = C.psi_term(
        C.share_or_floor(F.col("ref"), F.col("_ref")), C.share_or_floor(F.col("cur"), F.col("_cur")))
    counted = known & (F.col("_ref") > 0) & (F.col("_cur") > 0)
    # One row per feature again.
    return counts.join(F.broadcast(totals), "feature").groupBy("feature").agg(
        F.sum(F.when(counted, term).otherwise(0.0)).alias("psi"),
        F.first("missing_ref").alias("missing_ref"), F.first("missing_cur").alias("missing_cur"))


def numeric_psi(reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    return stability(tally(reference, current, features, [], bins)).select("feature", "psi")


def categorical_psi(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    return stability(tally(reference, current, [], features)).select("feature", "psi")


def drift_report(
    reference: DataFrame, current: DataFrame, ignore: Sequence[str] = S.DRIFT_IGNORED, bins: int = 10,
    sketch: DataFrame | None = None, categories: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Feature, type, PSI, missing rates and level, one row per feature of the current table; see `tally`."""
    numeric, other = choose_features(current, ignore)
    if not numeric and not other:
        raise ValueError("no feature columns to compare")
    kind = F.when(F.col("feature").isin(*numeric), "numeric").otherwise("categorical")
    return stability(tally(reference, current, numeric, other, bins, sketch, categories)).select(
        "feature", kind.alias("type"), "psi", "missing_ref", "missing_cur", C.drift_level(F.col("psi")).alias("level"))


def drift_summary(report: DataFrame, ds: str | None = None, status: str = "ok") -> DataFrame:
    return report.agg(
        F.lit(ds).alias("ds"),
        F.lit(status).alias("status"),
        F.count("*").alias("n_features"),
        F.count_if(F.col("level") == "high").alias("n_high"),
        F.count_if(F.col("level") == "medium").alias("n_medium"),
    ).withColumn("alert", F.when(F.col("n_high") > 0, "high_drift").otherwise("none"))


def empty_summary(spark, ds: str | None, status: str) -> DataFrame:
    """Summary of a run that had nothing to compare: `no_data` or `no_reference`."""
    return spark.createDataFrame(
        [(ds, status, 0, 0, 0, "none")],
        "ds string, status string, n_features long, n_high long, n_medium long, alert string")


def top_drift(report: DataFrame, n: int = 20) -> DataFrame:
    return report.orderBy(F.desc("psi"), "feature").limit(n)
