"""Yield labels and the joins that bring features to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from agrospark.functions import columns as C
from agrospark.functions.names import rename_first
from agrospark.operators.normalize import normalize_labels
from agrospark.sources.files import store

# The columns of the label table and the features that say whether a row was matched.
LABEL_COLUMNS = (
    "plot_id", "Planting_Date", "crop_type", "latitude", "longitude", "wet_harvest_kg/ha", "dry_harvest_kg/ha",
)
INDICATORS = (
    "precip_total", "gdd_sum", "gdd_peak", "mean_ndvi", "mean_evi", "mean_ndre", "mean_savi",
    "mean_ndwi", "mean_ndmi", "days_to_vt",
)


def yield_labels(harvest: DataFrame, box_area_m2: float = 40.0, boxes: int = 2) -> DataFrame:
    """Wet and dry kg per hectare from box weights; an absent column weighs 0, a missing value spoils the row."""
    df = normalize_labels(harvest)

    def per_hectare(first: str, second: str) -> Column | None:
        if first not in df.columns and second not in df.columns:
            return None
        weight = [F.col(c) if c in df.columns else F.lit(0.0) for c in (first, second)]
        return F.round((weight[0] + weight[1]) / (box_area_m2 * boxes) * 10_000.0, 2)

    for name, pair in {
        "wet_harvest_kg/ha": ("wet_kgs_crop_box1", "wet_kgs_crop_box2"),
        "dry_harvest_kg/ha": ("dry_box1_dry_weight", "dry_box2_dry_weight"),
    }.items():
        value = per_hectare(*pair)
        if value is not None:
            df = df.withColumn(name, value)
    return df.select(*[f"`{c}`" for c in LABEL_COLUMNS if c in df.columns])


def tidy_keys(df: DataFrame) -> DataFrame:
    """Join keys under one name each; index-like leftovers dropped."""
    df = rename_first(df, "plot_id", ["plot_no"])
    return df.drop("Unnamed: 0")


def assign_nearest_plot(
    labels: DataFrame, features: DataFrame, tolerance_deg: float = 0.01, leaf: int = 32, depth: int = 7,
) -> DataFrame:
    """Labels without plot_id take the nearest plot, if within the tolerance; ties take the least id.

    Nearest is Euclidean in degrees. Equal coordinates are searched once.
    """
    plots = (
        features.select("plot_id", "latitude", "longitude").dropna()
        .groupBy("plot_id").agg(F.min(F.struct("latitude", "longitude")).alias("at"))
        .groupBy(F.col("at.latitude").alias("_plat"), F.col("at.longitude").alias("_plon"))
        .agg(F.min("plot_id").alias("_pid"))
    )
    seeking = labels["plot_id"].isNull() & labels["latitude"].isNotNull() & labels["longitude"].isNotNull()
    points = labels.where(seeking).select("latitude", "longitude").distinct()
    found = nearest(points, plots, tolerance_deg, leaf, depth)
    return (
        labels.join(found, ["latitude", "longitude"], "left")
        .withColumn("plot_id", F.coalesce("plot_id", "_found"))
        .select(*[f"`{c}`" for c in labels.columns])
    )


def nearest(
    points: DataFrame, plots: DataFrame, tolerance: float, leaf: int = 32, depth: int = 7, trace: list | None = None
) -> DataFrame:
    """(latitude, longitude, _found): the nearest of (_plat, _plon, _pid) to each point that has one within the tolerance.

    A best-first search, all points in step. Cells of a quadtree with sixteen parts per cell are as large as the
    tolerance first; a cell that holds any plot promises one no farther than its far corner, and cells whose near corner
    lies beyond the best promise, or the best plot found, are out. Of the others, those with up to `leaf` plots are
    looked into, and fuller ones go on as their occupied parts. So a crowd is never paired with the points that see it,
    from whatever distance: only its parts along the nearest edge are opened. `depth` times a cell is parted, which
    ends at some centimetres. `trace` takes the pairs of each step, for tests.
    """
    side = tolerance * (1 + 1e-9)
    finest = side / 4 ** depth
    at = lambda c: F.floor(F.col(c) / finest).cast("bigint")
    part = lambda c, level: F.shiftright(F.col(c), 2 * (depth - level))
    plots = store(plots.select("*", at("_plat").alias("_r"), at("_plon").alias("_c")), "nearest-plots")
    points = store(points.select("*", at("latitude").alias("_pr"), at("longitude").alias("_pc"),
                                 F.monotonically_increasing_id().alias("_p")), "nearest-points")

    def cells(level: int) -> DataFrame:
        above = [] if level == 0 else [part("_r", level - 1).alias("_row_above"), part("_c", level - 1).alias("_col_above")]
        return plots.groupBy(part("_r", level).alias("_row"), part("_c", level).alias("_col"), *above).agg(F.count("*").alias("_n"))

    def with_bounds(rows: DataFrame, level: int) -> DataFrame:
        size, slack = finest * 4 ** (depth - level), 1e-11
        near, far = [], []
        for place, cell in (("latitude", "_row"), ("longitude", "_col")):
            low = F.col(cell) * size
            near.append(F.greatest(low - F.col(place), F.col(place) - low - size, F.lit(0.0)))
            far.append(F.greatest(F.col(place) - low, low + size - F.col(place)))
        distance = lambda d: F.sqrt(d[0] * d[0] + d[1] * d[1])
        return rows.withColumn("_least", distance(near) - slack).withColumn("_most", distance(far) + slack)

    neighbour = F.array(F.lit(-1), F.lit(0), F.lit(1))
    around = points.select("*", F.explode(neighbour).alias("_i")).select("*", F.explode(neighbour).alias("_j"))
    around = around.withColumn("_row", part("_pr", 0) + F.col("_i")).withColumn("_col", part("_pc", 0) + F.col("_j"))
    opened = around.join(cells(0), ["_row", "_col"]).select("_p", "latitude", "longitude", "_row", "_col", "_n", F.lit(None).cast("double").alias("_best"))
    best = None
    for level in range(depth + 1):
        # A point has a bounded number of open cells.
        promise = F.min(F.least("_most", F.coalesce("_best", F.lit(tolerance)), F.lit(tolerance))).over(W.partitionBy("_p"))
        kept = store(with_bounds(opened, level).withColumn("_limit", promise).where(F.col("_least") <= F.col("_limit")), "nearest-cells")
        full = (F.col("_n") > leaf) & F.lit(level < depth)
        inside = plots.select("_plat", "_plon", "_pid", part("_r", level).alias("_row"), part("_c", level).alias("_col"))
        pairs = kept.where(~full).select("_p", "latitude", "longitude", "_row", "_col").join(inside, ["_row", "_col"])
        if trace is not None:
            trace.append(pairs)
        distance = F.sqrt(F.pow(F.col("latitude") - F.col("_plat"), 2) + F.pow(F.col("longitude") - F.col("_plon"), 2))
        hits = pairs.withColumn("_d", distance).where(F.col("_d") <= tolerance).select("_p", F.struct(F.col("_d").alias("d"), F.col("_pid").alias("id")).alias("_hit"))
        hits = hits if best is None else hits.unionByName(best)
        best = hits.groupBy("_p").agg(F.min("_hit").alias("_hit"))
        further = kept.where(full)
        if level == depth or further.isEmpty():
            break
        best = store(best, "nearest-best")
        parents = further.select("_p", "latitude", "longitude", F.col("_row").alias("_row_above"), F.col("_col").alias("_col_above"))
        opened = parents.join(cells(level + 1), ["_row_above", "_col_above"]).join(
            best.select("_p", F.col("_hit.d").alias("_best")), "_p", "left").select(
            "_p", "latitude", "longitude", "_row", "_col", "_n", "_best")
    return points.join(best, "_p").select("latitude", "longitude", F.col("_hit.id").alias("_found"))


def _feature_columns(labels: DataFrame, features: DataFrame) -> list[str]:
    taken = {c.lower() for c in labels.columns}
    return [c for c in features.columns if c.lower() not in taken]


def _tier(
    labels: DataFrame, features: DataFrame, pairs: dict[str, Column], name: str, carried: Sequence[str],
    null_safe: bool, dedupe: bool,
) -> DataFrame:
    """Left join of a struct `name` of the carried columns, keyed by label column -> feature expression."""
    right = features.select(
        *[expr.alias(f"_{name}_{i}") for i, expr in enumerate(pairs.values())],
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias(name))
    keys = [f"_{name}_{i}" for i in range(len(pairs))]
    if dedupe:  # the least row with missing values last, so that an empty one never hides a full one
        least = right.select(*keys, f"{name}.*").groupBy(*keys).agg(F.min(C.complete_row(carried)).alias("_row"))
        right = least.select(*keys, F.struct(*[F.col(f"_row.`{c}`").alias(c) for c in carried]).alias(name))
    condition = None
    for key, left in zip(keys, pairs):
        same = F.col(left).eqNullSafe(F.col(key)) if null_safe else F.col(left) == F.col(key)
        condition = same if condition is None else condition & same
    return labels.join(right, condition, "left").drop(*keys)


def _expand(joined: DataFrame, name: str, carried: Sequence[str]) -> DataFrame:
    return joined.select(
        *[F.col(f"`{c}`") for c in joined.columns if c != name],
        *[F.col(name)[c].alias(c) for c in carried])


def join_on_plot_and_date(
    labels: DataFrame, features: DataFrame, null_safe: bool = False, dedupe: bool = True
) -> DataFrame:
    """Primary merge. `null_safe` lets missing keys meet; without `dedupe` repeated plots fan out."""
    carried = _feature_columns(labels, features)
    pairs = {"plot_id": F.col("plot_id"), "Planting_Date": F.col("planting_date")}
    return _expand(_tier(labels, features, pairs, "_f", carried, null_safe, dedupe), "_f", carried)


def join_on_plot(labels: DataFrame, features: DataFrame, null_safe: bool = False, dedupe: bool = True) -> DataFrame:
    carried = _feature_columns(labels, features)
    return _expand(_tier(labels, features, {"plot_id": F.col("plot_id")}, "_f", carried, null_safe, dedupe), "_f", carried)


def join_on_coordinates(
    labels: DataFrame, features: DataFrame, digits: int = 4, null_safe: bool = False, dedupe: bool = True
) -> DataFrame:
    carried = _feature_columns(labels, features)
    rounded = _with_rounded(labels, digits)
    joined = _tier(rounded, features, _coordinate_pairs(digits), "_f", carried, null_safe, dedupe)
    return _expand(joined.drop("_lat", "_lon"), "_f", carried)


def _with_rounded(labels: DataFrame, digits: int) -> DataFrame:
    return labels.withColumns({
        "_lat": F.round("latitude", digits), "_lon": F.round("longitude", digits)})


def _coordinate_pairs(digits: int) -> dict[str, Column]:
    return {
        "_lat": F.round("latitude", digits), "_lon": F.round("longitude", digits),
        "Planting_Date": F.col("planting_date"),
    }


def merge_features(
    labels: DataFrame, features: DataFrame, mode: str = "row", digits: int = 4, null_safe: bool = False
) -> DataFrame:
    """Features by plot and date, else by plot, else by rounded coordinates and date.

    `row`: every label takes the first tier that gives it a feature, so no match is ever lost.
    `table`: the whole table moves on to the next tier as soon as one label has no feature.
    Three left joins on right sides of one row per key; `match_tier` is 0 for no match.
    """
    if mode not in ("row", "table"):
        raise ValueError(f"mode must be 'row' or 'table', not {mode!r}")
    carried = _feature_columns(labels, features)
    shown = [c for c in INDICATORS if c in features.columns]
    useful = features.where(F.coalesce(*[F.col(c).cast("string") for c in shown]).isNotNull()) \
        if mode == "row" else features
    tiers = [
        ("_t1", {"plot_id": F.col("plot_id"), "Planting_Date": F.col("planting_date")}),
        ("_t2", {"plot_id": F.col("plot_id")}),
        ("_t3", _coordinate_pairs(digits)),
    ]
    joined = _with_rounded(labels, digits)
    for name, pairs in tiers:
        joined = _tier(joined, useful, pairs, name, carried, null_safe, dedupe=True)
    joined = joined.drop("_lat", "_lon")

    def present(name: str) -> Column:
        return F.coalesce(*[F.col(name)[c].cast("string") for c in shown]).isNotNull()

    if mode == "row":
        chosen = F.coalesce("_t1", "_t2", "_t3")
        tier = F.when(present("_t1"), 1).when(present("_t2"), 2).when(present("_t3"), 3).otherwise(0)
    else:
        joined = store(joined, "merged")  # the three joins are done once, to choose and to answer
        step = joined.agg(
            F.when(F.count_if(~present("_t1")) == 0, 1).when(F.count_if(~present("_t2")) == 0, 2).otherwise(3)
        ).scalar()
        chosen = F.when(step == 1, F.col("_t1")).when(step == 2, F.col("_t2")).otherwise(F.col("_t3"))
        tier = F.when(F.coalesce(*[chosen[c].cast("string") for c in shown]).isNotNull(), step).otherwise(0)
    out = joined.withColumn("_f", chosen).withColumn("match_tier", tier.cast("int")).drop("_t1", "_t2", "_t3")
    return _expand(out, "_f", carried)
