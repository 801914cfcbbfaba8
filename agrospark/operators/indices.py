"""Vegetation indices: pixels of satellite scenes into per-plot sample statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from agrospark import schemas as S
from agrospark.functions import columns as C
from agrospark.functions.names import find_column, require
from agrospark.functions.ordering import exact_quantiles


def with_bands(pixels: DataFrame) -> DataFrame:
    """Band columns under their colour names; an absent band is the constant 0."""
    named = {}
    for colour, code in S.BANDS.items():
        found = find_column(pixels.columns, [colour, code])
        named[colour] = F.lit(0.0) if found is None else C.clean_nan(F.col(found).cast("double"))
    codes = [c for c in pixels.columns if c.upper() in S.BANDS.values()]
    return pixels.withColumns(named).drop(*codes)


def with_indices(pixels: DataFrame, scale: float = 1.0) -> DataFrame:
    bands = {colour: F.col(colour) * scale if scale != 1.0 else F.col(colour) for colour in S.BANDS}
    return pixels.withColumns(C.vegetation_indices(bands))


def usable_scenes(
    pixels: DataFrame, start: Column | None = None, end: Column | None = None, max_cloud_pct: float = 60.0
) -> DataFrame:
    """Scenes below the cloud limit with a date in [start, end); plain predicates reach the scan."""
    kept = pixels.where(F.col("cloud_pct") < max_cloud_pct)
    if start is not None:
        kept = kept.where(F.col("date") >= start)
    return kept if end is None else kept.where(F.col("date") < end)


def pixels_near_plots(pixels: DataFrame, plots: DataFrame, radius_m: float = 40.0) -> DataFrame:
    """Pixels within `radius_m` of a plot point, by an equi-join on grid cells.

    Cells are at least a radius high and, per latitude band, at least a radius wide, so the 3 x 3
    neighbourhood of a plot's cell holds every pixel in reach. Only plots are replicated. What a
    cell joins is a few cells' area per plot, the size of the answer.
    """
    step = radius_m / 111_000.0

    def lon_step(band: Column) -> Column:
        widest = F.least(F.greatest(F.abs(band), F.abs(band + 1)) * step, F.lit(89.9))
        return step / F.cos(F.radians(widest))

    band = F.floor(F.col("latitude") / step)
    located = pixels.withColumn("_band", band).withColumn(
        "_cell", F.floor(F.col("longitude") / lon_step(F.col("_band"))))
    # The date line: a plot close to it also looks from the other side.
    sides = (
        F.when(F.col("longitude") > 179.9, F.array(F.col("longitude"), F.col("longitude") - 360))
        .when(F.col("longitude") < -179.9, F.array(F.col("longitude"), F.col("longitude") + 360))
        .otherwise(F.array(F.col("longitude")))
    )
    around = (
        plots.select("plot_id", F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"),
                     sides.alias("_sides"), band.alias("_centre"))
        .withColumn("_band", F.explode(F.sequence(F.col("_centre") - 1, F.col("_centre") + 1)))
        .withColumn("_side", F.explode("_sides"))
        .withColumn("_mid", F.floor(F.col("_side") / lon_step(F.col("_band"))))
        .withColumn("_cell", F.explode(F.sequence(F.col("_mid") - 1, F.col("_mid") + 1)))
        .select("plot_id", "_lat", "_lon", "_band", "_cell").distinct()
    )
    distance = C.haversine_m(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon"))
    return (
        located.drop("plot_id").join(around, ["_band", "_cell"])
        .withColumn("distance_m", distance).where(F.col("distance_m") <= radius_m)
        .drop("_band", "_cell", "_lat", "_lon")
    )


def with_period_end(plots: DataFrame, default_days: int = 60) -> DataFrame:
    """`vt_date`, replaced by planting + default where it is missing or before planting."""
    vt = F.col("vt_date") if "vt_date" in plots.columns else F.lit(None).cast("date")
    return plots.withColumn("vt_date", F.when(vt >= F.col("planting_date"), vt).otherwise(
        F.date_add("planting_date", default_days)))


def sample_dates(plots: DataFrame, step_days: int = 5, default_days: int = 60) -> DataFrame:
    """One row per sample day from planting to VT, both included."""
    period = with_period_end(plots.where(F.col("planting_date").isNotNull()), default_days)
    last = F.floor(F.datediff("vt_date", "planting_date") / step_days).cast("int")
    return (
        period.withColumn("sample_no", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("sample_date", F.date_add("planting_date", F.col("sample_no") * step_days))
    )


def match_samples(
    pixels: DataFrame, plots: DataFrame, window_days: int = 10, step_days: int = 5, default_days: int = 60,
    place: bool = False, by_plot: bool = False,
) -> DataFrame:
    """Pixels with every sample whose window [sample - w, sample + w) holds their scene.

    The sample numbers follow from the day difference, so the interval join is an equi-join on
    the plot plus a sequence of at most 2 w / step numbers. With `place`, rows are placed by
    (plot, pixel) before they are multiplied: the shuffle carries each scene once, and grouping by
    (plot, sample, pixel) afterwards needs no other. With `by_plot`, they are placed by plot before
    the join, and statistics by (plot, sample) and running sums by plot need no other either. Leave
    both off where partial aggregates follow that make far fewer rows.
    """
    period = with_period_end(plots.where(F.col("planting_date").isNotNull()), default_days).select(
        "plot_id", "planting_date", "vt_date")
    offset = F.datediff("date", "planting_date")
    last = F.floor(F.datediff("vt_date", "planting_date") / step_days).cast("int")
    if by_plot:
        pixels = pixels.repartition("plot_id")
    joined = (
        pixels.join(period, "plot_id")
        .withColumn("_from", F.greatest(F.floor((offset - window_days) / step_days).cast("int") + 1, F.lit(0)))
        .withColumn("_to", F.least(F.floor((offset + window_days) / step_days).cast("int"), last))
        .where(F.col("_from") <= F.col("_to"))
    )
    if place:
        joined = joined.repartition("plot_id", "pixel_id")
    return (
        joined.withColumn("sample_no", F.explode(F.sequence("_from", "_to")))
        .withColumn("sample_date", F.date_add("planting_date", F.col("sample_no") * step_days))
        .drop("_from", "_to", "planting_date", "vt_date")
    )


PIXEL_KEY = ["plot_id", "sample_date", "pixel_id"]
SAMPLE_KEY = ["plot_id", "sample_date"]


def busy_pixels(
    scenes: DataFrame, limit: int = 300_000, window_days: int = 10, broadcast_rows: int = 100_000
) -> DataFrame | None:
    """(plot_id, pixel_id) of pixels that may have more than `limit` scenes in one window, or None.

    Scenes are counted per pixel and `window_days` of the calendar; a window touches three such
    blocks. The count reads key columns only and is the one action here: nearly always nothing is
    busy, and the plan then needs no split. The list is broadcast only when it was seen to be short.
    """
    block = F.floor(F.datediff("date", F.lit("1970-01-01").cast("date")) / window_days)
    crowded = (
        scenes.groupBy("plot_id", "pixel_id", block.alias("_block")).agg(F.count("*").alias("_n"))
        .where(F.col("_n") > limit // 3).select("plot_id", "pixel_id").distinct()
    )
    found = crowded.count()
    if found == 0:
        return None
    return F.broadcast(crowded) if found <= broadcast_rows else crowded


def _median_of(values: Column) -> Column:
    """Median of a short array: the middle value, or the mean of the two in the middle."""
    def middle(a: Column) -> Column:
        n = F.size(a)
        low, high = F.get(a, F.floor((n - 1) / 2).cast("int")), F.get(a, F.floor(n / 2).cast("int"))
        return low + (high - low) * 0.5

    ordered = F.array_sort(F.array_compact(values))
    return F.transform(F.array(ordered), middle)[0]


def median_image(matched: DataFrame) -> DataFrame:
    """Exact temporal median per pixel and index: a window's few scenes collected once, sorted per index."""
    scenes = matched.groupBy(*PIXEL_KEY).agg(F.collect_list(F.struct(*S.INDICES)).alias("_scenes"))
    return scenes.select(*PIXEL_KEY, *[_median_of(F.col("_scenes")[i]).alias(i) for i in S.INDICES])


def ranked_median_image(matched: DataFrame) -> DataFrame:
    """The same image for pixels with very many scenes: no group is gathered anywhere."""
    long = matched.unpivot(PIXEL_KEY, list(S.INDICES), "_index", "_v")
    ranked = exact_quantiles(long, [*PIXEL_KEY, "_index"], "_v", [0.5])
    wide = ranked.groupBy(*PIXEL_KEY).agg(*[
        F.max(F.when(F.col("_index") == i, F.col("quantiles")[0])).alias(i) for i in S.INDICES])
    # Pixels whose indices are all NULL keep their row.
    return matched.select(*PIXEL_KEY).distinct().join(wide, PIXEL_KEY, "left")


def sampled_medians(
    scenes: DataFrame, plots: DataFrame, window_days: int = 10, step_days: int = 5, default_days: int = 60,
    busy: DataFrame | None = None,
) -> DataFrame:
    """Scenes to median images, placed by plot. Rows of `busy` pixels part before anything is placed."""
    def matched(part: DataFrame, by_plot: bool) -> DataFrame:
        return match_samples(part, plots, window_days, step_days, default_days, by_plot=by_plot).select(*PIXEL_KEY, *S.INDICES)

    if busy is None:
        return median_image(matched(scenes, True))
    pair = ["plot_id", "pixel_id"]
    usual = median_image(matched(scenes.join(busy, pair, "left_anti"), True))
    return usual.unionByName(ranked_median_image(matched(scenes.join(busy, pair, "left_semi"), False)))


def mean_image(matched: DataFrame) -> DataFrame:
    return matched.groupBy(*PIXEL_KEY).agg(*[F.avg(i).alias(i) for i in S.INDICES])


def image_statistics(image: DataFrame) -> DataFrame:
    """Mean, population spread, least and greatest value of every index over the pixels of a sample."""
    stats = {"mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max}
    return image.groupBy(*SAMPLE_KEY).agg(*[
        f(i).alias(f"{name}_{i}") for i in S.INDICES for name, f in stats.items()])


def with_cumulative_means(samples: DataFrame) -> DataFrame:
    """Running sums of the means in sample order; a missing mean adds nothing.

    A plot has at most (VT - planting) / step samples, so its window is bounded.
    """
    so_far = W.partitionBy("plot_id").orderBy("sample_date").rowsBetween(W.unboundedPreceding, 0)
    return samples.withColumns({
        f"cumulative_{i}": F.sum(F.coalesce(f"mean_{i}", F.lit(0.0))).over(so_far)
        for i in S.INDICES
    })


def satellite_input(stages: DataFrame, vt: DataFrame) -> DataFrame:
    """Plots to sample: coordinates, planting date and VT where known."""
    dates = vt.select("plot_id", F.col("vt_stage_date").alias("vt_date"))
    return (
        stages.select("plot_id", "latitude", "longitude", "planting_date")
        .join(dates, "plot_id", "left").dropna(subset=["latitude", "longitude"])
    )


def plot_indices(
    pixels: DataFrame, plots: DataFrame, window_days: int = 10, step_days: int = 5,
    max_cloud_pct: float = 60.0, default_days: int = 60, busy_limit: int = 300_000,
) -> DataFrame:
    """The whole chain: usable scenes, indices, matched samples, median image, statistics, running sums.

    Samples without a scene have no row.
    """
    require(plots, ["plot_id", "latitude", "longitude", "planting_date"], "satellite input")
    usable = usable_scenes(pixels, max_cloud_pct=max_cloud_pct)
    scenes = with_indices(with_bands(usable)).select("plot_id", "date", "pixel_id", *S.INDICES)
    busy = busy_pixels(usable, busy_limit, window_days)
    images = sampled_medians(scenes, plots, window_days, step_days, default_days, busy)
    samples = with_cumulative_means(image_statistics(images))
    order = [f"{s}_{i}" for i in S.INDICES for s in ("mean", "std", "min", "max", "cumulative")]
    return samples.select(
        "plot_id", F.col("sample_date").alias("date"),
        F.date_format("sample_date", "yyyy-MM-dd'T'HH:mm:ss").alias("sample_date_iso"), *order)


def number_or_null(df: DataFrame, column: str) -> Column:
    """A plain value, or the `value` field of a struct, as a number; anything else is NULL."""
    from pyspark.sql import types as T

    if isinstance(df.schema[column].dataType, T.StructType):
        return C.to_number(F.col(f"{column}.value"))
    return C.to_number(F.col(column))
