"""Planting dates, growing degree days and growth stages.

Weather is one row per (plot_id, date), which the duplicate gate enforces and
`quality.unique_days` establishes: a plot's window never holds more rows than the calendar has days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from agrospark import schemas as S
from agrospark.functions import columns as C
from agrospark.functions.names import require
from agrospark.operators.normalize import find_planting_column, with_plot_defaults


def _so_far() -> WindowSpec:
    return W.partitionBy("plot_id").orderBy("date").rowsBetween(W.unboundedPreceding, W.currentRow)


def planting_test(weather: DataFrame, min_rain: float = S.MIN_PLANTING_RAIN_MM,
                  min_temp: float = S.MIN_PLANTING_TEMP_C) -> DataFrame:
    """Each day with its two criteria."""
    return weather.withColumn("criteria_met", F.create_map(
        F.lit("rainfall_threshold"), C.rain_ok(F.col("precip_mm"), min_rain),
        F.lit("temperature_threshold"),
        C.warm_enough(F.col("max_temp_c"), F.col("min_temp_c"), min_temp),
    ))


def _day_values(alias_date: str = "date") -> Column:
    return F.struct(F.col(alias_date).alias("date"), "precip_mm", "max_temp_c", "min_temp_c")


def infer_planting_dates(
    weather: DataFrame,
    plots: DataFrame,
    min_rain: float = S.MIN_PLANTING_RAIN_MM,
    min_temp: float = S.MIN_PLANTING_TEMP_C,
) -> DataFrame:
    """First rainy and warm day per plot plus the altitude delay, with its confidence.

    Plots without such a day have no row; weather of unknown plots counts as base altitude.
    The first day is a partial aggregate, so only one candidate per plot and task is shuffled.
    """
    suitable = C.rain_ok(F.col("precip_mm"), min_rain) & C.warm_enough(
        F.col("max_temp_c"), F.col("min_temp_c"), min_temp)
    first = (
        weather.where(suitable).groupBy("plot_id")
        .agg(F.min_by(_day_values(), F.struct("date", "precip_mm", "max_temp_c", "min_temp_c")).alias("day"))
    )
    return planting_rows(first.join(plots.select("plot_id", "altitude"), "plot_id", "left"), min_rain, min_temp)


def planting_rows(
    found: DataFrame, min_rain: float = S.MIN_PLANTING_RAIN_MM, min_temp: float = S.MIN_PLANTING_TEMP_C
) -> DataFrame:
    """Planting dates from (plot_id, altitude, day), the first suitable day."""
    delay = C.altitude_delay(F.coalesce("altitude", F.lit(S.BASE_ALTITUDE_M)))
    return found.select(
        "plot_id",
        F.date_add("day.date", delay).alias("inferred_planting_date"),
        F.lit(None).cast("date").alias("actual_planting_date"),
        C.planting_confidence(
            F.col("day.precip_mm"), F.col("day.max_temp_c"), F.col("day.min_temp_c"), min_rain, min_temp
        ).alias("confidence_score"),
        F.lit(S.PLANTING_METHOD).alias("method"),
        F.create_map(
            F.lit("rainfall_threshold"), F.lit(True), F.lit("temperature_threshold"), F.lit(True),
        ).alias("criteria_met"),
        delay.alias("altitude_adjustment_days"),
    )


def with_plot_metadata(planting: DataFrame, plots: DataFrame) -> DataFrame:
    """Altitude and season of the plot next to its planting date."""
    return planting.withColumnRenamed("inferred_planting_date", "planting_date").join(
        plots.select("plot_id", "altitude", "season"), "plot_id", "left")


def with_daily_gdd(weather: DataFrame, base: float = S.GDD_BASE_C) -> DataFrame:
    return weather.withColumn("daily_gdd", C.daily_gdd(F.col("max_temp_c"), F.col("min_temp_c"), base))


def with_cumulative_gdd(weather: DataFrame) -> DataFrame:
    """Running GDD from the planting date on; NULL before it, or when there is none.

    Needs `planting_date` and `daily_gdd`. Sums are exact, read out as double.
    """
    growing = F.col("date") >= F.col("planting_date")
    step = F.when(growing, C.gdd_units(F.col("daily_gdd")))
    total = F.sum(step).over(_so_far())
    return weather.withColumn("gdd_cumulative", F.when(growing, total) / F.lit(float(S.GDD_UNIT)))


def stage_thresholds(plots: DataFrame) -> DataFrame:
    """Maturity class and the seven thresholds of each plot."""
    return plots.select(
        "plot_id", C.maturity_class(F.col("altitude")).alias("maturity_class"),
        *[C.stage_threshold(F.col("altitude"), s).alias(s) for s in S.STAGES])


def _first_planting_rows(planting: DataFrame, date: str) -> DataFrame:
    """One row per plot: the earliest planting date, missing dates last."""
    row = F.struct(F.col(date).alias("planting_date"), "altitude", "season")
    order = F.struct(F.col(date).isNull().alias("missing"), F.col(date).alias("at"), "altitude", "season")
    return planting.groupBy("plot_id").agg(F.min_by(row, order).alias("row")).select("plot_id", "row.*")


def _stages_of_days(days: DataFrame, *more: Column) -> DataFrame:
    """Stage dates per plot from days that carry planting_date, altitude, season and daily_gdd; and further aggregates."""
    growing = F.col("date") >= F.col("planting_date")
    step = F.when(growing, C.gdd_units(F.col("daily_gdd")))
    cumulative = days.withColumn("_total", F.when(growing, F.sum(step).over(_so_far())))
    found = [
        F.min(F.when(F.col("_total") >= C.stage_threshold(F.col("altitude"), s) * S.GDD_UNIT, F.col("date"))).alias(s)
        for s in S.STAGES
    ]
    per_plot = cumulative.groupBy("plot_id").agg(
        F.min_by("latitude", "date").alias("latitude"),
        F.min_by("longitude", "date").alias("longitude"),
        F.first("altitude").alias("altitude"),
        F.first("season").alias("season"),
        F.first("planting_date").alias("planting_date"),
        *found, *more,
    )
    return per_plot.select(
        "plot_id", "latitude", "longitude", "altitude", "season", "planting_date",
        F.lit("gdd").alias("method"), C.stage_confidence().alias("confidence"), *S.STAGES,
        *per_plot.columns[6 + len(S.STAGES):])


def _with_coordinates(weather: DataFrame) -> DataFrame:
    absent = {c: F.lit(None).cast("double") for c in ("latitude", "longitude") if c not in weather.columns}
    return weather.withColumns(absent) if absent else weather


def stage_dates(weather: DataFrame, planting: DataFrame, base: float = S.GDD_BASE_C) -> DataFrame:
    """First day each stage's degree-day threshold is reached, one row per plot with weather.

    Thresholds sit in a CASE, so there is no join with the stage table; the running sum and the
    per-plot aggregate share one exchange on plot_id. Plots without a planting date, or without
    weather after it, keep a row with empty stages.
    """
    require(weather, ["plot_id", "date", "max_temp_c", "min_temp_c"], "weather")
    require(planting, ["plot_id"], "planting dates")
    date = find_planting_column(planting)
    first = _first_planting_rows(with_plot_defaults(planting), date)
    days = with_daily_gdd(_with_coordinates(weather), base).select(
        "plot_id", "date", "latitude", "longitude", "daily_gdd")
    return _stages_of_days(days.join(first, "plot_id"))


def _days_since_planting(weather: DataFrame, plots: DataFrame, base: float) -> DataFrame:
    """Days of planted plots with `suitable`, planting_date, altitude, season and daily_gdd."""
    suitable = C.rain_ok(F.col("precip_mm")) & C.warm_enough(F.col("max_temp_c"), F.col("min_temp_c"))
    # Ordered like the running sum, so that one sort serves both windows.
    whole_plot = W.partitionBy("plot_id").orderBy("date").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    known = _with_coordinates(weather).join(plots.select("plot_id", "altitude", "season"), "plot_id", "left")
    first_day = F.min(F.when(suitable, F.col("date"))).over(whole_plot)
    altitude = F.coalesce("altitude", F.lit(S.BASE_ALTITUDE_M))
    days = (
        known.withColumn("suitable", suitable).withColumn("_first", first_day).where(F.col("_first").isNotNull())
        .withColumn("planting_date", F.date_add("_first", C.altitude_delay(altitude)))
    )
    return with_daily_gdd(days, base)


def stage_dates_from_weather(weather: DataFrame, plots: DataFrame, base: float = S.GDD_BASE_C) -> DataFrame:
    """`infer_planting_dates` and `stage_dates` in one pass over the weather.

    The first suitable day is a window minimum over the plot, which shares its exchange on plot_id
    with the running sum; nothing is read or shuffled twice. Plots never planted have no row.
    """
    return _stages_of_days(_days_since_planting(weather, plots, base))


def planting_and_stages(weather: DataFrame, plots: DataFrame, base: float = S.GDD_BASE_C) -> DataFrame:
    """`stage_dates_from_weather` with the first suitable `day`, from which `planting_rows` makes the planting dates."""
    order = F.when(F.col("suitable"), F.struct("date", "precip_mm", "max_temp_c", "min_temp_c"))
    return _stages_of_days(_days_since_planting(weather, plots, base), F.min_by(_day_values(), order).alias("day"))


def vt_dates(stages: DataFrame, fallback_days: int = 55) -> DataFrame:
    """Tasselling date with its source: reached, else silking, else days after planting."""
    confidence = F.coalesce("confidence", F.lit(0.0))
    estimated = F.date_add("planting_date", fallback_days)
    vt, r1 = F.col("VT").isNotNull(), F.col("R1").isNotNull()
    return stages.select(
        "plot_id",
        F.coalesce("VT", "R1", estimated).alias("vt_stage_date"),
        "planting_date",
        F.when(vt, "gdd_calculated").when(r1, "r1_fallback").otherwise("estimated").alias("source"),
        F.when(vt, confidence).when(r1, F.greatest(confidence - 0.2, F.lit(0.0)))
        .otherwise(F.greatest(confidence - 0.4, F.lit(0.0))).alias("confidence"),
        F.when(vt, F.lit(None)).when(r1, "VT_not_found_used_R1")
        .otherwise(f"VT_not_found_estimated_{fallback_days}_days").alias("note"),
    ).where(F.col("vt_stage_date").isNotNull())


def reached_vt(stages: DataFrame, default_confidence: float = 0.5) -> DataFrame:
    """Only plots that reached tasselling."""
    return stages.where(F.col("VT").isNotNull()).select(
        "plot_id", F.col("VT").alias("vt_stage_date"), "planting_date",
        F.lit("gdd_calculated").alias("source"),
        F.coalesce("confidence", F.lit(default_confidence)).alias("confidence"),
        F.lit(None).cast("string").alias("note"))


def stage_summary(stages: DataFrame) -> DataFrame:
    """Counts, share with VT, mean confidence and date ranges of a run."""
    return stages.agg(
        F.count("*").alias("plot_count"),
        F.count("VT").alias("vt_stage_found"),
        (F.count("VT") * 100.0 / F.count("*")).alias("vt_percentage"),
        F.avg("confidence").alias("average_confidence"),
        *[F.count(s).alias(f"found_{s}") for s in S.STAGES],
        F.min("planting_date").alias("earliest_planting"),
        F.max("planting_date").alias("latest_planting"),
        F.min("VT").alias("earliest_vt"),
        F.max("VT").alias("latest_vt"),
    )


def vt_source_summary(vt: DataFrame) -> DataFrame:
    """Plots, share and mean confidence per source; the window runs over at most three rows."""
    counted = vt.groupBy("source").agg(
        F.count("*").alias("plots"), F.avg("confidence").alias("average_confidence"))
    return counted.withColumn("percentage", F.col("plots") * 100.0 / F.sum("plots").over(W.partitionBy()))


def run_metadata(stages: DataFrame, vt: DataFrame, execution_date: str) -> DataFrame:
    """The summary of a run in one row, VT sources as a map of at most three entries."""
    sources = vt.groupBy("source").agg(F.count("*").alias("plots")).agg(
        F.map_from_entries(F.collect_list(F.struct("source", "plots")))).scalar()
    return stage_summary(stages).select(
        F.lit(execution_date).alias("execution_date"), "*", sources.alias("source_distribution"))


def long_form_stages(
    weather: DataFrame, planting: DataFrame, thresholds: dict[str, int] | None = None,
    base: float = S.GDD_BASE_C,
) -> DataFrame:
    """One row per reached stage: date, GDD on that day and the ideal GDD.

    All thresholds are answered in one aggregate per plot and exploded afterwards.
    """
    thresholds = thresholds or S.LONG_FORM_STAGES
    days = with_daily_gdd(_with_coordinates(weather), base).select(
        "plot_id", "date", "latitude", "longitude", "daily_gdd"
    ).join(planting.select("plot_id", "planting_date"), "plot_id")
    growing = F.col("date") >= F.col("planting_date")
    step = F.when(growing, C.gdd_units(F.col("daily_gdd")))
    total = days.withColumn("_total", F.when(growing, F.sum(step).over(_so_far())))
    hits = [
        F.struct(
            F.lit(stage).alias("crop_stage"),
            F.min(F.when(F.col("_total") >= need * S.GDD_UNIT, F.struct("date", F.col("_total").alias("gdd")))).alias("hit"),
            F.lit(need).alias("ideal_gdd"),
        )
        for stage, need in thresholds.items()
    ]
    per_plot = total.groupBy("plot_id").agg(
        F.min_by("latitude", "date").alias("latitude"),
        F.min_by("longitude", "date").alias("longitude"),
        F.first("planting_date").alias("planting_date"),
        F.array(*hits).alias("stages"),
    )
    rows = per_plot.select("plot_id", "latitude", "longitude", "planting_date", F.explode("stages").alias("s"))
    return rows.where(F.col("s.hit").isNotNull()).select(
        "plot_id", "latitude", "longitude", "planting_date",
        F.col("s.crop_stage").alias("crop_stage"), F.col("s.hit.date").alias("stage_date"),
        (F.col("s.hit.gdd") / F.lit(float(S.GDD_UNIT))).alias("gdd"), F.col("s.ideal_gdd").alias("ideal_gdd"))


def latest_stage(long_stages: DataFrame) -> DataFrame:
    """Last stage per plot; on one day the higher threshold wins."""
    return long_stages.groupBy("plot_id").agg(
        F.max_by(F.struct("crop_stage", "stage_date"), F.struct("stage_date", "ideal_gdd")).alias("s"),
    ).select("plot_id", "s.crop_stage", "s.stage_date")


def season_summary(weather: DataFrame, latest: DataFrame, planting: DataFrame) -> DataFrame:
    """Weather between planting and the latest stage, both ends included, one row per plot.

    The period is one row per plot, so the range condition filters an equi-join and multiplies nothing.
    """
    period = latest.join(planting.select("plot_id", "planting_date"), "plot_id")
    inside = weather.join(period, "plot_id").where(
        F.col("date").between(F.col("planting_date"), F.col("stage_date")))
    return _summary(inside)


def season_summary_from_weather(
    weather: DataFrame, plots: DataFrame, thresholds: dict[str, int] | None = None, base: float = S.GDD_BASE_C
) -> DataFrame:
    """`infer_planting_dates`, `long_form_stages`, `latest_stage` and `season_summary` in one pass over the weather.

    Planting day, running sum and whole sum share one placement by plot. The latest stage is the highest threshold the
    whole sum reaches; a day belongs to the period if the sum before it has not reached that threshold.
    """
    days = _days_since_planting(weather, plots, base).where(F.col("date") >= F.col("planting_date"))
    step = C.gdd_units(F.col("daily_gdd"))
    whole = W.partitionBy("plot_id").orderBy("date").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    days = days.withColumn("_before", F.sum(step).over(_so_far()) - step).withColumn("_all", F.sum(step).over(whole))
    ordered = sorted((thresholds or S.LONG_FORM_STAGES).items(), key=lambda x: -x[1])
    need, stage = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    for name, units in reversed(ordered):  # the highest is asked for first
        reached = F.col("_all") >= units * S.GDD_UNIT
        need, stage = F.when(reached, F.lit(units * S.GDD_UNIT)).otherwise(need), F.when(reached, F.lit(name)).otherwise(stage)
    inside = days.withColumn("crop_stage", stage).where(F.col("_before") < need)
    return _summary(inside, F.max("date"))


def _summary(inside: DataFrame, stage_date: Column | None = None) -> DataFrame:
    wanted = {
        "max_temp_c": F.max, "min_temp_c": F.min, "mean_temp_c": F.avg, "precip_mm": F.sum,
        "humidity_pct": F.avg, "solar_energy_mjm2": F.sum, "evapotranspiration_mm": F.sum,
        "wind_speed_kmh": F.avg, "cloud_cover_pct": F.avg,
    }
    aggregates = [
        (F.coalesce(f(c), F.lit(0.0)) if f is F.sum else f(c)).alias(c)
        for c, f in wanted.items() if c in inside.columns
    ]
    return inside.groupBy("plot_id").agg(
        F.min_by("latitude", "date").alias("latitude"),
        F.min_by("longitude", "date").alias("longitude"),
        F.first("planting_date").alias("planting_date"),
        F.first("crop_stage").alias("latest_stage"),
        (F.first("stage_date") if stage_date is None else stage_date).alias("latest_stage_date"),
        *aggregates,
    )


def with_current_stage(days: DataFrame, stages: DataFrame, name: str = "current_stage") -> DataFrame:
    """Label of the stage in force on each day; plots without stages are 'unknown'."""
    calendar = stages.select(
        "plot_id", F.col("planting_date").alias("_planted"), *[F.col(s).alias(f"_{s}") for s in S.STAGES])
    label = C.current_stage(F.col("date"), F.col("_planted"), {s: F.col(f"_{s}") for s in S.STAGES})
    return days.join(calendar, "plot_id", "left").withColumn(name, label).drop(
        "_planted", *[f"_{s}" for s in S.STAGES])


def with_days_since_planting(days: DataFrame) -> DataFrame:
    return days.withColumn("days_since_planting", F.datediff("date", "planting_date"))

