"""Column expressions: everything here stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from agrospark import schemas as S


def clean_nan(col: Column) -> Column:
    """NaN means missing in the sources; it is NULL from here on."""
    return F.when(~F.isnan(col), col)


def complete_row(columns: Sequence[str]) -> Column:
    """The columns as a struct that sorts missing values last: a flag in front of every value.

    Its minimum is one whole row, whatever the order of the rows, and never an empty one beside a full one.
    """
    return F.struct(*[
        x for i, c in enumerate(columns) for x in (F.col(f"`{c}`").isNull().alias(f"_missing_{i}"), F.col(f"`{c}`").alias(c))])


def to_number(col: Column) -> Column:
    return clean_nan(F.trim(col.cast("string")).try_cast("double"))


def to_long(col: Column) -> Column:
    """A number with no fraction as BIGINT, anything else NULL."""
    number = to_number(col)
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def to_day(col: Column) -> Column:
    """Parse `yyyy-MM-dd` (with or without a time) or `M/d/yyyy`; unreadable text is NULL."""
    text = F.trim(col.cast("string"))
    return F.coalesce(
        text.try_cast("date"),
        F.try_to_timestamp(text, F.lit("M/d/yyyy")).cast("date"),
    )


def normalize_season(col: Column) -> Column:
    name = F.lower(F.trim(col))
    return (
        F.when(name.isin(*S.SHORT_RAINS_NAMES), S.SHORT_RAINS)
        .when(name.isin(*S.LONG_RAINS_NAMES), S.LONG_RAINS)
    )


def derive_season(day: Column) -> Column:
    return F.when(F.month(day).between(2, 5), S.LONG_RAINS).otherwise(S.SHORT_RAINS)


def derive_season_strict(day: Column) -> Column:
    return (
        F.when(F.month(day).between(3, 5), S.LONG_RAINS)
        .when(F.month(day).between(10, 12), S.SHORT_RAINS)
        .when(day.isNotNull(), S.OFF_SEASON)
    )


def season_start(season: Column, year: Column) -> Column:
    name = F.lower(season)
    return (
        F.when(name == S.SHORT_RAINS.lower(), F.make_date(year, F.lit(9), F.lit(1)))
        .when(name == S.LONG_RAINS.lower(), F.make_date(year, F.lit(2), F.lit(1)))
    )


def season_end(season: Column, year: Column) -> Column:
    name = F.lower(season)
    return (
        F.when(name == S.SHORT_RAINS.lower(), F.make_date(year, F.lit(12), F.lit(31)))
        .when(name == S.LONG_RAINS.lower(), F.make_date(year, F.lit(5), F.lit(31)))
    )


def altitude_delay(
    altitude: Column, base: float = S.BASE_ALTITUDE_M, step: float = S.METRES_PER_DELAY_DAY
) -> Column:
    return F.when(altitude > base, F.floor((altitude - base) / step)).otherwise(0).cast("int")


def rain_ok(precip: Column, min_rain: float = S.MIN_PLANTING_RAIN_MM) -> Column:
    return precip >= min_rain


def warm_enough(tmax: Column, tmin: Column, min_temp: float = S.MIN_PLANTING_TEMP_C) -> Column:
    return (tmax + tmin) / 2 >= min_temp


def planting_confidence(
    precip: Column,
    tmax: Column,
    tmin: Column,
    min_rain: float = S.MIN_PLANTING_RAIN_MM,
    min_temp: float = S.MIN_PLANTING_TEMP_C,
) -> Column:
    rain = precip - min_rain
    warmth = (tmax + tmin) / 2 - min_temp
    rain_bonus = F.when(rain > 10, 0.15).when(rain > 5, 0.10).otherwise(0.0)
    warmth_bonus = F.when(warmth > 5, 0.15).when(warmth > 2, 0.10).otherwise(0.0)
    base = F.when((rain >= 0) & (warmth >= 0), 0.7).otherwise(0.0)
    return F.least(base + rain_bonus + warmth_bonus, F.lit(1.0))


def daily_gdd(tmax: Column, tmin: Column, base: float = S.GDD_BASE_C) -> Column:
    """Zero below the base temperature; NULL when a temperature is missing."""
    warmth = (tmax + tmin) / 2 - base
    return F.when(warmth > 0, warmth).when(warmth.isNotNull(), 0.0)


def gdd_units(gdd: Column) -> Column:
    """Degree days as whole millionths, 0 when missing: exact to sum, cheap to add."""
    return F.coalesce(F.round(gdd * S.GDD_UNIT).cast("bigint"), F.lit(0))


def maturity_class(altitude: Column) -> Column:
    return (
        F.when(altitude < S.BASE_ALTITUDE_M, "early")
        .when(altitude <= S.LATE_ALTITUDE_M, "medium")
        .otherwise("late")
    )


def stage_threshold(altitude: Column, stage: str) -> Column:
    table = S.GDD_THRESHOLDS
    return (
        F.when(altitude < S.BASE_ALTITUDE_M, table["early"][stage])
        .when(altitude <= S.LATE_ALTITUDE_M, table["medium"][stage])
        .otherwise(table["late"][stage])
    )


def count_present(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])


def stage_confidence(stages: tuple[str, ...] = S.STAGES) -> Column:
    share = count_present([F.col(s) for s in stages]) / float(len(stages))
    bonus = F.when(F.col("VT").isNotNull(), 0.2).otherwise(0.0)
    return F.least(F.round(share + bonus, 2), F.lit(1.0))


def current_stage(day: Column, planting: Column, stages: dict[str, Column]) -> Column:
    """The last stage, in growth order, that has begun by `day`."""
    label = F.when(day.isNull(), F.lit(None).cast("string")).when(day < planting, "pre_planting")
    for name in reversed(list(stages)):
        label = label.when(day >= stages[name], name)
    return label.when(planting.isNotNull(), "post_planting_pre_VE").otherwise("unknown")


def drift_level(psi: Column) -> Column:
    return F.when(psi >= S.PSI_HIGH, "high").when(psi >= S.PSI_MEDIUM, "medium").otherwise("low")


def psi_term(ref_share: Column, cur_share: Column) -> Column:
    return (cur_share - ref_share) * F.ln(cur_share / ref_share)


def share_or_floor(part: Column, whole: Column) -> Column:
    return F.when(part == 0, S.PSI_EMPTY_SHARE).otherwise(part / whole)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres on the mean Earth sphere."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return 2 * 6371008.8 * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def vegetation_indices(band: dict[str, Column]) -> dict[str, Column]:
    """Six index expressions over the named bands; a zero denominator gives NULL."""
    def ratio(top: Column, bottom: Column) -> Column:
        return F.try_divide(top, bottom)

    blue, green, red = band["blue"], band["green"], band["red"]
    edge, nir, swir = band["red_edge"], band["nir"], band["swir"]
    return {
        "ndvi": ratio(nir - red, nir + red),
        "evi": ratio((nir - red) * 2.5, nir + red * 6.0 - blue * 7.5 + 1.0),
        "savi": ratio(nir - red, nir + red + 0.5) * 1.5,
        "ndre": ratio(nir - edge, nir + edge),
        "ndwi": ratio(green - nir, green + nir),
        "ndmi": ratio(nir - swir, nir + swir),
    }
