import pytest
from pyspark.sql import functions as F

from agrospark import schemas as S
from agrospark.functions import columns as C
from agrospark.operators import phenology as P
from agrospark.operators import quality as Q
from tests.conftest import by, day

W = "plot_id long, date date, max_temp_c double, min_temp_c double, precip_mm double"


def weather(spark, rows):
    return spark.createDataFrame([(p, day(d), a, b, r) for p, d, a, b, r in rows], W)


def plots(spark, rows):
    return spark.createDataFrame(rows, "plot_id long, altitude double, season string")


@pytest.mark.parametrize("altitude, delay, kind", [
    (1200.0, 0, "medium"), (1200.01, 0, "medium"), (1299.9, 0, "medium"), (1300.0, 1, "medium"),
    (1600.0, 4, "medium"), (1600.01, 4, "late"), (1199.0, 0, "early"), (None, 0, "late")])
def test_altitude_rules(spark, altitude, delay, kind):
    df = spark.createDataFrame([(altitude,)], "a double")
    r = df.select(C.altitude_delay(F.col("a")).alias("d"), C.maturity_class(F.col("a")).alias("k")).first()
    assert (r.d, r.k) == (delay, kind)


@pytest.mark.parametrize("rain, hi, lo, expected", [
    (5.0, 20.0, 16.0, 0.7), (10.0, 20.0, 16.0, 0.7), (10.1, 20.0, 16.0, 0.8), (15.0, 20.0, 16.0, 0.8),
    (15.1, 20.0, 16.0, 0.85), (5.0, 24.0, 16.0, 0.7), (5.0, 24.2, 16.0, 0.8), (5.0, 30.0, 16.0, 0.8),
    (5.0, 30.2, 16.0, 0.85), (30.0, 40.0, 20.0, 1.0), (12.5, 28.5, 18.2, 0.95)])
def test_planting_confidence(spark, rain, hi, lo, expected):
    df = spark.createDataFrame([(rain, hi, lo)], "r double, h double, l double")
    got = df.select(C.planting_confidence(F.col("r"), F.col("h"), F.col("l"))).first()[0]
    assert got == pytest.approx(expected)


def test_planting_is_first_suitable_day_plus_delay(spark):
    w = weather(spark, [
        (1, "2021-10-03", 20.0, 16.0, 9.0), (1, "2021-10-02", 20.0, 16.0, 5.0), (1, "2021-10-01", 20.0, 15.0, 50.0),
        (2, "2021-10-01", 20.0, 16.0, 4.9), (3, "2021-10-01", None, 16.0, 9.0), (3, "2021-10-05", 20.0, 16.0, 5.0)])
    got = by(P.infer_planting_dates(w, plots(spark, [(1, 1432.0, "Short Rains")])), "plot_id")
    assert set(got) == {1, 3}  # plot 2 never qualifies; plot 3 is unknown, hence base altitude
    assert (got[1]["inferred_planting_date"], got[1]["altitude_adjustment_days"]) == (day("2021-10-04"), 2)
    assert got[3]["inferred_planting_date"] == day("2021-10-05")
    assert got[1]["criteria_met"] == {"rainfall_threshold": True, "temperature_threshold": True}


def test_gdd_day_and_running_sum(spark):
    w = weather(spark, [
        (1, "2021-10-01", 28.5, 18.2, 0.0), (1, "2021-10-02", None, 18.0, 0.0), (1, "2021-10-03", 9.0, 5.0, 0.0),
        (1, "2021-10-04", 30.0, 10.0, 0.0)]).withColumn("planting_date", F.lit("2021-10-02").cast("date"))
    got = by(P.with_cumulative_gdd(P.with_daily_gdd(w)), "date")
    assert got[day("2021-10-01")]["daily_gdd"] == pytest.approx(13.35)
    assert [got[day(f"2021-10-0{i}")]["daily_gdd"] for i in (2, 3, 4)] == [None, 0.0, 10.0]
    assert [got[day(f"2021-10-0{i}")]["gdd_cumulative"] for i in (1, 2, 3, 4)] == [None, 0.0, 0.0, 10.0]
    unplanted = w.withColumn("planting_date", F.lit(None).cast("date"))
    assert {r.gdd_cumulative for r in P.with_cumulative_gdd(P.with_daily_gdd(unplanted)).collect()} == {None}


def long_weather(spark, plot=1, days=200, gdd=10.0):
    return spark.range(days).select(
        F.lit(plot).cast("long").alias("plot_id"), F.date_add(F.lit("2021-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        F.lit(10.0 + gdd + 5).alias("max_temp_c"), F.lit(10.0 + gdd - 5).alias("min_temp_c"), F.lit(0.0).alias("precip_mm"))


def test_stage_reached_on_equality_and_null_planting_kept(spark):
    w = long_weather(spark).unionByName(long_weather(spark, plot=2)).unionByName(long_weather(spark, plot=3))
    planting = spark.createDataFrame(
        [(1, day("2021-01-11"), 1300.0, "Short Rains"), (1, day("2021-02-01"), 1300.0, "Short Rains"), (2, None, 1000.0, "Long Rains"),
         (4, day("2021-01-01"), 1.0, "x")],
        "plot_id long, planting_date date, altitude double, season string")
    got = by(P.stage_dates(w, planting), "plot_id")
    assert set(got) == {1, 2}  # plot 3 has no planting row, plot 4 no weather
    one = got[1]
    assert one["planting_date"] == day("2021-01-11")
    assert one["VE"] == day("2021-01-20")  # ten days of 10 reach exactly 100
    assert one["V2"] == day("2021-01-28") and one["VT"] == day("2021-04-20") and one["R6"] == day("2021-06-09")
    assert one["confidence"] == 1.0
    assert all(got[2][s] is None for s in S.STAGES) and got[2]["confidence"] == 0.0


def test_fused_and_composed_stage_runs_agree(spark):
    rows = [(p, f"2021-{m:02d}-{d:02d}", 22.0 + p + d % 7, 12.0 + (d * p) % 9, float((d * 7 + p) % 13))
            for p in range(1, 6) for m in range(1, 8) for d in range(1, 29)]
    w, known = weather(spark, rows), plots(spark, [(1, 900.0, "a"), (2, 1250.0, "b"), (3, 1700.0, "c"), (4, None, "d")])
    fused = P.stage_dates_from_weather(w, known)
    planting = P.with_plot_metadata(P.infer_planting_dates(w, known), known)
    composed = P.stage_dates(w, planting)
    assert sorted(map(str, fused.collect())) == sorted(map(str, composed.collect()))


def test_stage_dates_need_their_columns(spark):
    with pytest.raises(ValueError, match="max_temp_c"):
        P.stage_dates(long_weather(spark).drop("max_temp_c"), spark.createDataFrame([], "plot_id long, planting_date date"))


def stages(spark, rows):
    schema = "plot_id long, planting_date date, confidence double, " + ", ".join(f"{s} date" for s in S.STAGES)
    return spark.createDataFrame([(p, day(pd), c, *[day(x) for x in dates]) for p, pd, c, *dates in rows], schema)


def test_vt_fallbacks(spark):
    df = stages(spark, [
        (1, "2021-10-07", 0.9, None, None, None, "2021-12-15", "2021-12-25", None, None),
        (2, "2021-10-07", 0.1, None, None, None, None, "2021-12-25", None, None),
        (3, "2021-10-07", 0.6, None, None, None, None, None, None, None),
        (4, None, 0.6, None, None, None, None, None, None, None)])
    got = by(P.vt_dates(df), "plot_id")
    assert (got[1]["vt_stage_date"], got[1]["source"], got[1]["note"]) == (day("2021-12-15"), "gdd_calculated", None)
    assert (got[2]["vt_stage_date"], got[2]["source"], got[2]["confidence"]) == (day("2021-12-25"), "r1_fallback", 0.0)
    assert (got[3]["vt_stage_date"], got[3]["source"]) == (day("2021-12-01"), "estimated")
    assert got[3]["confidence"] == pytest.approx(0.2) and got[3]["note"] == "VT_not_found_estimated_55_days"
    assert 4 not in got
    assert [r.plot_id for r in P.reached_vt(df).collect()] == [1]
    summary = P.stage_summary(df).first()
    assert (summary.plot_count, summary.vt_stage_found, summary.vt_percentage) == (4, 1, 25.0)
    shares = {r.source: r.percentage for r in P.vt_source_summary(P.vt_dates(df)).collect()}
    assert sum(shares.values()) == pytest.approx(100.0)


def test_stage_confidence_example(spark):
    df = stages(spark, [(1, "2021-10-07", 0.0, "2021-10-16", "2021-10-23", "2021-11-12", "2021-12-15", "2021-12-25", None, None)])
    assert df.select(C.stage_confidence()).first()[0] == pytest.approx(0.91)


def test_current_stage(spark):
    cal = stages(spark, [(1, "2021-10-07", 0.9, "2021-10-16", "2021-10-23", None, "2021-12-15", None, None, "2022-01-20"),
                         (2, None, 0.0, None, None, None, None, None, None, None)])
    dates = ["2021-10-06", "2021-10-07", "2021-10-16", "2021-11-30", "2021-12-15", "2022-02-01"]
    days = spark.createDataFrame([(1, day(d)) for d in dates] + [(2, day("2021-10-07")), (3, day("2021-10-07")), (1, None)],
                                 "plot_id long, date date")
    got = {(r.plot_id, r.date): r.current_stage for r in P.with_current_stage(days, cal).collect()}
    assert [got[1, day(d)] for d in dates] == ["pre_planting", "post_planting_pre_VE", "VE", "V2", "VT", "R6"]
    assert got[2, day("2021-10-07")] == "unknown" and got[3, day("2021-10-07")] == "unknown" and got[1, None] is None


def test_long_form_stages_and_season_summary(spark):
    w = long_weather(spark, days=120).withColumns({c: F.lit(1.0) for c in (
        "latitude", "longitude", "mean_temp_c", "humidity_pct", "solar_energy_mjm2", "wind_speed_kmh", "cloud_cover_pct", "evapotranspiration_mm")})
    planting = spark.createDataFrame([(1, day("2021-01-01"))], "plot_id long, planting_date date")
    long = P.long_form_stages(w, planting)
    got = by(long, "crop_stage")
    assert got["Emergence (VE)"]["stage_date"] == day("2021-01-10") and got["Emergence (VE)"]["gdd"] == 100.0
    assert set(got) == {"Emergence (VE)", "V2 (Two leaves with collars visible)", "V6 (Six leaves with collars visible)",
                        "VT (Tasseling)", "R1 (Silking)"}
    latest = P.latest_stage(long)
    assert latest.first()["crop_stage"] == "R1 (Silking)"
    r = P.season_summary(w, latest, planting).first()
    assert r["solar_energy_mjm2"] == 110.0 and r["max_temp_c"] == 25.0 and r["latest_stage_date"] == day("2021-04-20")


def test_latest_stage_tie_takes_higher_threshold(spark):
    df = spark.createDataFrame([(1, "a", day("2021-01-01"), 250), (1, "b", day("2021-01-01"), 100)],
                               "plot_id long, crop_stage string, stage_date date, ideal_gdd int")
    assert P.latest_stage(df).first()["crop_stage"] == "a"


def test_gates(spark):
    good = weather(spark, [(1, "2021-10-01", 20.0, 10.0, 0.0)])
    assert Q.weather_gate(good).count() == 1
    bad = weather(spark, [(1, "2021-10-01", 20.0, 10.0, 0.0), (1, "2021-10-01", 61.0, 10.0, None), (1, "2021-10-01", 20.0, -99.0, 0.0)])
    v = Q.weather_verdict(bad).first().asDict()
    assert v == {"null_max_temp_c": 0, "null_min_temp_c": 0, "null_precip_mm": 1, "out_of_range": 1, "duplicates": 2, "passed": False}
    with pytest.raises(Q.QualityError, match="duplicates"):
        Q.weather_gate(bad)
    assert Q.unique_days(bad).count() == 1
    p = Q.profile(bad).first()
    assert (p.row_count, p.plot_count, p.null_counts["precip_mm"], p.duplicate_count) == (3, 1, 1, 0)
    assert Q.profile(bad.unionByName(bad)).first().duplicate_count == 3
    assert Q.missing_summary(bad).first()["column"] == "precip_mm"
