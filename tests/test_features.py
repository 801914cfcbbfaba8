import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from agrospark import schemas as S
from agrospark.operators import features as X
from tests.conftest import by, day


def fixture(spark):
    weather = spark.createDataFrame(
        [(1, day(f"2021-10-{d:02d}"), None if d == 1 else -1.0, 37.0, 30.0, 10.0, None if d == 3 else 2.0) for d in range(1, 11)]
        + [(2, day("2021-10-01"), -2.0, 38.0, 30.0, 10.0, None)],
        "plot_id long, date date, latitude double, longitude double, max_temp_c double, min_temp_c double, precip_mm double")
    planting = spark.createDataFrame([(1, day("2021-10-03")), (1, day("2021-10-04"))], "plot_id long, inferred_planting_date date")
    stages = spark.createDataFrame(
        [(1, day("2021-10-03"), day("2021-10-05"), None, None, day("2021-10-09"), None, None, None, "Short Rains", 1300.0, 0.5)],
        "plot_id long, planting_date date, VE date, V2 date, V6 date, VT date, R1 date, R4 date, R6 date, season string, altitude double, confidence double")
    sat = spark.createDataFrame([(1, day("2021-10-03"), 0.4, 0.4), (1, day("2021-10-08"), 0.6, 1.0)],
                                "plot_id long, date date, mean_ndvi double, cumulative_ndvi double")
    return weather, planting, stages, sat


def test_daily_and_plot_features(spark):
    weather, planting, stages, sat = fixture(spark)
    daily = X.daily_features(weather, planting, stages, sat)
    assert daily.count() == weather.count()
    got = by(daily, "plot_id", "date")
    assert got[1, day("2021-10-02")]["gdd_cumulative"] is None and got[1, day("2021-10-02")]["days_since_planting"] == -1
    r = got[1, day("2021-10-08")]
    assert (r.gdd_cumulative, r.current_stage, r.mean_ndvi, r.days_since_planting) == (60.0, "VE", 0.6, 5)
    assert got[2, day("2021-10-01")]["current_stage"] == "unknown" and got[2, day("2021-10-01")]["gdd_cumulative"] is None
    plot = by(X.plot_features(daily, stages), "plot_id")
    one, two = plot[1], plot[2]
    assert (one.precip_total, one.gdd_sum, one.gdd_peak, one.latitude) == (18.0, 100.0, 80.0, -1.0)
    assert one.mean_ndvi == pytest.approx(0.5) and one.days_to_vt == 6 and one.season == "Short Rains"
    assert (two.precip_total, two.gdd_peak, two.days_to_vt) == (0.0, None, None)
    since = by(X.plot_totals(daily, since_planting=True), "plot_id")
    assert since[1].gdd_sum == 80.0 and 2 not in since


def test_strict_mode_fans_out(spark):
    weather, planting, stages, sat = fixture(spark)
    assert X.daily_features(weather, planting, stages, sat, dedupe=False).count() == 21


def test_index_totals(spark):
    *_, sat = fixture(spark)
    r = X.index_totals(sat).first()
    assert r.total_mean_ndvi == pytest.approx(1.0) and r.cumulative_ndvi == 1.0


def test_category_codes_follow_sorted_text(spark):
    values = ["maize", "beans", None, "nan", "Maize", "maize", "mango"]
    df = spark.createDataFrame([(v,) for v in values], "crop_type string")
    got = {r.crop_type: r.crop_type_enc for r in X.with_category_code(df).collect()}
    assert got == {"Maize": 0, "beans": 1, "maize": 2, "mango": 3, "nan": 4, None: 4}


def test_scoring_defaults(spark):
    requests = spark.createDataFrame(
        [(1, -1.0, 37.0, day("2021-10-07"), None, None), (2, -1.0, 37.0, day("2021-10-07"), "Long Rains", 0.0), (3, -1.0, 37.0, day("2021-10-07"), "", 900.0)],
        "plot_id long, latitude double, longitude double, planting_date date, season string, altitude double")
    features = spark.createDataFrame([(1, 12.0, 5.0, "Short Rains")], "plot_id long, precip_total double, gdd_sum double, season string")
    got = by(X.features_for_scoring(requests, features), "plot_id")
    assert got[1].has_features and got[1].precip_total == 12.0 and got[1].mean_ndvi is None
    assert (got[2].altitude, got[2].season, got[2].gdd_sum, got[2].plant_doy) == (1200.0, "Long Rains", 0.0, 280)
    assert (got[3].altitude, got[3].season) == (900.0, "Short Rains")


@pytest.mark.parametrize("kind, block", [("date", "day"), ("timestamp_ntz", "day"), ("timestamp_ntz", "week"), ("timestamp_ntz", "year")])
def test_asof_matches_merge_asof_with_a_hot_key(spark, kind, block):
    start = dt.datetime(2021, 1, 1)
    entities = [(i, 1 if i % 3 else i % 7, start + dt.timedelta(hours=(i * 37) % 5000)) for i in range(300)]
    step = 24 if kind == "date" else 7
    view = [(1 if i % 2 else i % 9, start + dt.timedelta(hours=step * ((i * 13) % 200)), float(i)) for i in range(150)]
    e = spark.createDataFrame([*entities, (300, None, start), (301, 1, None)], "id long, plot_id long, ts timestamp_ntz")
    v = spark.createDataFrame(view, "plot_id long, date timestamp_ntz, gdd double").withColumn("date", F.col("date").cast(kind))
    got = {r.id: r.gdd for r in X.lookup_asof(e, X.feature_view(v, ["gdd", "absent"]), block=block).collect()}
    left = pd.DataFrame(entities, columns=["id", "plot_id", "ts"]).astype({"ts": "datetime64[ns]"}).sort_values("ts")
    right = pd.DataFrame(view, columns=["plot_id", "ts", "gdd"]).astype({"ts": "datetime64[ns]"})
    right = right.groupby(["plot_id", "ts"], as_index=False)["gdd"].min().sort_values("ts")
    wanted = {int(r.id): (None if pd.isna(r.gdd) else r.gdd) for r in pd.merge_asof(left, right, on="ts", by="plot_id").itertuples()}
    assert got == {**wanted, 300: None, 301: None} and len(set(wanted.values())) > 20


def test_lookup_features_is_a_filter(spark):
    snap = spark.createDataFrame([(1, 1.0), (2, 2.0)], "plot_id long, x double")
    wanted = spark.createDataFrame([(2,), (2,), (9,)], "plot_id long")
    assert [r.x for r in X.lookup_features(snap, wanted).collect()] == [2.0]
