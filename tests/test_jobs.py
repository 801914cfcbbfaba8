import datetime as dt

import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from agrospark.catalog.base import Tables as TestTables
from agrospark.catalog.sources import payloads_of
from agrospark.operators import drift as D
from agrospark.operators import models as M
from agrospark.operators import phenology as P
from agrospark.operators import quality as Q
from agrospark.plans import jobs
from agrospark.sources import snapshots
from tests.conftest import day

SF = "/root/testdata/sf0.001"


def test_daily_runs_from_weather_to_drift(spark, tmp_path):
    t, tables = TestTables(spark, SF), jobs.Tables(str(tmp_path))
    with pytest.raises(FileNotFoundError):
        jobs.materialize_features(spark, tables, "2024-01-01")
    report, summary = jobs.drift_check(spark, tables, "2024-01-01")
    assert report is None and summary.first().status == "no_data"
    out = jobs.weather_to_stages(spark, tables, t.weather, t.plots, "2024-01-01")
    assert out["crop_stages"].count() == out["vt_stages"].count() == out["planting_dates"].count() == 10
    samples = jobs.satellite_samples(spark, tables, t.pixels, "2024-01-01")
    assert samples.count() > 100
    features = jobs.materialize_features(spark, tables, "2024-01-01")
    assert features["daily_features"].count() == t.weather.count() and features["plot_features"].count() == 10
    report, summary = jobs.drift_check(spark, tables, "2024-01-01")
    assert report is None and summary.first().status == "no_reference"
    jobs.materialize_features(spark, tables, "2024-01-02")
    report, summary = jobs.drift_check(spark, tables, "2024-01-02")
    assert summary.first().status == "ok" and summary.first().n_high == 0
    assert report.where("psi > 1e-9").count() == 0  # the same weather again
    # The sketches that are stored with the features give the same report as the features alone.
    current = snapshots.read_snapshot(spark, tables.path("daily_features"), "2024-01-02").drop("ds")
    shifted = current.withColumn("gdd_daily", F.col("gdd_daily") + 1) if "gdd_daily" in current.columns else current
    snapshots.write_snapshot(shifted, tables.path("daily_features"), "2024-01-03")
    jobs.store_sketches(spark, tables, "2024-01-03")
    report, _ = jobs.drift_check(spark, tables, "2024-01-03")
    numeric, other = D.choose_features(shifted)
    days = snapshots.last_days(spark, tables.path("daily_features"), "2024-01-03")
    assert len(days) == 2 and all(x is not None for x in jobs.stored_sketches(spark, tables, days, dt.date(2024, 1, 3), numeric, other))
    reference = snapshots.read_last_n(spark, tables.path("daily_features"), "2024-01-03").drop("ds")
    plain = D.drift_report(reference, shifted)
    key = lambda df: sorted((r.feature, round(r.psi, 9), r.missing_cur) for r in df.collect())
    assert key(report) == key(plain)
    labels = jobs.store_labels(spark, tables, t.harvest, "2024-01-01")
    table = jobs.training_table(labels, features["plot_features"])
    assert table.count() == 10 and table.where("match_tier > 0").count() == 10
    assert table.where("plot_id is null").count() == 0 and "plant_doy" in table.columns
    numbers = ["precip_total", "gdd_sum", "plant_doy"]
    model = M.pipeline(RandomForestRegressor(numTrees=3, maxDepth=3, seed=1), numbers, M.TARGET).fit(
        M.as_double(M.training_rows(table), [*numbers, M.TARGET]))
    scored, counts = jobs.score_plots(spark, tables, t.score_requests, model, numbers, "forest", "2024-01-02")
    assert tuple(counts.first()) == (150, 150, 0) and scored.select("model_name").distinct().count() == 1
    requests = t.score_requests.withColumn("model_name", F.when(F.col("request_id") % 2 == 0, "forest"))
    done, refused = jobs.score_requests(spark, tables, requests, {"forest": model, "ensemble": model}, numbers, "2024-01-03")
    bad = requests.where("altitude < 0 or altitude > 10000").count()
    assert bad > 0 and done.count() == 150 - bad and refused.count() == bad
    assert {r.model_name for r in done.collect()} == {"forest", "ensemble"} and refused.first().reasons == ["altitude"]
    meta = P.run_metadata(out["crop_stages"], out["vt_stages"], "2024-01-01").first()
    assert sum(meta.source_distribution.values()) == meta.plot_count == 10


def test_bad_weather_stops_the_run(spark, tmp_path):
    t, tables = TestTables(spark, SF), jobs.Tables(str(tmp_path))
    bad = t.weather.withColumn("max_temp_c", F.col("max_temp_c") + 60)
    with pytest.raises(Q.QualityError):
        jobs.weather_to_stages(spark, tables, bad, t.plots, "2024-01-01")
    assert snapshots.list_days(spark, tables.path("validated_weather")) == []
    assert snapshots.list_days(spark, tables.path("raw_weather")) != []
    assert snapshots.list_days(spark, tables.path("staged_weather")) == []
    counted = spark.read.parquet(tables.path("profiles")).first()
    assert counted.table == "raw_weather" and counted.row_count == t.weather.count()


def test_profiles_are_counted_by_the_writes(spark, tmp_path):
    t, tables = TestTables(spark, SF), jobs.Tables(str(tmp_path))
    jobs.weather_to_stages(spark, tables, t.weather, t.plots, "2024-01-01")
    jobs.weather_to_stages(spark, tables, t.weather.where("plot_id < 5"), t.plots, "2024-01-02")
    rows = {(r.table, str(r.ds)): r for r in spark.read.parquet(tables.path("profiles")).collect()}
    assert {n for n, _ in rows} == {"raw_weather", "validated_weather", "planting_dates", "crop_stages", "vt_stages"}
    for at in ("2024-01-01", "2024-01-02"):
        for name in ("validated_weather", "crop_stages"):
            stored, row = snapshots.read_snapshot(spark, tables.path(name), at).drop("ds"), rows[name, at]
            want = Q.profile(stored, "date" if "date" in stored.columns else "planting_date").first()
            for c in ("row_count", "plot_count", "date_start", "date_end", "null_counts", "columns", "duplicate_count"):
                assert row[c] == want[c], (name, c)


def test_counts_of_repeated_and_missing_rows(spark, tmp_path):
    schema = "plot_id long, date date, max_temp_c double, min_temp_c double, precip_mm double"
    rows = [(1, day("2021-01-01"), 20.0, 10.0, 1.0)] * 3 + [(1, day("2021-01-01"), None, 10.0, 1.0), (1, None, 99.0, 10.0, 1.0), (1, None, 99.0, 10.0, None),
            (None, day("2021-01-02"), -60.0, 1.0, 0.0), (2, day("2021-01-01"), 20.0, 10.0, 1.0)]
    for n, data in enumerate((rows, [])):
        df = spark.createDataFrame(data, schema)
        df.write.parquet(str(tmp_path / f"in{n}"))
        df = spark.read.parquet(str(tmp_path / f"in{n}"))
        seen = snapshots.write_snapshot(Q.counted_days(df), str(tmp_path / f"out{n}"), "2024-01-01", metrics=Q.gate_metrics(df.columns))
        verdict, profile = Q.weather_verdict(df).first(), Q.profile(df).first()
        assert all(seen[c] == verdict[c] for c in verdict.asDict() if c != "passed")
        assert all(seen[c] == profile[c] for c in ("row_count", "plot_count", "date_start", "date_end", "duplicate_count"))
        if data:
            assert spark.read.parquet(str(tmp_path / f"out{n}")).columns == [*df.columns, "ds"]
            with pytest.raises(Q.QualityError):
                Q.check_gate(seen)


def test_plots_and_payloads_to_a_season_table(spark, tmp_path):
    t, tables = TestTables(spark, SF), jobs.Tables(str(tmp_path))
    plots, refused = jobs.plot_list(spark, tables, t.raw_plots, "2024-01-01")
    kept = plots.count()
    assert kept > 0 and plots.select("plot_id").distinct().count() == kept
    assert all(r.reasons for r in refused.collect())
    with pytest.raises(FileNotFoundError):
        jobs.season_table(spark, tables, t.harvest, t.plots, "2024-01-01")
    payloads_of(t).select(F.col("payload").alias("value")).union(spark.createDataFrame([("{cut",)], "value string")).write.text(str(tmp_path / "landing"))
    weather, rejects = jobs.payloads_to_weather(spark, tables, str(tmp_path / "landing"), "2024-01-01")
    assert weather.count() == t.weather.count() and [r.reasons for r in rejects.collect()] == [["document"]]
    jobs.weather_to_stages(spark, tables, weather.drop("ds"), t.plots, "2024-01-01")
    jobs.satellite_samples(spark, tables, t.pixels, "2024-01-01")
    table = jobs.season_table(spark, tables, t.harvest, t.plots, "2024-01-01")
    assert table.count() == 10 and table.where("`wet_harvest_kg/ha` is not null").count() > 0
    assert {"total_mean_ndvi", "precip_mm", "crop_type"} <= set(table.columns)
    names = {r.table for r in spark.read.parquet(tables.path("profiles")).collect()}
    assert {"plots", "rejected_plots", "rejected_weather", "validated_weather", "season_table"} <= names
