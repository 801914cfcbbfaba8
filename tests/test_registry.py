import threading

import pytest
from pyspark.sql import functions as F

from agrospark.catalog.base import Tables as TestTables
from agrospark.operators import drift as D
from agrospark.operators import models as M
from agrospark.plans import jobs
from agrospark.sources import registry as R
from agrospark.sources import snapshots

SF = "/root/testdata/sf0.001"


def view(spark, root):
    return {(r.name, r.version): r.stage for r in R.current_versions(spark, root).collect()}


def test_versions_and_stages(spark, tmp_path):
    root = str(tmp_path)
    assert view(spark, root) == {} and R.production(spark, root, "yield") is None
    assert [R.register(spark, root, n, f"run-{i}", f"/m/{i}", "2024-01-01") for i, n in enumerate(["yield", "yield", "other", "yield"])] == [1, 2, 1, 3]
    R.set_stage(spark, root, "yield", 1, "Production", "2024-01-01")
    R.set_stage(spark, root, "other", 1, "Production", "2024-01-01")
    R.set_stage(spark, root, "yield", 3, "Staging", "2024-01-02")
    R.set_stage(spark, root, "yield", 2, "Production", "2024-01-02")
    assert view(spark, root) == {("yield", 1): "Archived", ("yield", 2): "Production", ("yield", 3): "Staging", ("other", 1): "Production"}
    assert R.production(spark, root, "yield") == "/m/1"
    R.set_stage(spark, root, "yield", 1, "Production", "2024-01-03")  # back again
    assert view(spark, root)["yield", 1] == "Production" and view(spark, root)["yield", 2] == "Archived"
    for version, stage in ((9, "Production"), (1, "Live")):
        with pytest.raises(ValueError):
            R.set_stage(spark, root, "yield", version, stage, "2024-01-03")


def test_two_writers_at_once_get_two_numbers(spark, tmp_path):
    root, got = str(tmp_path), []

    def work(i):
        got.append(R.register(spark, root, "yield", f"run-{i}", "/m", "2024-01-01"))

    threads = [threading.Thread(target=work, args=(i,)) for i in range(12)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(got) == list(range(1, 13))
    rows = R.current_versions(spark, root).collect()
    assert len({r.run_id for r in rows}) == 12


def test_a_lost_writer_leaves_a_gap_only(spark, tmp_path):
    root = str(tmp_path)
    R.register(spark, root, "yield", "a", "/m", "2024-01-01")
    (tmp_path / "versions" / "yield" / "_claim-2").touch()
    assert R.register(spark, root, "yield", "b", "/m", "2024-01-01") == 3
    assert view(spark, root) == {("yield", 1): "None", ("yield", 3): "None"}


def test_training_run_publishes_what_it_has_trained(spark, tmp_path):
    t, tables = TestTables(spark, SF), jobs.Tables(str(tmp_path))
    numbers = ["precip_total", "gdd_sum", "plant_doy"]
    small = {"boosted": {"maxIter": [2, 3], "maxDepth": [2]}, "forest": {"numTrees": [3], "maxDepth": [2, 3]}}
    options = dict(learners=("boosted", "forest"), features=numbers, draws=2, folds=2, narrow=small, key="plot_id")
    assert jobs.training_run(spark, tables, "2024-01-01", **options) is None  # no labels yet
    jobs.store_labels(spark, tables, t.harvest, "2024-01-01")
    with pytest.raises(FileNotFoundError):
        jobs.training_run(spark, tables, "2024-01-01", **options)
    jobs.weather_to_stages(spark, tables, t.weather, t.plots, "2024-01-01")
    jobs.materialize_features(spark, tables, "2024-01-01")
    trained = jobs.training_run(spark, tables, "2024-01-01", **options)
    best = trained.metrics.where("model in ('boosted', 'forest')").orderBy("RMSE", "model").first()
    rows = R.current_versions(spark, tables.path("registry")).collect()
    assert [(r.version, r.stage, r.run_id) for r in rows] == [(1, "Production", f"{best.model}-2024-01-01")]
    model = M.load_model(R.production(spark, tables.path("registry"), "yield"))
    runs = spark.read.parquet(tables.path("model_runs"))
    assert {r.run_name for r in runs.collect()} >= {"boosted_RandomSearch", "forest_RandomSearch"}
    summary = spark.read.json(f"{tables.path('training_results')}/2024-01-01/training_summary").first()
    assert summary.total_models == trained.metrics.count()
    stored = spark.read.parquet(f"{tables.path('training_results')}/2024-01-01/predictions_comparison")
    assert stored.columns == trained.predictions.columns and stored.count() == trained.predictions.count()
    assert model.stages[-1].uid == trained.models[best.model].stages[-1].uid
    # A worse run becomes a version, not Production; a better one does.
    jobs.register_best(spark, tables, "yield", "worse", best.RMSE + 1, "2024-01-02")
    assert view(spark, tables.path("registry")) == {("yield", 1): "Production", ("yield", 2): "None"}
    jobs.register_best(spark, tables, "yield", "better", best.RMSE - 1, "2024-01-03")
    assert view(spark, tables.path("registry")) == {("yield", 1): "Archived", ("yield", 2): "None", ("yield", 3): "Production"}


def test_damaged_days_are_left_out_and_listed(spark, tmp_path):
    tables = jobs.Tables(str(tmp_path))
    root = tables.path("daily_features")
    rows = spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("gdd"), F.lit("VE").alias("stage"))
    for i in range(1, 6):
        snapshots.write_snapshot(rows.repartition(2), root, f"2024-01-0{i}")
    rows.where("id < 0").coalesce(1).write.mode("append").parquet(f"{root}/ds=2024-01-04")  # an empty file is sound
    parts = sorted((tmp_path / "daily_features" / "ds=2024-01-02").glob("*.parquet"))
    parts[1].write_bytes(parts[1].read_bytes()[:200])
    days = snapshots.last_days(spark, root, "2024-01-05")
    assert [(str(d), f.endswith(parts[1].name)) for d, f, _ in snapshots.damaged_files(spark, root, days)] == [("2024-01-02", True)]
    left = snapshots.read_last_n(spark, root, "2024-01-05", skip_unreadable=True)
    assert left.count() == 1200 and {str(r.ds) for r in left.select("ds").distinct().collect()} == {"2024-01-01", "2024-01-03", "2024-01-04"}
    report, summary = jobs.drift_check(spark, tables, "2024-01-05")
    assert summary.first().status == "ok" and report.where("psi > 1e-9").count() == 0
    listed = snapshots.read_snapshot(spark, tables.path("quarantine"), "2024-01-05").collect()
    assert [(str(r.damaged_day), bool(r.reason)) for r in listed] == [("2024-01-02", True)]
    assert D.choose_features(left.drop("ds"))[1] == ["stage"]
