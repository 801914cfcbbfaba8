import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from agrospark.operators.normalize import load_plots
from agrospark.sources import files, payload, snapshots
from tests.conftest import by, day


def table(spark, n, ds=None):
    df = spark.range(n).select(F.col("id").alias("plot_id"), (F.col("id") * 1.5).alias("x"))
    return df if ds is None else df.withColumn("ds", F.lit(day(ds)))


def test_snapshots_replace_one_day_only(spark, tmp_path):
    root = str(tmp_path / "t")
    assert snapshots.list_days(spark, root) == [] and snapshots.read_latest(spark, root) is None
    snapshots.write_snapshot(table(spark, 3), root, "2024-01-01")
    snapshots.write_snapshot(table(spark, 5), root, "2024-01-02", ["plot_id"])
    snapshots.write_snapshot(table(spark, 4), root, "2024-01-02")
    assert snapshots.list_days(spark, root) == [day("2024-01-01"), day("2024-01-02")]
    assert snapshots.read_snapshot(spark, root, "2024-01-01").count() == 3
    assert snapshots.read_latest(spark, root, "2030-01-01").count() == 4
    assert snapshots.read_latest(spark, root, "2024-01-01").count() == 3
    plan = snapshots.read_snapshot(spark, root, "2024-01-01")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan


def test_resolve_snapshot_on_a_dataframe(spark):
    df = table(spark, 2, "2024-01-01").unionByName(table(spark, 3, "2024-01-05"))
    assert snapshots.resolve_snapshot(df).count() == 3
    assert snapshots.resolve_snapshot(df, "2024-01-01").count() == 2
    assert snapshots.resolve_snapshot(df, "2024-01-03").count() == 3
    assert snapshots.resolve_snapshot(df.where("ds is null")).count() == 0


def test_resolve_weather_order(spark, tmp_path):
    v, r = str(tmp_path / "v"), str(tmp_path / "r")
    assert snapshots.read_first_weather(spark, v, r, "2024-01-02") is None
    snapshots.write_snapshot(table(spark, 1), r, "2024-01-01")
    snapshots.write_snapshot(table(spark, 2), r, "2024-01-02")
    pick = lambda d: snapshots.read_first_weather(spark, v, r, d).count()
    assert pick("2024-01-02") == 2 and pick("2024-01-09") == 2 and pick("2024-01-01") == 1
    snapshots.write_snapshot(table(spark, 3), v, "2023-12-01")
    assert pick("2024-01-02") == 2 and pick("2024-01-09") == 3 and pick("2023-12-01") == 3
    tiers = spark.createDataFrame([("raw", day("2024-01-02")), ("validated", day("2023-12-01"))], "tier string, ds date")
    assert tuple(snapshots.resolve_weather(tiers, "2024-01-02").first()) == ("raw", day("2024-01-02"))
    assert tuple(snapshots.resolve_weather(tiers, "2024-01-09").first()) == ("validated", day("2023-12-01"))


def test_union_last_n(spark, tmp_path):
    root = str(tmp_path / "t")
    days = [f"2024-01-{d:02d}" for d in (1, 2, 4, 5, 9)]
    for d in days:
        snapshots.write_snapshot(table(spark, 2), root, d)
    snapshots.write_snapshot(table(spark, 2).withColumn("extra", F.lit(1)), root, "2024-01-06")
    df = spark.read.parquet(root)
    got = {r.ds for r in snapshots.union_last_n(df, "2024-01-06", n=3).select("ds").distinct().collect()}
    assert got == {day("2024-01-05"), day("2024-01-04"), day("2024-01-02")}
    assert snapshots.union_last_n(df, n=30).select("ds").distinct().count() == 5
    stored = snapshots.read_last_n(spark, root, "2024-01-09", n=2)
    assert {r.ds for r in stored.collect()} == {day("2024-01-06"), day("2024-01-05")} and "extra" in stored.columns
    assert snapshots.read_last_n(spark, root, "2024-01-01") is None


def test_payload_flattening(spark, tmp_path):
    docs = [
        {"plot_id": 1, "latitude": -1.0, "longitude": 37.0, "days": [
            {"datetime": "2021-10-07", "tempmax": 28.5, "tempmin": 18.2, "temp": 23.35, "precip": 12.5, "unknown": 1},
            {"datetime": "not a day", "tempmax": 1.0}, {"datetime": "2021-10-08", "tempmax": 20.0, "precip": None}]},
        {"plot_id": 2, "days": []}, {"plot_id": 3}]
    path = tmp_path / "landing.txt"
    path.write_text("\n".join([json.dumps(d) for d in docs] + ["{broken"]))
    got = by(payload.flatten_weather_payload(payload.read_payloads(spark, str(path))), "plot_id", "date")
    assert set(got) == {(1, day("2021-10-07")), (1, day("2021-10-08"))}
    r = got[1, day("2021-10-07")]
    assert (r.max_temp_c, r.min_temp_c, r.mean_temp_c, r.precip_mm, r.humidity_pct) == (28.5, 18.2, 23.35, 12.5, None)


def test_what_cannot_be_read_is_told(spark, tmp_path):
    (tmp_path / "l.txt").write_text('{"plot_id": 1, "days": [{"datetime": "no day"}, {"datetime": "2021-10-07"}]}\n{broken\n{"plot_id": 2}')
    rows = payload.flatten_with_errors(payload.read_payloads(spark, str(tmp_path / "l.txt"))).collect()
    assert sorted((r.plot_id or 0, r.error or "", r.unread is not None) for r in rows) == [
        (0, "document", True), (1, "", False), (1, "date", True)]


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("plot_id, latitude,longitude\n1,-1.5,37.5\n")
    (tmp_path / "in" / "b.csv").write_text("longitude,plot_id,latitude,extra\n37.6,2,-1.6,x\n")
    (tmp_path / "in" / "_skip").write_text("nothing")
    got = by(files.read_text_table(spark, str(tmp_path / "in")), "plot_id")
    assert (got["1"].latitude, got["1"].longitude, got["1"].extra) == ("-1.5", "37.5", None)
    assert (got["2"].latitude, got["2"].longitude, got["2"].extra) == ("-1.6", "37.6", "x")


def test_csv_plots(spark, tmp_path):
    path = tmp_path / "plots.csv"
    path.write_text("plot_id,longitude,latitude,Altitude,planting_date,season\n"
                    "1,37.6,-0.49,1252.08,10/7/2021,Short Rains\n2,37.7,-0.5,,11/1/2021,Off Season\nx,1,1,1,1/1/2021,SR\n")
    raw = files.read_plots(spark, str(path))
    assert {f.dataType.simpleString() for f in raw.schema.fields} == {"string"}
    got = by(load_plots(raw), "plot_id")
    assert got[1].altitude == 1252.08 and got[2].altitude is None and got[2].season == "Short Rains" and got[2].year == 2021
    with pytest.raises(FileNotFoundError):
        files.read_plots(spark, str(tmp_path / "absent.csv"))


def test_harvest_and_label_resolution(spark, tmp_path):
    root = tmp_path / "harvest"
    (root / "2024-01-01").mkdir(parents=True)
    assert files.read_harvest(spark, str(root), "2024-01-01") is None
    local = str(tmp_path / "local.parquet")
    table(spark, 2).write.parquet(local)
    assert files.read_harvest(spark, str(root), "2024-01-01", local=[local]).count() == 2
    table(spark, 3).write.parquet(str(root / "2024-01-01" / "harvest.parquet"))
    assert files.read_harvest(spark, str(root), "2024-01-01", local=[local]).count() == 3
    (root / "2024-01-01" / "harvest.csv").write_text("plot_no\n1\n")
    assert files.read_harvest(spark, str(root), "2024-01-01").columns == ["plot_no"]
    labels = str(tmp_path / "labels")
    assert files.read_labels(spark, labels, "2024-01-01") is None
    assert files.read_labels(spark, labels, "2024-01-01", [local]).count() == 2
    assert not files.export_labels(spark, None, labels, "2024-01-01")
    ready = tmp_path / "ready.csv"
    ready.write_text("plot_no,planting_date\n7,10/7/2021\n")
    assert files.export_labels(spark, str(ready), labels, "2024-01-01")
    r = files.read_labels(spark, labels, "2024-05-01", [local]).first()
    assert r.plot_id == "7" and r.Planting_Date == day("2021-10-07")
    with pytest.raises(ValueError):
        files.read_table(spark, "x.xlsx")


def test_text_output(spark):
    df = spark.createDataFrame([(day("2021-10-07"), dt.datetime(2021, 10, 7, 5), float("nan"), 2.0)],
                               "d date, t timestamp_ntz, x double, y double")
    assert json.loads(files.to_json_rows(df).first()["json"]) == {"d": "2021-10-07", "t": "2021-10-07T05:00:00", "y": 2.0}


def test_training_results(spark, tmp_path):
    comparison = spark.createDataFrame([("a", 2.0, 1.0, 0.5), ("b", 1.0, 0.5, 0.9)], "model string, RMSE double, MAE double, R2 double")
    paths = files.write_training_results(str(tmp_path), "2024-01-01", comparison, comparison)
    assert spark.read.json(paths["summary"]).first()["best_model"] == "b"
    assert spark.read.option("header", True).csv(paths["comparison"]).first()["model"] == "b"
    assert spark.read.parquet(paths["predictions"]).count() == 2


def test_scratch_follows_the_session(spark):
    assert files.scratch_dir(spark, "x").startswith(spark.sparkContext.getCheckpointDir())
    stored = files.store(table(spark, 3), "x")
    assert stored.count() == 3 and stored.dtypes == table(spark, 3).dtypes


def test_csv_files_in_sub_folders_are_read(spark, tmp_path):
    for name, text in {"a.csv": "plot_id,x\n1,a\n", "more/b.csv": "x,plot_id\nb,2\n", "more/_hidden.csv": "plot_id,x\n3,c\n",
                       "_temporary/c.csv": "plot_id,x\n4,d\n", "more/empty.csv": ""}.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text(text)
    got = files.read_text_table(spark, str(tmp_path / "in")).collect()
    assert sorted((r.plot_id, r.x) for r in got) == [("1", "a"), ("2", "b")]
    assert files.read_text_table(spark, str(tmp_path / "in" / "a.csv")).count() == 1


def test_a_placed_day_is_rewritten_moved_and_read_by_other_means(spark, tmp_path):
    root, other = str(tmp_path / "it's"), str(tmp_path / "moved")
    rows = spark.range(100).select((F.col("id") % 7).alias("plot_id"), F.lit(1.5).alias("x"))
    for df in (rows, rows.limit(40)):
        assert snapshots.write_snapshot(df, root, "2024-01-01", ["plot_id"], {"n": F.count("*")}, 4) == {"n": df.count()}
        day = snapshots.read_snapshot(spark, root, "2024-01-01")
        assert day.count() == df.count() and day.columns == ["plot_id", "x", "ds"]
        assert "Exchange" not in day.groupBy("plot_id").count()._jdf.queryExecution().executedPlan().toString()
    assert snapshots.read_days(spark, root, snapshots.list_days(spark, root)).count() == 40
    snapshots.publish_snapshot(spark, root, other, "2024-01-01")
    moved = snapshots.read_snapshot(spark, other, "2024-01-01")
    assert moved.count() == 40 and "Exchange" not in moved.groupBy("plot_id").count()._jdf.queryExecution().executedPlan().toString()
    snapshots.write_snapshot(rows, other, "2024-01-01", ["plot_id"])  # no longer placed
    assert snapshots.read_snapshot(spark, other, "2024-01-01").count() == 100
    snapshots.write_snapshot(rows.limit(0), other, "2024-01-02", ["plot_id"], buckets=4)
    assert snapshots.read_snapshot(spark, other, "2024-01-02").count() == 0
    with pytest.raises(ValueError):
        snapshots.write_snapshot(rows, other, "2024-01-03", buckets=4)
