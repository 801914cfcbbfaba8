import json
import pathlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from agrospark import schemas as S
from agrospark.catalog import streaming as catalog
from agrospark.catalog.base import Tables
from agrospark.catalog.sources import documents_of, payloads_of
from agrospark.operators import phenology as P
from agrospark.streaming import intake, metrics, stages
from tests.conftest import by, day


def test_streamed_metrics_equal_batch(spark, tmp_path):
    rows = spark.range(500).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 977).alias("ts"),
        F.concat(F.lit("/e"), F.col("id") % 3).alias("endpoint"), (F.lit(200) + F.col("id") % 2 * 300).cast("int").alias("status"),
        (F.col("id") % 60 / 10).alias("latency_s"), F.lit("m").alias("model"), F.col("id").cast("double").alias("prediction"))
    rows.coalesce(3).write.parquet(str(tmp_path / "in"))
    for name, job in (("c", metrics.request_counts), ("l", metrics.latency_histogram), ("p", metrics.prediction_log)):
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        q = job(stream, "1 day", watermark="30 days").writeStream.outputMode("complete").format("memory").queryName(f"out_{name}") \
            .trigger(availableNow=True).start()
        q.awaitTermination()
        got = sorted(map(str, spark.table(f"out_{name}").collect()))
        assert got == sorted(map(str, job(rows, "1 day").collect())) and got


def test_bucket_limits_are_inclusive(spark):
    df = spark.createDataFrame([(0.05,), (0.0501,), (5.0,), (9.0,)], "latency_s double").withColumn("ts", F.lit("2021-01-01").cast("timestamp"))
    r = metrics.latency_histogram(df).first()
    assert (r.le_0_05, r.le_0_1, r.le_5, r.le_inf) == (1, 2, 3, 4)


def doc(plot, days):
    return json.dumps({"plot_id": plot, "latitude": -1.0, "longitude": 37.0, "days": [
        {"datetime": d, "tempmax": hi, "tempmin": 10.0, "temp": 15.0} for d, hi in days]})


def test_intake_drops_repeats_and_sets_rejects_aside(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.txt").write_text(doc(1, [("2021-10-01", 20.0), ("2021-10-02", 99.0)]))
    out = {n: str(tmp_path / n) for n in ("weather", "rejects", "state")}

    def run():
        intake.start_intake(intake.payload_stream(spark, str(landing), 1), out["weather"], out["rejects"], out["state"]).awaitTermination()

    run()
    (landing / "2.txt").write_text(doc(1, [("2021-10-01", 20.0), ("2021-10-03", 21.0)]))
    run()  # goes on from the stored state: the repeated day is not delivered again
    good = spark.read.parquet(out["weather"])
    assert sorted(r.date for r in good.collect()) == [day("2021-10-01"), day("2021-10-03")]
    bad = spark.read.parquet(out["rejects"]).collect()
    assert [(r.date, r.reasons) for r in bad] == [(day("2021-10-02"), ["max_temp_c"])]


def test_a_bad_first_delivery_does_not_hide_the_corrected_day(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    texts = [doc(1, [("2021-10-01", 99.0)]), doc(1, [("2021-10-01", 20.0)]), "{broken", doc(2, [("no date", 20.0)])]
    for i, text in enumerate(texts):
        (landing / f"{i}.txt").write_text(text)
    batch = intake.weather_days(spark.read.text(str(landing)).withColumnRenamed("value", "payload")).collect()
    out = {n: str(tmp_path / n) for n in ("weather", "rejects", "state")}
    intake.start_intake(intake.payload_stream(spark, str(landing), 1), out["weather"], out["rejects"], out["state"]).awaitTermination()
    good, bad = spark.read.parquet(out["weather"]).collect(), spark.read.parquet(out["rejects"]).collect()
    assert [(r.plot_id, r.max_temp_c) for r in good] == [(1, 20.0)]
    assert sorted(r.reasons[0] for r in bad) == ["date", "document", "max_temp_c"]
    assert sorted(",".join(r.reasons) for r in batch) == ["", "date", "document", "max_temp_c"]


def season(plot, first, n=120, hi=20.0):
    return doc(plot, [(str((pd.Timestamp(first) + pd.Timedelta(days=i)).date()), hi) for i in range(n)])


def test_a_plot_keeps_its_season_whatever_others_have_delivered(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    out = {n: str(tmp_path / n) for n in ("weather", "rejects", "state")}

    def deliver(name, *texts, **options):
        (landing / name).write_text("\n".join(texts))
        intake.start_intake(intake.payload_stream(spark, str(landing), 1), out["weather"], out["rejects"], out["state"], **options).awaitTermination()

    def stored():
        return spark.read.parquet(out["weather"]).count(), sorted(
            (r.plot_id, str(r.date), r.reasons[0]) for r in spark.read.parquet(out["rejects"]).collect())

    deliver("1.txt", season(1, "2021-10-01"))
    deliver("2.txt", season(2, "2023-10-01"))
    deliver("3.txt", season(3, "2021-03-01"))  # two years behind plot 2
    assert stored() == (360, [])
    # Again, with one day more; then a day far behind the plot's own newest one.
    deliver("4.txt", season(3, "2021-03-01", 121), season(2, "2023-09-30"))
    assert stored() == (362, [])
    deliver("5.txt", doc(2, [("2020-01-01", 20.0)]), doc(1, [("2020-01-01", 20.0)]))
    assert stored() == (363, [(2, "2020-01-01", "late")])


def test_a_plot_that_has_gone_quiet_is_closed(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    out = {n: str(tmp_path / n) for n in ("weather", "rejects", "state")}
    for i, days in enumerate((3, 3, 5)):  # no idle time at all: the timer ends before the next file
        (landing / f"{i}.txt").write_text(season(1, "2021-10-01", days))
        intake.start_intake(intake.payload_stream(spark, str(landing), 1), out["weather"], out["rejects"], out["state"], idle=0).awaitTermination()
    assert sorted(r.date.day for r in spark.read.parquet(out["weather"]).collect()) == [1, 2, 3, 4, 5]
    late = spark.read.parquet(out["rejects"])
    assert late.count() == 6 and {tuple(r.reasons) for r in late.collect()} == {("late",)}


def weather_rows(plots, n, hi=25.0):
    frame = pd.DataFrame([(p, d.date(), hi + p, 15.0, 0.0) for p in plots for d in pd.date_range("2021-01-01", periods=n)],
                         columns=["plot_id", "date", "max_temp_c", "min_temp_c", "precip_mm"])
    return frame, "plot_id long, date date, max_temp_c double, min_temp_c double, precip_mm double"


PLOTS = "plot_id long, altitude double, season string, planting_date date"


def test_shuffled_days_settle_on_the_batch_answer(spark, tmp_path):
    frame, schema = weather_rows((1, 2, 3), 230)
    everything = spark.createDataFrame(frame, schema)
    plots = spark.createDataFrame([(1, 1300.0, "a", day("2021-01-05")), (2, 900.0, "b", day("2021-01-02")), (3, None, "c", None)], PLOTS)
    folder, events = str(tmp_path / "days"), str(tmp_path / "events")
    parts = [g for _, g in frame.sample(frac=1, random_state=4).groupby(lambda i: i % 4)]
    progress = []
    for part in [*parts, parts[0]]:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        q = stages.start_stages(spark.readStream.schema(schema).parquet(folder), plots, events, str(tmp_path / "state"))
        q.awaitTermination()
        progress += [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    got = {k: r.stage_date for k, r in by(stages.settled_stages(spark.read.parquet(events)), "plot_id", "stage").items()}
    batch = by(P.stage_dates(everything, plots), "plot_id")
    want = {(p, s): batch[p][s] for p in (1, 2) for s in S.STAGES if batch[p][s] is not None}
    assert got == want and (1, "R6") in want
    assert max(progress) > 0


def test_state_falls_to_nothing_after_the_season(spark, tmp_path):
    frame, schema = weather_rows((1,), 230)
    plots = spark.createDataFrame([(1, 1300.0, "a", day("2021-01-01"))], PLOTS)
    folder, events, total = str(tmp_path / "days"), str(tmp_path / "events"), []
    for part in (frame[:100], frame[100:], frame[:0], frame[:0], frame[:0]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        q = stages.start_stages(spark.readStream.schema(schema).parquet(folder), plots, events, str(tmp_path / "state"), grace=0, idle=400, remember=1e-8)
        q.awaitTermination()
        total += [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert max(total) > 0 and total[-1] == 0
    assert (1, "R6") in by(stages.settled_stages(spark.read.parquet(events)), "plot_id", "stage")


def test_days_after_the_end_of_a_season_begin_no_other(spark, tmp_path):
    frame, schema = weather_rows((1,), 230)
    plots = spark.createDataFrame([(1, 1300.0, "a", day("2021-01-01"))], PLOTS)
    folder, events = str(tmp_path / "days"), str(tmp_path / "events")
    for part in (frame, frame[50:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        stages.start_stages(spark.readStream.schema(schema).parquet(folder), plots, events, str(tmp_path / "state"), grace=0).awaitTermination()
    assert spark.read.parquet(events).count() == len(S.STAGES)


def test_a_day_that_comes_complete_later_moves_the_stage(spark, tmp_path):
    frame, schema = weather_rows((1,), 40)
    plots = spark.createDataFrame([(1, 1300.0, "a", day("2021-01-01"))], PLOTS)
    hole = frame.copy()
    hole.loc[2:6, "max_temp_c"] = None
    folder, events = str(tmp_path / "days"), str(tmp_path / "events")
    found = []
    for part in (hole, frame[2:7], hole):
        spark.createDataFrame(part.astype(object).where(part.notna(), None), schema).coalesce(1).write.mode("append").parquet(folder)
        stages.start_stages(spark.readStream.schema(schema).parquet(folder), plots, events, str(tmp_path / "state")).awaitTermination()
        found.append({k[1]: r.stage_date for k, r in by(stages.settled_stages(spark.read.parquet(events)), "plot_id", "stage").items()})
    want = P.stage_dates(spark.createDataFrame(frame, schema), plots).first()
    assert found[1] == found[2] == {s: want[s] for s in S.STAGES if want[s] is not None}
    assert found[0]["VE"] > found[1]["VE"]


def state_rows(query):
    query.awaitTermination()
    return query.recentProgress[-1].stateOperators[0].numRowsTotal


def test_what_a_plot_has_in_state_is_one_value_however_many_months_it_spans(spark, tmp_path):
    intake_rows, stage_rows = [], []
    for n in (20, 200):
        base = tmp_path / str(n)
        (base / "landing").mkdir(parents=True)
        (base / "landing" / "1.txt").write_text(season(1, "2021-10-01", n))
        intake_rows.append(state_rows(intake.start_intake(intake.payload_stream(spark, str(base / "landing"), 1), *(str(base / p) for p in ("w", "r", "s1")))))
        frame, schema = weather_rows((1,), n, hi=11.0)
        spark.createDataFrame(frame, schema).coalesce(1).write.parquet(str(base / "days"))
        plots = spark.createDataFrame([(1, 1300.0, "a", day("2021-01-01"))], PLOTS)
        stage_rows.append(state_rows(stages.start_stages(spark.readStream.schema(schema).parquet(str(base / "days")), plots, str(base / "e"), str(base / "s2"))))
    assert intake_rows[0] == intake_rows[1] and stage_rows[0] == stage_rows[1]


def test_far_days_of_one_delivery_are_known_afterwards():
    held = []
    keeper = intake.KnownDays(["day"], 100, 400)
    keeper.known = type("Value", (), {"update": lambda self, v: held.append(v)})()
    assert keeper._enter(np.array([5, 300, 250, 299]), None).all()
    assert held[-1][:3] == (300, 200, 250)
    assert keeper._enter(np.array([299, 298, 301, 250]), held[-1]).tolist() == [False, True, True, False]
    assert held[-1][:3] == (301, 201, 250)


def test_a_row_comes_back_from_its_text_as_it_was(spark):
    rows = spark.createDataFrame(
        [(1, day("2021-10-01"), 0.1 + 0.2, float("inf"), [], None), (None, None, None, -0.0, ["date", "max_temp_c"], 'a "b"\n\u00e9\U0001f33d'),
         (2**62, day("0001-01-01"), 1e-300, float("nan"), ["late"], "")],
        "plot_id long, date date, a double, `b.c` double, reasons array<string>, unread string")
    text = rows.select(F.lit(7).alias("kept"), intake.packed(rows).alias("row"))
    got = intake.unpacked(text, rows.schema)
    assert got.columns == ["kept", *rows.columns] and got.drop("kept").dtypes == rows.dtypes
    assert sorted(map(str, got.drop("kept").collect())) == sorted(map(str, rows.collect()))


class Kept:
    """What a processor asks of Spark for one plot: its value, its timers and the time."""

    def __init__(self, keeper):
        self.value, self.timers, self.now = None, [], 1
        keeper.known, keeper.handle = self, self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def registerTimer(self, at):
        self.timers.append(at)

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_a_delivery_leaves_the_timer_and_what_was_seen_sets_the_next():
    keeper = intake.KnownDays(["plot_id", "date", "x"], 100, 1)
    kept, whole_day = Kept(keeper), 86_400_000

    def deliver(now, *days):
        kept.now = now
        chunks = keeper.handleInputRows(("1", 0), iter([pd.DataFrame({"day": days, "row": [json.dumps({"2": d}) for d in days]})]), kept)
        return [(json.loads(r)["2"], late) for c in chunks for r, late in zip(c["row"], c["late"])]

    assert deliver(5, 10, 11) == [(10, False), (11, False)]
    assert deliver(9, 11, 10, 12) == [(12, False)] and deliver(10, 12) == []
    assert kept.timers == [5 + whole_day]  # repeats count as something that came, and cost no timer
    kept.now = 5 + whole_day
    list(keeper.handleExpiredTimer(("1", 0), kept, None))
    assert kept.timers[1:] == [10 + whole_day] and deliver(kept.now, 13) == [(13, False)]
    kept.now += whole_day
    list(keeper.handleExpiredTimer(("1", 0), kept, None))
    assert len(kept.timers) == 2 and deliver(kept.now, 13, 14) == [(13, True), (14, False)]
    assert len(kept.timers) == 3


def test_of_several_deliveries_the_least_counts_missing_values_last():
    keeper = intake.KnownDays(["plot_id", "date", "x", "y", "reasons", "unread"], 100, 400)
    Kept(keeper)
    texts = [{"2": 3.5}, {"2": 3.5, "3": "Infinity"}, {"2": 3.5, "3": 10.0}, {"2": 3.5, "3": 9.0, "4": []}, {"3": 1.0}, {"2": "NaN", "3": 0.5}]
    chunks = [pd.DataFrame({"day": [1] * 3, "row": [json.dumps(t) for t in part]}) for part in (texts[:3], texts[3:])]
    told = pd.concat(keeper.handleInputRows(("1", 0), iter(chunks), keeper.known))
    assert [json.loads(r) for r in told["row"]] == [{"2": 3.5, "3": 9.0, "4": []}]


@pytest.fixture
def weather_of_lines(spark, tmp_path):
    lines = pd.DataFrame([
        (plot, d, 1 + i % 50, 0.05, 0.01 * (i % 8), 1000.0 + i, i % 200, 1 + i % 7, i)
        for plot in range(5) for i, d in enumerate(pd.date_range("1995-01-01", periods=150))],
        columns=["l_suppkey", "l_shipdate", "l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_partkey", "l_linenumber", "l_orderkey"])
    spark.createDataFrame(lines).write.parquet(str(tmp_path / "tables" / "lineitem.parquet"))
    return Tables(spark, str(tmp_path / "tables"))


def landed(base):
    """The folder of a run, and the bytes in it that have landed."""
    folder = pathlib.Path(base.removeprefix("file:"))
    sizes = [f.stat().st_size for f in (folder / "landing").glob("part-*")]
    assert sizes
    return folder, sum(sizes)


def test_seasons_in_turn_land_in_less_than_their_text(spark, weather_of_lines):
    text = payloads_of(weather_of_lines).agg(F.sum(F.length("payload"))).first()[0]
    base, size = landed(catalog.run_in_turn(weather_of_lines))
    assert size < text / 2  # all documents twice, and a day of 1980 for some
    assert spark.read.parquet(str(base / "weather")).count() == 750
    late = spark.read.parquet(str(base / "rejects"))
    assert {(r.plot_id, str(r.date), *r.reasons) for r in late.collect()} == {(4, "1980-01-01", "late")}


def test_landed_documents_are_compressed(spark, weather_of_lines):
    text = payloads_of(weather_of_lines).agg(F.sum(F.length("payload"))).first()[0]
    base, size = landed(catalog.run_intake(weather_of_lines))
    assert size < text / 2  # all documents, and those of a third of the plots twice more
    assert spark.read.parquet(str(base / "weather")).count() == 750
    reasons = spark.read.parquet(str(base / "rejects")).groupBy(F.concat_ws(",", "reasons")).count()
    assert {tuple(r) for r in reasons.collect()} == {("max_temp_c", 150), ("document", 1)}


def test_documents_of_days_that_lie_in_place_are_not_shuffled_again(weather_of_lines):
    days = weather_of_lines.weather.withColumn("place", F.year("date") * 100_000 + F.col("plot_id") % 1000)
    placed = documents_of(days.repartitionByRange(3, F.desc("place")), "place")
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and plan.count("rangepartitioning") == 1  # the days, and their places
    assert {r.payload for r in placed.collect()} == {r.payload for r in payloads_of(weather_of_lines).collect()}
