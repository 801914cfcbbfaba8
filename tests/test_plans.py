"""Physical plans: no nested loops, pushed filters, few shuffles."""

import re

import pytest
from pyspark.sql import functions as F

from agrospark import schemas as S
from agrospark.catalog import models
from agrospark.catalog.base import REGISTRY, Tables
from agrospark.operators import features as X
from agrospark.operators import indices as I
from agrospark.operators import phenology as P
from agrospark.plans import jobs
from agrospark.sources import snapshots
from tests.conftest import day

SF = "/root/testdata/sf0.001"
# Scoring and streaming queries run jobs while they are built; their plans are Spark ML's or end in a file.
NAMES = [n for n in REGISTRY if not n.startswith(("h2", "h3", "h4", "h5", "h6", "h7", "h11", "h12", "h_", "j3", "j4", "a15", "c4_staged", "c4_observed", "a12_stored"))]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_nested_loops_and_no_python_in_batch_plans(spark):
    for name in NAMES:
        plan = physical(REGISTRY[name].run(spark, SF))
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, name
        assert not re.search(r"EvalPython|FlatMapGroupsInPandas|MapInPandas|MapInArrow", plan), name


def test_fused_stage_plan_shuffles_once_per_key(spark):
    plan = physical(P.stage_dates_from_weather(Tables(spark, SF).weather, Tables(spark, SF).plots))
    assert plan.count("Exchange hashpartitioning") == 2  # (plot, day) of the daily table, then plot
    assert plan.count(": Scan") + plan.count("FileScan") <= 2


def test_planting_and_stages_read_the_weather_once(spark, tmp_path):
    t = Tables(spark, SF)
    t.weather.write.parquet(str(tmp_path / "weather"))
    t.plots.write.parquet(str(tmp_path / "plots"))
    weather, plots = (spark.read.parquet(str(tmp_path / n)) for n in ("weather", "plots"))
    both = P.planting_and_stages(weather, plots)
    assert len(re.findall(r"FileScan parquet \[[^\]]*precip_mm", physical(both))) == 1
    key = lambda rows: sorted(map(str, rows))
    assert key(both.drop("day").collect()) == key(P.stage_dates_from_weather(weather, plots).collect())
    assert key(P.planting_rows(both).collect()) == key(P.infer_planting_dates(weather, plots).collect())


def test_scans_prune_columns_and_push_filters(spark):
    t = Tables(spark, SF)
    plan = physical(P.with_daily_gdd(t.weather).select("plot_id", "date", "daily_gdd"))
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(re.findall(r"(\w+):", read)) == {"l_suppkey", "l_quantity", "l_discount", "l_shipdate"}
    stored = spark.read.parquet(f"{SF}/lineitem.parquet").withColumnsRenamed({"l_tax": "cloud_pct", "l_shipdate": "date"})
    scenes = physical(I.usable_scenes(stored))
    assert "PushedFilters: [IsNotNull(l_tax), LessThan(l_tax,60.0)]" in scenes


def test_window_match_shuffles_scenes_once(spark):
    t = Tables(spark, SF)
    stages = P.stage_dates_from_weather(t.weather, t.plots).cache()
    stages.count()
    plots = I.satellite_input(stages, P.vt_dates(stages))
    scenes = I.with_indices(I.with_bands(t.pixels)).select("plot_id", "date", "pixel_id", "ndvi")
    matched = I.match_samples(scenes, plots, place=True)
    grouped = physical(matched.groupBy(*I.PIXEL_KEY).count())
    assert len(re.findall(r"Exchange hashpartitioning\(plot_id#\d+L, pixel_id#\d+L", grouped)) == 1
    assert not re.search(r"Exchange hashpartitioning\([^)]*sample_date", grouped)
    stages.unpersist()


def test_scenes_are_placed_by_plot_once_for_medians_statistics_and_sums(spark):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")  # so few scenes would be broadcast
    scenes = spark.range(200).select(
        (F.col("id") % 5).alias("plot_id"), F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("date"),
        (F.col("id") % 3).alias("pixel_id"), *[F.rand(i).alias(c) for i, c in enumerate(S.INDICES)])
    plots = spark.createDataFrame([(i, day("2021-01-01"), day("2021-02-01")) for i in range(5)], "plot_id long, planting_date date, vt_date date")
    for images in (I.sampled_medians(scenes, plots), I.mean_image(I.match_samples(scenes, plots, by_plot=True))):
        plan = physical(I.with_cumulative_means(I.image_statistics(images)))
        assert len(re.findall(r"Exchange hashpartitioning\(plot_id#\d+L, \d+\), REPARTITION", plan)) == 1
        assert not re.search(r"Exchange hashpartitioning\(plot_id#\d+L, [a-z]", plan)
    spark.conf.set(limit, before)


def test_ensemble_members_read_one_stored_split(spark, monkeypatch):
    calls = []
    split = models.M.exact_split
    monkeypatch.setattr(models.M, "exact_split", lambda *a: calls.append(1) or split(*a))
    plan = physical(REGISTRY["h7_voting_ensemble"].run(spark, SF))
    assert len(calls) == 1 and "lineitem.parquet" not in plan


@pytest.mark.parametrize("name", ["g2_nearest_plot", "a10_lookup_asof", "i2_numeric_psi", "b6_derive_year", "b17_tidy_harvest_sheet"])
def test_single_partition_windows_run_over_block_summaries_only(spark, name):
    plan = physical(REGISTRY[name].run(spark, SF))
    for window in re.findall(r"Window \[.*", plan):
        partition = re.search(r"windowspecdefinition\(([^,]*)", window).group(1)
        if "ASC" in partition:  # no partition columns: ordered right away
            assert partition.startswith("_block"), window


def test_daily_features_place_stored_days_once(spark, tmp_path):
    t = Tables(spark, SF)
    stages = P.stage_dates_from_weather(t.weather, t.plots)
    stored = {}
    for name, df in (("weather", t.weather), ("stages", stages), ("samples", I.plot_indices(t.pixels, I.satellite_input(stages, P.vt_dates(stages))))):
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to broadcast
    try:
        plan = physical(X.daily_features(stored["weather"], stored["stages"], stored["stages"], stored["samples"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert exchanges and all(re.match(r"plot_id#\d+L, \d+$", e) for e in exchanges), exchanges
    assert len(exchanges) == 4  # days, samples and the two plot tables, each once


def test_season_summary_reads_and_places_the_weather_once(spark, tmp_path):
    t = Tables(spark, SF)
    t.weather.write.parquet(str(tmp_path / "weather"))
    t.plots.write.parquet(str(tmp_path / "plots"))
    weather, plots = (spark.read.parquet(str(tmp_path / n)) for n in ("weather", "plots"))
    got = P.season_summary_from_weather(weather, plots)
    plan = physical(got)
    assert len(re.findall(r"FileScan parquet \[[^\]]*precip_mm", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(plot_id", plan)) == 1
    planting = P.with_plot_metadata(P.infer_planting_dates(weather, plots), plots)
    want = P.season_summary(weather, P.latest_stage(P.long_form_stages(weather, planting)), planting)
    key = lambda df: sorted([round(v, 9) if isinstance(v, float) else v for v in r] for r in df.collect())
    assert key(got) == key(want)


def test_table_mode_joins_once(spark):
    plan = physical(REGISTRY["g6_merge_table_mode"].run(spark, SF))
    assert "Join" not in plan  # choosing and answering read the stored join


def test_as_of_answers_are_placed_by_key_and_day(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(REGISTRY["a10_lookup_asof"].run(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan.index("SortMergeJoin")
    placed = re.findall(r"Exchange hashpartitioning\(([^)]*\)?[^)]*)\)", plan[join:])
    assert sum(p.count(",") >= 2 for p in placed) >= 2, placed  # both sides by key and day


def test_bucketed_tables_need_no_shuffle(spark):
    t = Tables(spark, SF)
    snapshots.write_bucketed(t.weather, "weather_b", 4)
    snapshots.write_bucketed(P.with_plot_metadata(P.infer_planting_dates(t.weather, t.plots), t.plots), "planting_b", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stages = P.stage_dates(spark.table("weather_b"), spark.table("planting_b"))
        assert "Exchange" not in physical(stages)
        wanted = P.stage_dates_from_weather(t.weather, t.plots)
        assert sorted(map(str, stages.collect())) == sorted(map(str, wanted.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table weather_b")
        spark.sql("drop table planting_b")


def test_jobs_over_placed_tables_do_not_shuffle_weather_or_daily_rows(spark, tmp_path):
    t = Tables(spark, SF)
    placed, plain = jobs.Tables(str(tmp_path / "placed"), buckets=3), jobs.Tables(str(tmp_path / "plain"))
    key = lambda df: sorted(map(str, df.collect()))
    out = {}
    for tables in (placed, plain):
        jobs.weather_to_stages(spark, tables, t.weather, t.plots, "2024-01-01")
        jobs.satellite_samples(spark, tables, t.pixels, "2024-01-01")
        out[tables.root] = jobs.materialize_features(spark, tables, "2024-01-01")
    for name in ("daily_features", "plot_features"):
        assert key(out[placed.root][name]) == key(out[plain.root][name])
    weather, planting, stages, samples, daily = (
        snapshots.read_snapshot(spark, placed.path(n), "2024-01-01")
        for n in ("validated_weather", "planting_dates", "crop_stages", "satellite_indices", "daily_features"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in physical(X.daily_features(weather, planting, stages, samples, buckets=3))
        assert "Exchange" not in physical(X.plot_features(daily, stages))
        again = physical(P.planting_and_stages(weather.drop("ds"), t.plots))
        plots = re.findall(r"Exchange hashpartitioning\(plot_id#\d+L?, (\d+)\)", again)
        assert plots in ([], ["3"]), again  # at most the plot list, to where the weather is
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
