import numpy as np
import pytest
from pyspark.sql import functions as F

from agrospark import schemas as S
from agrospark.functions import columns as C
from agrospark.operators import indices as I
from tests.conftest import by, day


def test_bands_by_code_or_colour_and_missing_band(spark):
    df = spark.createDataFrame([(1, 0.1, 0.2, 0.3, 0.5)], ["plot_id", "B2", "green", "B4", "B8"])
    r = I.with_indices(I.with_bands(df)).first()
    assert (r.blue, r.green, r.red, r.nir, r.swir) == (0.1, 0.2, 0.3, 0.5, 0.0)
    assert r.ndvi == pytest.approx(0.25) and r.ndmi == pytest.approx(1.0)
    assert r.evi == pytest.approx(2.5 * 0.2 / (0.5 + 1.8 - 0.75 + 1)) and r.savi == pytest.approx(1.5 * 0.2 / 1.3)


def test_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(0.0,) * 6], list(S.BANDS))
    r = I.with_indices(I.with_bands(df)).first()
    assert r.ndvi is None and r.ndmi is None and r.evi == 0.0


def plots(spark, vt):
    return spark.createDataFrame([(1, -1.0, 37.0, day("2021-10-01"), day(vt))],
                                 "plot_id long, latitude double, longitude double, planting_date date, vt_date date")


@pytest.mark.parametrize("vt, last", [("2021-10-11", "2021-10-11"), ("2021-10-14", "2021-10-11"), (None, "2021-11-30"),
                                      ("2021-09-01", "2021-11-30"), ("2021-10-01", "2021-10-01")])
def test_sample_dates(spark, vt, last):
    got = [r.sample_date for r in I.sample_dates(plots(spark, vt)).orderBy("sample_no").collect()]
    assert got[0] == day("2021-10-01") and got[-1] == day(last)


def scenes(spark, rows):
    """(date, pixel, value): every index takes the value."""
    df = spark.createDataFrame([(1, day(d), p, v) for d, p, v in rows], "plot_id long, date date, pixel_id long, v double")
    return df.select("plot_id", "date", "pixel_id", *[F.col("v").alias(i) for i in S.INDICES])


def test_window_start_is_in_and_end_is_out(spark):
    got = I.match_samples(scenes(spark, [("2021-09-21", 1, 0.1), ("2021-09-20", 1, 0.2), ("2021-10-11", 1, 0.3), ("2021-10-10", 1, 0.4)]),
                          plots(spark, "2021-10-01"))
    assert sorted(r.ndvi for r in got.collect()) == [0.1, 0.4]


def test_match_equals_plain_range_join(spark):
    px = scenes(spark, [(f"2021-{m:02d}-{d:02d}", d % 3, d * 0.1 + m) for m in (9, 10, 11, 12) for d in range(1, 29, 2)])
    for step, window in ((5, 10), (7, 10), (3, 4)):
        samples = I.sample_dates(plots(spark, "2021-11-20"), step)
        near = (F.col("date") >= F.date_sub("sample_date", window)) & (F.col("date") < F.date_add("sample_date", window))
        wanted = px.join(samples.select("plot_id", "sample_date"), "plot_id").where(near)
        got = I.match_samples(px, plots(spark, "2021-11-20"), window, step)
        cols = ["plot_id", "sample_date", "date", "pixel_id"]
        assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, wanted.select(cols).collect()))


def test_median_of_even_and_odd_counts_with_gaps(spark):
    rows = [("2021-10-01", 1, v) for v in (1.0, 9.0, 4.0, 2.0)] + [("2021-10-01", 2, v) for v in (5.0, None, 1.0, 3.0)] + [("2021-10-01", 3, None)]
    m = I.match_samples(scenes(spark, rows), plots(spark, "2021-10-01"))
    assert {k: r.ndvi for k, r in by(I.median_image(m), "pixel_id").items()} == {1: 3.0, 2: 3.0, 3: None}


def test_busy_pixels_take_the_ranked_path_with_equal_results(spark):
    rows = [("2021-10-01", 1, (k * 7919 % 1000) / 10.0) for k in range(999)] + [("2021-10-02", 2, float(k)) for k in range(6)]
    px = scenes(spark, rows)
    assert I.busy_pixels(px) is None
    busy = I.busy_pixels(px, limit=600)
    assert [tuple(r) for r in busy.collect()] == [(1, 1)]
    where = plots(spark, "2021-10-11")
    plain, split = (sorted(map(str, I.sampled_medians(px, where, busy=b).collect())) for b in (None, busy))
    assert plain == split


def test_statistics_are_population_and_sums_skip_missing(spark):
    image = spark.createDataFrame(
        [(1, day("2021-10-01"), 1, 1.0), (1, day("2021-10-01"), 2, 3.0), (1, day("2021-10-06"), 1, None), (1, day("2021-10-11"), 1, 4.0)],
        "plot_id long, sample_date date, pixel_id long, v double").select("plot_id", "sample_date", "pixel_id", *[F.col("v").alias(i) for i in S.INDICES])
    got = by(I.with_cumulative_means(I.image_statistics(image)), "sample_date")
    first = got[day("2021-10-01")]
    assert (first.mean_ndvi, first.std_ndvi, first.min_ndvi, first.max_ndvi) == (2.0, 1.0, 1.0, 3.0)
    assert [got[day(d)].cumulative_evi for d in ("2021-10-01", "2021-10-06", "2021-10-11")] == [2.0, 2.0, 6.0]


def test_footprint_matches_brute_force_also_at_the_date_line_and_high_latitude(spark):
    rng = np.random.default_rng(3)
    centres = [(1, -1.0, 37.0), (2, 65.0, 20.0), (3, 0.0, 180.0), (4, -0.00001, -179.99999), (5, -1.0003, 37.0)]
    pixels, n = [], 0
    for _, lat, lon in centres:
        for _ in range(60):
            n += 1
            x = lon + rng.uniform(-0.001, 0.001) / np.cos(np.radians(lat))
            pixels.append((n, float(lat + rng.uniform(-0.0006, 0.0006)), float((x + 180) % 360 - 180)))
    px = spark.createDataFrame(pixels, "pixel_id long, latitude double, longitude double")
    pl = spark.createDataFrame(centres, "plot_id long, latitude double, longitude double")
    got = {(r.plot_id, r.pixel_id) for r in I.pixels_near_plots(px, pl).collect()}
    d = C.haversine_m(F.col("a.latitude"), F.col("a.longitude"), F.col("b.latitude"), F.col("b.longitude"))
    all_pairs = px.alias("a").crossJoin(pl.alias("b")).where(d <= 40)
    wanted = {(r.plot_id, r.pixel_id) for r in all_pairs.select("plot_id", "pixel_id").collect()}
    assert got == wanted and len(wanted) > 50


def test_chain_drops_samples_without_scenes(spark):
    px = spark.createDataFrame([(1, day("2021-10-02"), 1, 10.0, 0.3, 0.6), (1, day("2021-10-02"), 2, 90.0, 0.3, 0.9)],
                               "plot_id long, date date, pixel_id long, cloud_pct double, B4 double, B8 double")
    got = I.plot_indices(px, plots(spark, "2021-11-30")).orderBy("date").collect()
    assert [r.date for r in got] == [day("2021-10-01"), day("2021-10-06"), day("2021-10-11")]
    assert got[2].cumulative_ndvi == pytest.approx(1.0) and got[0].sample_date_iso == "2021-10-01T00:00:00"


def test_number_or_null(spark):
    df = spark.createDataFrame([(("3.5",), "x")], "a struct<value: string>, b string")
    assert tuple(df.select(I.number_or_null(df, "a"), I.number_or_null(df, "b")).first()) == (3.5, None)
