"""E: vegetation indices."""

from pyspark.sql import functions as F

from agrospark.catalog.base import IDX, Tables, query
from agrospark.catalog.phenology import stages_of
from agrospark.operators import indices as I
from agrospark.operators import phenology as P
from agrospark.sources import files

INDEX_SPEC = " ".join(f"{i}:f" for i in IDX)
STATS_SPEC = " ".join(f"{s}_{i}:f" for i in IDX for s in ("mean", "std", "min", "max"))


def stored_stages(t: Tables):
    """The stage table as the jobs keep it: one row per plot, stored once and used several times."""
    return files.store(stages_of(t), "crop_stages")


def inputs_of(t: Tables):
    stages = stored_stages(t)
    return I.satellite_input(stages, P.vt_dates(stages))


def scenes_of(t: Tables):
    return I.with_indices(I.with_bands(I.usable_scenes(t.pixels)))


def matched_of(t: Tables, by_plot: bool = False):
    return I.match_samples(scenes_of(t).select("plot_id", "date", "pixel_id", *IDX), inputs_of(t), by_plot=by_plot)


def medians_of(t: Tables):
    scenes = scenes_of(t).select("plot_id", "date", "pixel_id", *IDX)
    return I.sampled_medians(scenes, inputs_of(t), busy=I.busy_pixels(I.usable_scenes(t.pixels)))


@query("e1_bands", "plot_id:i date:d pixel_id:i blue:f green:f red:f red_edge:f nir:f swir:f", "select * from pixels", ("pixels",))
def _(t):
    return I.with_bands(t.pixels)


@query("e1_missing_band", "plot_id:i date:d pixel_id:i ndmi:f",
       "select plot_id, date, pixel_id, nir / nullif(nir, 0) as ndmi from pixels", ("pixels",))
def _(t):
    return I.with_indices(I.with_bands(t.pixels.drop("B11")))


@query("e2_vegetation_indices", f"plot_id:i date:d pixel_id:i {INDEX_SPEC}", "select * from indexed", ("indexed",))
def _(t):
    return scenes_of(t)


@query("e3_usable_scenes", "plot_id:i date:d pixel_id:i cloud_pct:f",
       "select * from pixels where cloud_pct < 60 and date >= date '1996-03-01' and date < date '1998-03-01'", ("pixels",))
def _(t):
    day = lambda d: F.lit(d).cast("date")
    return I.usable_scenes(t.pixels, day("1996-03-01"), day("1998-03-01"))


@query("e4_plot_footprint", "plot_id:i pixel_id:i distance_m:f4", """
select * from (select p.plot_id, x.pixel_id, 2 * 6371008.8::double * asin(sqrt(least(1.0, pow(sin(radians(p.latitude - x.latitude) / 2), 2)
 + cos(radians(x.latitude)) * cos(radians(p.latitude)) * pow(sin(radians(p.longitude - x.longitude) / 2), 2)))) as distance_m
 from plots p join pixel_points x on abs(p.latitude - x.latitude) < 0.01) where distance_m <= 40""", ("plots", "pixel_points"))
def _(t):
    return I.pixels_near_plots(t.pixel_points, t.plots)


@query("e5_sample_dates", "plot_id:i sample_no:i sample_date:d vt_date:d", "select * from samples", ("samples",))
def _(t):
    return I.sample_dates(inputs_of(t))


@query("e6_window_match", "plot_id:i date:d pixel_id:i sample_date:d", "select * from matched", ("matched",))
def _(t):
    return matched_of(t)


@query("e7_median_image", f"plot_id:i sample_date:d pixel_id:i {INDEX_SPEC}", "select * from median_image", ("median_image",))
def _(t):
    return medians_of(t)


@query("e8_spatial_statistics", f"plot_id:i sample_date:d {STATS_SPEC}", "select * from image_stats", ("image_stats",))
def _(t):
    return I.image_statistics(medians_of(t))


@query("e9_mean_image_statistics", f"plot_id:i sample_date:d {STATS_SPEC}",
       "select plot_id, sample_date, " + ", ".join(
           f"avg({i}) as mean_{i}, stddev_pop({i}) as std_{i}, min({i}) as min_{i}, max({i}) as max_{i}" for i in IDX)
       + " from (select plot_id, sample_date, pixel_id, " + ", ".join(f"avg({i}) as {i}" for i in IDX)
       + " from matched group by plot_id, sample_date, pixel_id) group by plot_id, sample_date", ("matched",))
def _(t):
    return I.image_statistics(I.mean_image(matched_of(t, by_plot=True)))


@query("e10_cumulative_means", "plot_id:i sample_date:d " + " ".join(f"cumulative_{i}:f" for i in IDX), "select * from sat", ("sat",))
def _(t):
    return I.with_cumulative_means(I.image_statistics(medians_of(t)))


@query("e11_satellite_input", "plot_id:i latitude:f longitude:f planting_date:d vt_date:d", """
select s.plot_id, latitude, longitude, s.planting_date, vt_stage_date as vt_date from stages s left join vt on vt.plot_id = s.plot_id
where latitude is not null and longitude is not null""", ("stages", "vt"))
def _(t):
    return inputs_of(t)


@query("e12_plot_indices", f"plot_id:i date:d sample_date_iso:s {STATS_SPEC} " + " ".join(f"cumulative_{i}:f" for i in IDX),
       "select *, sample_date as date, strftime(sample_date, '%Y-%m-%dT00:00:00') as sample_date_iso from sat", ("sat",))
def _(t):
    return I.plot_indices(t.pixels, inputs_of(t))


@query("e13_number_or_null", "event_id:i k:f", "select event_id, cast(json_extract_string(props, '$.k') as double) as k from events")
def _(t):
    nested = t.events.select("event_id", F.struct(F.get_json_object("props", "$.k").alias("value")).alias("reading"))
    return nested.withColumn("k", I.number_or_null(nested, "reading"))
