"""Dated tables: one partition `ds` per run day, resolved without touching the data.

A day may be placed: its rows lie in buckets of some columns, each sorted. A file beside them says so, so every
session that reads the day joins and aggregates by these columns without a shuffle.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

DAY = "ds"
PLACEMENT = "_placement"  # Spark passes over files that begin with an underscore
HELPER = "_count_"  # columns that only the metrics of a write need; they are not written


def _as_date(day: str | dt.date) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def list_days(spark: SparkSession, root: str) -> list[dt.date]:
    """Days that have a partition folder under `root`; a folder listing, no file is opened."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    days = []
    for entry in files.listStatus(path):
        name = entry.getPath().getName()
        if entry.isDirectory() and name.startswith(f"{DAY}="):
            try:
                days.append(dt.date.fromisoformat(name.split("=", 1)[1]))
            except ValueError:
                continue
    return sorted(days)


def read_snapshot(spark: SparkSession, root: str, day: str | dt.date) -> DataFrame:
    """One day of a dated table, as it is placed if it is; else the equality prunes every other partition."""
    files, folder = _folder(spark, root, day)
    marker = _child(spark, folder, PLACEMENT)
    if files.exists(marker):
        return _read_placed(spark, folder, json.loads(_read_text(spark, files, marker))).withColumn(DAY, F.lit(_as_date(day)))
    return spark.read.parquet(root).where(F.col(DAY) == F.lit(_as_date(day)))


def pick_day(days: Iterable[dt.date], day: str | dt.date | None) -> dt.date | None:
    """The asked-for day, else the newest, else None."""
    days = list(days)
    if day is not None and _as_date(day) in days:
        return _as_date(day)
    return max(days, default=None)


def read_latest(spark: SparkSession, root: str, day: str | dt.date | None = None) -> DataFrame | None:
    """The asked-for snapshot, else the newest one, else None when there is none at all."""
    chosen = pick_day(list_days(spark, root), day)
    return None if chosen is None else read_snapshot(spark, root, chosen)


def resolve_snapshot(df: DataFrame, day: str | dt.date | None = None) -> DataFrame:
    """The same rule over a DataFrame with a `ds` column, as a one-row scalar subquery."""
    newest = F.max(DAY)
    if day is not None:
        wanted = F.lit(_as_date(day))
        newest = F.coalesce(F.max(F.when(F.col(DAY) == wanted, F.col(DAY))), newest)
    return df.where(F.col(DAY) == df.select(DAY).agg(newest).scalar())


def read_first_weather(
    spark: SparkSession, validated_root: str, raw_root: str, day: str | dt.date
) -> DataFrame | None:
    """Validated day, raw day, newest validated, newest raw: the first that exists."""
    validated, raw = list_days(spark, validated_root), list_days(spark, raw_root)
    day = _as_date(day)
    if day in validated:
        return read_snapshot(spark, validated_root, day)
    if day in raw:
        return read_snapshot(spark, raw_root, day)
    for root, days in ((validated_root, validated), (raw_root, raw)):
        if days:
            return read_snapshot(spark, root, days[-1])
    return None


def resolve_weather(tiers: DataFrame, day: str | dt.date) -> DataFrame:
    """The winning (tier, ds) among candidates with columns `tier` ('validated' or 'raw') and `ds`."""
    wanted = F.col(DAY) == F.lit(_as_date(day))
    rank = F.struct(
        F.when(wanted, 0).otherwise(1).alias("not_wanted"),
        F.when(F.col("tier") == "validated", 0).otherwise(1).alias("not_validated"),
        F.datediff(F.lit(_as_date(day)), F.col(DAY)).alias("age"),
    )
    return tiers.agg(F.min_by(F.struct("tier", DAY), rank).alias("best")).select("best.tier", f"best.{DAY}")


def union_last_n(
    df: DataFrame, day: str | dt.date | None = None, n: int = 30, gap_days: int = 1
) -> DataFrame:
    """Rows of the newest `n` days that lie at least `gap_days` before `day` (default: newest day)."""
    days = df.select(DAY).distinct()
    limit = F.lit(_as_date(day)) if day is not None else days.agg(F.max(DAY)).scalar()
    # At most n rows, so the broadcast is bounded; it also prunes partitions at run time.
    kept = days.where(F.col(DAY) <= F.date_sub(limit, gap_days)).orderBy(F.desc(DAY)).limit(n)
    return df.join(F.broadcast(kept), DAY, "left_semi")


def last_days(
    spark: SparkSession, root: str, day: str | dt.date, n: int = 30, gap_days: int = 1
) -> list[dt.date]:
    """The newest `n` stored days that lie at least `gap_days` before `day`."""
    limit = _as_date(day) - dt.timedelta(days=gap_days)
    return [d for d in list_days(spark, root) if d <= limit][-n:]


def read_last_n(
    spark: SparkSession, root: str, day: str | dt.date, n: int = 30, gap_days: int = 1,
    skip_unreadable: bool = False,
) -> DataFrame | None:
    """`union_last_n` on a stored table: the days come from the folder listing.

    `skip_unreadable` leaves out days with a file that cannot be opened (`damaged_files` tells which), instead of
    failing; a part of a day is never read.
    """
    days = last_days(spark, root, day, n, gap_days)
    if skip_unreadable:
        bad = {d for d, _, _ in damaged_files(spark, root, days)}
        days = [d for d in days if d not in bad]
    return read_days(spark, root, days)


def read_days(spark: SparkSession, root: str, days: Sequence[dt.date]) -> DataFrame | None:
    if not days:
        return None
    # Only the folders of these days are listed and only their footers opened to merge the schema.
    return spark.read.option("mergeSchema", True).option("basePath", root).parquet(
        *[f"{root.rstrip('/')}/{DAY}={d}" for d in days])


def damaged_files(spark: SparkSession, root: str, days: Sequence[dt.date]) -> list[tuple[dt.date, str, str]]:
    """(day, file, reason) of the first file of each day that cannot be opened.

    A job over all files reads their footers only and passes over those that cannot be read. Files that gave no row
    are opened one by one, until a day has a damaged one: they may be empty, which is no damage.
    """
    if not days:
        return []
    paths = [f"{root.rstrip('/')}/{DAY}={d}" for d in days]
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("basePath", root).load(paths).select("path", DAY)
    footers = spark.read.schema("_none int").option("ignoreCorruptFiles", True).option("basePath", root).parquet(*paths)
    sound = footers.select(F.col("_metadata.file_path").alias("sound")).groupBy("sound").count()
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    doubtful = listed.join(sound, plain("path") == plain("sound"), "left_anti").orderBy("path")
    found: dict[dt.date, tuple[dt.date, str, str]] = {}
    for row in doubtful.toLocalIterator():
        day = _as_date(row[DAY])
        if day in found:
            continue
        try:
            spark.read.parquet(row["path"])
        except Exception as e:  # noqa: BLE001 - whatever keeps the file from being opened is the reason
            found[day] = (day, row["path"], str(e).splitlines()[0][:200])
    return sorted(found.values())


def write_snapshot(
    df: DataFrame, root: str, day: str | dt.date, files_per_day: Sequence[str] = (),
    metrics: dict[str, Column] | None = None, buckets: int | None = None,
) -> dict:
    """Replace one day of a dated table; other days stay untouched.

    `files_per_day` names columns to cluster rows by. Rebalancing lets AQE size the files and
    split a skewed cluster. `metrics` are aggregates that the write itself collects: they are taken
    of the rows as they are written, behind the last exchange, so that a repeated stage counts once.
    With `buckets` the day is placed by these columns instead, one file per bucket, sorted by them and by `date`. The
    number belongs to the size of the table (a few hundred MB a bucket), and to be joined without a shuffle, tables need
    the same one. Rows that are placed so already are not shuffled again.
    """
    if buckets and not files_per_day:
        raise ValueError("a placed day needs the columns to place it by")
    out = df.drop(DAY)
    if buckets:
        out = out.repartition(buckets, *files_per_day)
    elif files_per_day:
        out = out.hint("rebalance", *files_per_day)
    seen = Observation() if metrics else None
    if metrics:
        out = out.observe(seen, *[c.alias(name) for name, c in metrics.items()])
    out = out.drop(*[c for c in out.columns if c.startswith(HELPER)])
    if buckets:
        _write_placed(out, root, day, list(files_per_day), buckets)
        return dict(seen.get) if metrics else {}
    (
        out.withColumn(DAY, F.lit(_as_date(day))).write
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(root)
    )
    return dict(seen.get) if metrics else {}


def _folder(spark: SparkSession, root: str, day: str | dt.date):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{DAY}={_as_date(day)}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _child(spark: SparkSession, folder, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, name)


def _read_text(spark: SparkSession, files, path) -> str:
    stream = files.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _entry(path: str, schema: str, buckets: int, by: Sequence[str]) -> str:
    """The catalog's name for a placed day; another schema or placement is another entry."""
    return "agrospark_" + hashlib.md5(json.dumps([path, schema, buckets, list(by)]).encode()).hexdigest()


def _write_placed(df: DataFrame, root: str, day: str | dt.date, by: list[str], buckets: int) -> None:
    spark = df.sparkSession
    files, folder = _folder(spark, root, day)
    schema = df._jdf.schema().toDDL()
    order = [*by, *[c for c in ("date",) if c in df.columns and c not in by]]
    entry = _entry(folder.toString(), schema, buckets, by)
    # The entry is for the write alone: the files of a table with a path of its own stay when it is dropped.
    df.write.mode("overwrite").format("parquet").option("path", folder.toString()) \
        .bucketBy(buckets, *by).sortBy(*order).saveAsTable(entry)
    spark.sql(f"drop table {entry}")
    stream = files.create(_child(spark, folder, PLACEMENT), True)
    try:
        stream.write(bytearray(json.dumps({"buckets": buckets, "by": by, "order": order, "schema": schema}), "utf-8"))
    finally:
        stream.close()


def _read_placed(spark: SparkSession, folder, placement: dict) -> DataFrame:
    by, order = (", ".join(f"`{c}`" for c in placement[k]) for k in ("by", "order"))
    entry = _entry(folder.toString(), placement["schema"], placement["buckets"], placement["by"])
    location = folder.toString().replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"create table if not exists {entry} ({placement['schema']}) using parquet clustered by ({by}) "
              f"sorted by ({order}) into {placement['buckets']} buckets location '{location}'")
    spark.catalog.refreshTable(entry)  # the day may have been written again
    return spark.table(entry)


def publish_snapshot(spark: SparkSession, staged: str, root: str, day: str | dt.date) -> None:
    """Move a staged day into a dated table, in place of the day that is there. No file is read."""
    files, source = _folder(spark, staged, day)
    _, target = _folder(spark, root, day)
    files.delete(target, True)
    files.mkdirs(target.getParent())
    if files.exists(source) and not files.rename(source, target):
        raise OSError(f"cannot move {source} to {target}")


def discard_snapshot(spark: SparkSession, staged: str, day: str | dt.date) -> None:
    files, source = _folder(spark, staged, day)
    files.delete(source, True)


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str = "plot_id", order: str = "date") -> None:
    """A catalog table bucketed by plot and sorted by day.

    Weather, daily features and samples stored this way with the same number of buckets join and
    aggregate per plot without a shuffle. Bucket counts belong to the size of the table (a few
    hundred MB per bucket).
    """
    sort = [key, order] if order in df.columns else [key]
    # Rows meet their bucket before the write, so that a bucket is one file.
    placed = df.repartition(buckets, key)
    placed.write.mode("overwrite").bucketBy(buckets, key).sortBy(*sort).saveAsTable(table)
