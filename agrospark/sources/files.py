"""CSV and Parquet inputs, text outputs, training results and the shared scratch folder."""

from __future__ import annotations

import atexit
import datetime as dt
import shutil
import tempfile
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from agrospark.functions import columns as C


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for local runs without a setting."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if root is None:
            root = tempfile.mkdtemp(prefix="agrospark-")
            atexit.register(shutil.rmtree, root, ignore_errors=True)  # ours alone, and of no use afterwards
        context.setCheckpointDir(root)
    return context.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint, so that a lost executor does not redo the whole plan."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def store(df: DataFrame, name: str, **options) -> DataFrame:
    """Write a stage result to the shared scratch folder and read it back; `options` are those of the write.

    For results that several later steps use: they are computed once, survive lost executors, and
    come back with a known size.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header, all columns as text under trimmed names; typing is the caller's job.

    Columns go by name: the files of a folder may have them in different orders, and a column that a file lacks is
    NULL there. Headers are the files' first lines, so no pass over the data infers types.
    """
    if not exists(spark, path):
        raise FileNotFoundError(f"input table not found: {path}")
    tables = []
    for header, paths in _by_header(spark, path).items():
        names = spark.read.option("header", True).csv(paths[0]).columns
        schema = T.StructType([T.StructField(c.strip(), T.StringType()) for c in names])
        tables.append(spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(paths))
    if not tables:
        return spark.read.option("header", True).csv(path)
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table, allowMissingColumns=True)
    return whole


def _by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The data files of a CSV table by their first line."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    def first_line(file) -> str | None:
        codec, raw = codecs.getCodec(file), fs.open(file)
        try:
            stream = codec.createInputStream(raw) if codec is not None else raw
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            raw.close()

    # Sub-folders as well; hidden files and folders are none of the data.
    paths, listing = [], fs.listFiles(p, True)
    root = len(fs.makeQualified(p).toString()) if fs.getFileStatus(p).isDirectory() else None
    while listing.hasNext():
        file = listing.next().getPath()
        inside = file.getName() if root is None else file.toString()[root:].lstrip("/")
        if not any(part[0] in "_." for part in inside.split("/")):
            paths.append(file)
    paths.sort(key=lambda f: f.toString())
    found: dict[str, list[str]] = {}
    with ThreadPoolExecutor(32) as opening:  # opening a file is waiting, not work
        for file, line in zip(paths, opening.map(first_line, paths)):
            if line is not None:
                found.setdefault(line, []).append(file.toString())
    return found


def read_plots(spark: SparkSession, path: str) -> DataFrame:
    return read_text_table(spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet or CSV, told apart by the suffix."""
    lower = path.rstrip("/").lower()
    if lower.endswith(".parquet"):
        return spark.read.parquet(path)
    if lower.endswith(".csv"):
        return read_text_table(spark, path)
    raise ValueError(f"unsupported table type: {path}")


def first_existing(spark: SparkSession, paths: Iterable[str | None]) -> str | None:
    return next((p for p in paths if p and exists(spark, p)), None)


def read_harvest(
    spark: SparkSession,
    root: str,
    day: str | dt.date,
    configured: str | None = None,
    local: Iterable[str] = (),
    csv_name: str = "harvest.csv",
) -> DataFrame | None:
    """Dated CSV, dated Parquet, a configured path, then local paths: the first that exists."""
    source = first_existing(
        spark, [f"{root}/{day}/{csv_name}", f"{root}/{day}/harvest.parquet", configured, *local])
    return None if source is None else read_table(spark, source)


def read_labels(
    spark: SparkSession, root: str, day: str | dt.date | None, fallbacks: Iterable[str] = ()
) -> DataFrame | None:
    """Labels of the day, else the newest, else the first readable file; None stops the run quietly."""
    from agrospark.sources.snapshots import read_latest

    found = read_latest(spark, root, day)
    if found is not None:
        return found
    source = first_existing(spark, fallbacks)
    return None if source is None else read_table(spark, source)


def export_labels(spark: SparkSession, path: str | None, root: str, day: str | dt.date) -> bool:
    """Store ready-made labels as a dated table; False when there is nothing to export."""
    from agrospark.functions.names import rename_first
    from agrospark.sources.snapshots import write_snapshot

    if path is None or not exists(spark, path):
        return False
    labels = rename_first(read_table(spark, path), "plot_id", ["plot_no"])
    labels = rename_first(labels, "Planting_Date", ["planting_date"])
    if "Planting_Date" in labels.columns:
        labels = labels.withColumn("Planting_Date", C.to_day(F.col("Planting_Date")))
    write_snapshot(labels, root, day)
    return True


def text_safe(df: DataFrame) -> DataFrame:
    """Days and times as ISO text and NaN as NULL, ready for JSON or CSV."""
    def safe(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            return F.date_format(col, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return C.clean_nan(col).alias(field.name)
        return col
    return df.select(*[safe(f) for f in df.schema.fields])


def to_json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    safe = text_safe(df)
    return safe.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in safe.columns])).alias(name))


def training_summary(comparison: DataFrame) -> DataFrame:
    """Number of models and the one with the least RMSE."""
    return comparison.agg(
        F.count("*").alias("total_models"),
        F.sort_array(F.collect_set("model")).alias("models_trained"),
        F.min_by("model", F.struct("RMSE", "model")).alias("best_model"),
    )


def write_training_results(
    root: str, day: str | dt.date, comparison: DataFrame, predictions: DataFrame | None = None
) -> dict[str, str]:
    """Metrics, summary and comparison as text, predictions as Parquet, under one folder per day."""
    base = f"{root}/{day}"
    paths = {
        "metrics": f"{base}/training_metrics",
        "comparison": f"{base}/model_comparison",
        "summary": f"{base}/training_summary",
    }
    # One row per model: a single small file each.
    comparison.coalesce(1).write.mode("overwrite").json(paths["metrics"])
    comparison.orderBy("RMSE").coalesce(1).write.mode("overwrite").option("header", True).csv(paths["comparison"])
    training_summary(comparison).coalesce(1).write.mode("overwrite").json(paths["summary"])
    if predictions is not None:
        paths["predictions"] = f"{base}/predictions_comparison"
        predictions.write.mode("overwrite").parquet(paths["predictions"])
    return paths
