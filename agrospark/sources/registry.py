"""Model versions as an append-only log of events, and the current view folded from it.

An event is a file that is created, never replaced: `versions/<name>/<number>` holds a registration, `stages/<name>/<number>`
a change of stage. A writer takes the next free number by creating its file, which a file system lets only one of
several writers do; who comes second takes the number after it. Readers need no lock: the view is the fold of all
events, and an event is whole or absent, since it is written aside and moved to its name. (On object stores
whose moves replace what is there, use a file system connector that creates conditionally.)
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

EVENT = "name string, version bigint, run_id string, path string, registered_at string"
CHANGE = "name string, version bigint, stage string, at string"
CLAIM = "_claim-"
STAGES = ("None", "Staging", "Production", "Archived")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    files, path = _fs(spark, folder)
    if not files.exists(path):
        return []
    names = [s.getPath().getName().removesuffix(".json") for s in files.listStatus(path)]
    return sorted(int(n) for n in names if n.isdigit())


def _create(files, path) -> bool:
    """Make an empty file if there is none: False if there is one, also when another writer made it meanwhile."""
    uri = files.makeQualified(path).toUri()
    if uri.getScheme() == "file":  # whose connector looks first and creates then
        try:
            os.close(os.open(uri.getPath(), os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return False
        return True
    try:
        files.create(path, False).close()
    except Py4JJavaError as e:
        if files.exists(path):
            return False
        raise e
    return True


def _claim(spark: SparkSession, folder: str, event) -> int:
    """Create the next numbered file of a folder; `event` gives its content for a number.

    A claim whose writer is lost before its file is there leaves a gap, no more.
    """
    files, path = _fs(spark, folder)
    files.mkdirs(path)
    while True:
        names = [s.getPath().getName() for s in files.listStatus(path)]
        taken = [int(n.removeprefix(CLAIM)) for n in names if n.startswith(CLAIM)]
        number = max(taken, default=0) + 1
        _, marker = _fs(spark, f"{folder}/{CLAIM}{number}")
        if not _create(files, marker):
            continue
        _, aside = _fs(spark, f"{folder}/_{uuid.uuid4().hex}")
        out = files.create(aside, False)
        out.write(bytearray((json.dumps(event(number)) + "\n").encode()))
        out.close()
        if not files.rename(aside, _fs(spark, f"{folder}/{number}.json")[1]):
            raise OSError(f"cannot store event {number} in {folder}")
        return number


def register(spark: SparkSession, root: str, name: str, run_id: str, path: str, at: str) -> int:
    """A new version of the model, numbered after all others, in stage None."""
    return _claim(spark, f"{root}/versions/{name}", lambda n: {
        "name": name, "version": n, "run_id": run_id, "path": path, "registered_at": at})


def set_stage(spark: SparkSession, root: str, name: str, version: int, stage: str, at: str) -> int:
    """Give a version a stage. A new Production version archives the one before it, by the fold."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage: {stage}")
    if version not in _numbers(spark, f"{root}/versions/{name}"):
        raise ValueError(f"{name} has no version {version}")
    return _claim(spark, f"{root}/stages/{name}", lambda n: {"name": name, "version": version, "stage": stage, "at": at})


def _events(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    files, path = _fs(spark, folder)
    if not files.exists(path):
        return spark.createDataFrame([], schema + ", number bigint")
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(folder)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.json$", 1).cast("bigint")
    return rows.withColumn("number", number)


def current_versions(spark: SparkSession, root: str) -> DataFrame:
    """(name, version, stage, run_id, path): the last change of each version; of those in Production, the last one
    that got there, the others are Archived."""
    changes = _events(spark, f"{root}/stages", CHANGE)
    last = changes.groupBy("name", "version").agg(F.max_by("stage", "number").alias("stage"), F.max("number").alias("number"))
    newest = F.max(F.when(F.col("stage") == "Production", F.col("number"))).over(Window.partitionBy("name"))
    folded = last.withColumn("newest", newest).select("name", "version", F.when(
        (F.col("stage") == "Production") & (F.col("number") < F.col("newest")), "Archived").otherwise(F.col("stage")).alias("stage"))
    return _events(spark, f"{root}/versions", EVENT).join(folded, ["name", "version"], "left").select(
        "name", "version", F.coalesce("stage", F.lit("None")).alias("stage"), "run_id", "path")


def production(spark: SparkSession, root: str, name: str) -> str | None:
    """Where the model in Production is stored."""
    row = current_versions(spark, root).where((F.col("name") == name) & (F.col("stage") == "Production")).first()
    return None if row is None else row["path"]
