"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Every one of these is a runtime SQL setting, so a session started elsewhere can be adjusted too.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Tables placed by plot_id may join on (plot_id, date) as they are. A plot holds at most one row
    # per calendar day, so placing by plot alone cannot skew a join.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; cluster sizing is left to the submitter."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "agrospark", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session; pass `master` only for local runs."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
