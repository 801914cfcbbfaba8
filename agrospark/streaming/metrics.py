"""Request and prediction metrics per tumbling window, for batch and streaming DataFrames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from agrospark import schemas as S


def _windowed(df: DataFrame, ts: str, width: str, watermark: str | None) -> tuple[DataFrame, object]:
    if df.isStreaming:
        df = df.withWatermark(ts, watermark or width)
    return df, F.window(ts, width)


def request_counts(
    requests: DataFrame, width: str = "1 day", ts: str = "ts", watermark: str | None = None
) -> DataFrame:
    """Requests per endpoint and status."""
    df, window = _windowed(requests, ts, width, watermark)
    return df.groupBy(window.alias("w"), "endpoint", "status").agg(F.count("*").alias("requests")).select(
        F.col("w.start").alias("window_start"), "endpoint", "status", "requests")


def bucket_name(bound: float) -> str:
    return "le_" + f"{bound:g}".replace(".", "_")


def latency_histogram(
    requests: DataFrame, width: str = "1 day", ts: str = "ts", watermark: str | None = None
) -> DataFrame:
    """Cumulative latency buckets with count and sum."""
    df, window = _windowed(requests, ts, width, watermark)
    buckets = [F.count_if(F.col("latency_s") <= b).alias(bucket_name(b)) for b in S.LATENCY_BUCKETS_S]
    return df.groupBy(window.alias("w")).agg(
        *buckets, F.count("latency_s").alias("le_inf"), F.sum("latency_s").alias("latency_sum")
    ).select(F.col("w.start").alias("window_start"), *[bucket_name(b) for b in S.LATENCY_BUCKETS_S],
             "le_inf", "latency_sum")


def prediction_log(
    predictions: DataFrame, width: str = "1 day", ts: str = "ts", watermark: str | None = None
) -> DataFrame:
    """Count, mean and spread of predictions per model."""
    df, window = _windowed(predictions, ts, width, watermark)
    return df.groupBy(window.alias("w"), "model").agg(
        F.count("prediction").alias("predictions"),
        F.avg("prediction").alias("mean_prediction"),
        F.stddev_pop("prediction").alias("std_prediction"),
        F.min("prediction").alias("min_prediction"),
        F.max("prediction").alias("max_prediction"),
    ).select(F.col("w.start").alias("window_start"), "model", "predictions", "mean_prediction",
             "std_prediction", "min_prediction", "max_prediction")
