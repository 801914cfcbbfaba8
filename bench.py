"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from agrospark.catalog import REGISTRY  # noqa: E402
from agrospark.session import get_session  # noqa: E402

HEADLINE = (
    "d11_batch_stages",
    "d13_vt_dates",
    "d19_season_summary",
    "e12_plot_indices",
    "f1_daily_features",
    "f3_plot_features",
    "g2_nearest_plot",
    "g6_merge_row_mode",
    "h8_metrics",
    "i4_drift_report",
    "a8_union_last_n",
    "a10_lookup_asof",
    "c4_weather_verdict",
    "j2_latency_histogram",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.log.level": "ERROR",
        "spark.ui.showConsoleProgress": "false"})
    # Start the workers and the reader once; this is session start, not query time.
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    times = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
