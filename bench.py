"""Time the headline queries; prints one JSON line.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[BENCH_CPUS]``. A query's time covers
building it, including tables it stores on the way, and computing all of its rows.
"""

from __future__ import annotations

import json
import os
import time

from portflow.plans.catalog import QUERIES
from portflow.session import build_session

HEADLINE = (
    "bronze_message_ids",
    "quality_flags",
    "duplicates_keep_first",
    "lineitem_duplicates",
    "quality_report",
    "source_profile",
    "sample_exact",
    "sample_by_class",
    "nearest_port",
    "port_positions",
    "stop_gaps",
    "stop_episodes",
    "vessel_stops_default",
    "vessel_anomalies",
    "stop_metrics",
    "port_congestion_daily",
    "congestion_ranking",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "portflow-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's file and Parquet code before the first measured query.
    spark.read.parquet(f"{folder}/events.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    scale = folder.rstrip("/").rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
