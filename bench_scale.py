"""Time the whole pipeline on many copies of the test events, written as raw CSV first.

    python bench_scale.py [copies] [--skew]

Each copy shifts vessels and event ids. With ``--skew`` a third of all rows are one vessel's and repeat
one and the same message. Prints one JSON line per stage and one for the run. Data goes to a new folder
under ``spark.checkpoint.dir`` or, locally, ``/tmp``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import datetime

from pyspark.sql import functions as F

from portflow.operators.bronze import with_raw_columns
from portflow.plans.pipeline import Pipeline
from portflow.schemas import RAW_COLUMNS
from portflow.session import build_session, scratch_dir
from portflow.settings import Settings
from portflow.sources.fixture import messages_from_events
from portflow.sources.layers import layer_path, write_csv
from portflow.sources.raw import read_raw_csv


def main() -> None:
    copies = int(next((a for a in sys.argv[1:] if a.isdigit()), "72"))
    skew = "--skew" in sys.argv
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        master=f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": os.environ.get("BENCH_SHUFFLES", "32"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_dir(spark)
    events = spark.read.parquet(f"{os.environ.get('BENCH_SF_DIR', '/root/testdata/sf0.1')}/events.parquet")
    shifted = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    shifted = shifted.repartition(int(cpus) * 4, "copy").select(
        (F.col("event_id") + F.col("copy") * 10_000_000).alias("event_id"),
        "ts",
        (F.col("user_id") + F.col("copy") * 100_000).alias("user_id"),
        "event_type",
        "value",
        "props",
    )
    messages = with_raw_columns(messages_from_events(shifted))
    if skew:
        repeated = {"MMSI": "366000000", "BaseDateTime": "2024-01-05T00:00:00", "LAT": "33.7542", "LON": "-118.2165",
                    "SOG": "0.1", "COG": "0", "Heading": "0"}
        hot = F.col("event_id") % 3 == 0
        messages = messages.withColumns({k: F.when(hot, v).otherwise(F.col(k)) for k, v in repeated.items()})
    write_csv(messages.select(*RAW_COLUMNS), layer_path(root, "raw"))

    pipeline = Pipeline(spark, layer_path(root, "lake"), Settings(as_of=datetime(2026, 1, 1)))
    raw = read_raw_csv(spark, layer_path(root, "raw"))
    stages = {
        "bronze": lambda: pipeline.bronze(raw, "raw"),
        "silver": pipeline.silver,
        "report": lambda: pipeline.report("raw"),
        "proximity": pipeline.proximity,
        "stops": pipeline.stops,
        "anomalies": pipeline.anomalies,
        "congestion": pipeline.congestion,
    }
    seconds = {}
    for name, stage in stages.items():
        started = time.time()
        stage()
        seconds[name] = round(time.time() - started, 2)
        print(json.dumps({"stage": name, "sec": seconds[name]}), flush=True)
    rows = pipeline.counts["bronze_messages"]["rows"]
    total = sum(seconds.values())
    print(json.dumps({
        "metric": "raw CSV to daily congestion", "rows": rows, "value": round(total, 2), "unit": "sec",
        "rows_per_sec": round(rows / total), "skew": skew, "stages": seconds, "counts": pipeline.counts,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
