"""Session settings the library expects."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stored tables below this size are broadcast; Spark knows their sizes from their files.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    # Write a few partitions side by side rather than sort each task's rows by partition first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # The JVM leaves methods above this size uncompiled; a fused stage that big runs faster unfused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "portflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A new, unused path for intermediate tables.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _local_folder(spark)
    return f"{base.rstrip('/')}/portflow-{uuid.uuid4().hex}"


def _local_folder(spark: SparkSession) -> str:
    """A temporary folder, for tests on one machine only: executors of a cluster could not share it."""
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="portflow-")
