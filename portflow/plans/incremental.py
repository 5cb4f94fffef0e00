"""Named queries over tables that grow or fail, and their SQL counterparts: the SQL computes everything at once."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.operators import bronze as bronze_ops
from portflow.operators import sessions, sketches
from portflow.operators.duplicate_log import DuplicateLog
from portflow.operators.duplicates import FLAG_ALL, KEEP_FIRST
from portflow.operators.stop_log import StopLog
from portflow.plans import oracle
from portflow.plans.catalog import COPY_ORDER, POSITION, WIDE, Lake, rounded
from portflow.plans.pipeline import Pipeline
from portflow.session import scratch_dir
from portflow.sources import layers
from portflow.sources import raw as raw_files
from portflow.sources.buckets import bucketed
from portflow.sources.ports import DEFAULT_PORTS
from portflow.sources.runs import read_newest, write_run

Query = Callable[[SparkSession, str], DataFrame]

# Moves the driver's events, all of one January, over the end of that month.
SHIFT_DAYS = 16


def published_after_failure(spark: SparkSession, folder: str) -> DataFrame:
    """What readers see after a run of a table has failed on one of its last rows."""
    path = scratch_dir(spark)
    silver = Lake(spark, folder).silver.select("message_id", "quality_status", *layers.BY_MONTH)
    write_run(silver, path, layers.BY_MONTH)
    broken = F.when(F.xxhash64("message_id") % 97 == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("message_id"))
    try:
        write_run(silver.withColumn("message_id", broken.cast("string")), path, layers.BY_MONTH)
    except (PySparkException, Py4JJavaError):
        return read_newest(spark, path).groupBy("quality_status", *layers.BY_MONTH).agg(F.count(F.lit(1)).alias("row_count"))
    raise AssertionError("the second run did not fail")


def _duplicates(policy: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        """Copies of a message arrive in different batches; the middle batch arrives twice."""
        bronze = Lake(spark, folder).bronze.select("message_id", *COPY_ORDER)
        # Stored, as a bronze table is: the batches and the result read it.
        rows = layers.store(bronze, scratch_dir(spark), layers.CODEC)
        log = DuplicateLog(spark, scratch_dir(spark), ["message_id"], COPY_ORDER, policy)
        part = (F.col("event_id") + F.col("copy")) % 3
        for batch in (1, 0, 2, 0):
            log.add(rows.where(part == batch), f"part-{batch}")
        return log.flagged(rows).drop("source_file", *POSITION)

    return query


def stops_month_by_month(spark: SparkSession, folder: str) -> DataFrame:
    candidates = sessions.stop_candidates(Lake(spark, folder, stored=True).proximity, WIDE)
    moved = F.col("event_timestamp") + F.make_dt_interval(F.lit(SHIFT_DAYS))
    rows = candidates.select(*sessions.STOP_KEYS, moved.alias("event_timestamp"), "speed_knots")
    rows = layers.store(rows.withColumn("month", F.date_format("event_timestamp", "yyyy-MM")), scratch_dir(spark))
    log = StopLog(spark, scratch_dir(spark), WIDE)
    for month in sorted(r.month for r in rows.select("month").distinct().collect()):
        log.add(rows.where(F.col("month") == month).drop("month"), month)
    return rounded(log.stops(), dwell_time_minutes=6, avg_speed_knots=9)


def stops_from_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """Stops of a proximity table bucketed by vessel and port: no shuffle between its scan and the stops."""
    candidates = sessions.stop_candidates(Lake(spark, folder).proximity, WIDE)
    rows = bucketed(candidates, scratch_dir(spark), sessions.STOP_KEYS, 8, f"portflow_{uuid.uuid4().hex}")
    return rounded(sessions.vessel_stops(rows, WIDE, DEFAULT_PORTS), dwell_time_minutes=6, avg_speed_knots=9)


def rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Files with lines of too many and too few fields: the broken lines as they stand, and the number of rows of the others."""
    root = scratch_dir(spark)
    raw = bronze_ops.with_raw_columns(Lake(spark, folder).raw)
    fields = [F.coalesce(F.col(name), F.lit("")) for name in raw_files.RAW_COLUMNS]
    line = F.concat_ws(",", *fields)
    broken = F.when(F.col("event_id") % 31 == 0, F.concat(line, F.lit(",surplus")))
    broken = broken.when(F.col("event_id") % 37 == 0, F.concat_ws(",", *fields[:5])).otherwise(line)
    # One text column whose name is the header; no line holds the separator.
    text = raw.select(broken.alias(",".join(raw_files.RAW_COLUMNS)))
    text.write.option("header", True).option("sep", "\x01").csv(layers.layer_path(root, "csv"))
    pipeline = Pipeline(spark, layers.layer_path(root, "lake"), WIDE)
    pipeline.bronze(raw_files.read_raw_csv(spark, layers.layer_path(root, "csv"), quarantine=True), "events")
    lines = pipeline.broken_lines().groupBy("line", "field_count").agg(F.count(F.lit(1)).alias("row_count"))
    whole = pipeline.table("bronze_messages").agg(F.count(F.lit(1)).alias("row_count"))
    return lines.unionByName(whole.select(F.lit(None).cast("string").alias("line"), F.lit(None).cast("int").alias("field_count"), "row_count"))


def weekly_from_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly distinct vessels and high-percentile dwell merged from stored daily sketches, held against exact values."""
    lake = Lake(spark, folder, stored=True)
    near, stops = layers.store(lake.proximity, scratch_dir(spark)), lake.stops
    path = scratch_dir(spark)
    write_run(sketches.daily_sketches(near, stops), path)
    week = F.date_trunc("week", "report_date").cast("date")
    merged = sketches.span_metrics(read_newest(spark, path), week, WIDE.dwell_percentile)
    keys = ["span", "port_id"]

    def spanned(rows: DataFrame, day: Column) -> DataFrame:
        return rows.select(F.date_trunc("week", day).cast("date").alias("span"), F.col("nearest_port_id").alias("port_id"), "*")

    vessels = spanned(near.where("is_within_port_radius"), F.col("event_timestamp")).groupBy(*keys).agg(
        F.count_distinct("mmsi").alias("vessels")
    )
    dwell = F.col("dwell_time_minutes")
    ranked = spanned(stops, F.col("stop_date")).join(merged.select(*keys, "p90_dwell_minutes"), keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("exact_stops"),
        F.count_if(dwell < F.col("p90_dwell_minutes")).alias("below"),
        F.count_if(dwell <= F.col("p90_dwell_minutes")).alias("upto"),
    )
    joined = merged.join(vessels, keys, "left").join(ranked, keys, "left").na.fill(0, ["vessels", "exact_stops", "below", "upto"])
    rank, slack = F.col("exact_stops") * WIDE.dwell_percentile, F.col("exact_stops") * F.col("rank_error") + 1
    return joined.select(
        F.col("span").alias("week"),
        "port_id",
        "vessels",
        F.col("exact_stops").alias("stops"),
        (F.abs(F.col("vessels_near_port") - F.col("vessels")) <= F.col("vessels") * F.col("distinct_error") + 0.5).alias("is_near_vessels"),
        (F.col("stops") == F.col("exact_stops")).alias("is_same_stops"),
        ((F.col("below") <= rank + slack) & (F.col("upto") >= rank - slack)).alias("is_near_p90"),
    )


QUERIES: dict[str, Query] = {
    "published_after_failure": published_after_failure,
    "duplicates_incremental": _duplicates(KEEP_FIRST),
    "duplicates_incremental_flag_all": _duplicates(FLAG_ALL),
    "stops_month_by_month": stops_month_by_month,
    "stops_from_buckets": stops_from_buckets,
    "rejected_lines": rejected_lines,
    "weekly_from_sketches": weekly_from_sketches,
}

ORACLES: dict[str, str] = {
    "published_after_failure": oracle.with_ctes(
        oracle.SILVER,
        """SELECT quality_status, CAST(year(event_timestamp) AS INTEGER) AS year,
          CAST(month(event_timestamp) AS INTEGER) AS month, count(*) AS row_count FROM silver GROUP BY ALL""",
    ),
    "duplicates_incremental": oracle.ORACLES["duplicates_keep_first"],
    "duplicates_incremental_flag_all": oracle.ORACLES["duplicates_flag_all"],
    "stops_month_by_month": oracle.with_ctes(oracle.stops_ctes(1440, 720, SHIFT_DAYS), oracle.STOP_SELECT),
    "stops_from_buckets": oracle.ORACLES["vessel_stops_wide"],
    "rejected_lines": oracle.with_ctes(
        oracle.RAW,
        """SELECT line, field_count, count(*) AS row_count FROM (
          SELECT CASE WHEN event_id % 31 = 0 THEN fields || ',,,,,,,,,,,surplus'
                      WHEN event_id % 37 = 0 THEN concat_ws(',', MMSI, BaseDateTime, LAT, LON, SOG) END AS line,
            CASE WHEN event_id % 31 = 0 THEN 18 WHEN event_id % 37 = 0 THEN 5 END AS field_count
          FROM (SELECT *, concat_ws(',', MMSI, BaseDateTime, LAT, LON, SOG, COG, Heading) AS fields FROM raw))
        GROUP BY ALL""",
    ),
    "weekly_from_sketches": oracle.with_ctes(
        oracle.stops_ctes(1440, 720),
        """SELECT week, port_id, coalesce(vessels, 0) AS vessels, coalesce(stops, 0) AS stops, true AS is_near_vessels,
          true AS is_same_stops, true AS is_near_p90
        FROM (SELECT CAST(date_trunc('week', event_timestamp) AS DATE) AS week, nearest_port_id AS port_id,
                count(DISTINCT mmsi) AS vessels FROM proximity WHERE is_within_port_radius GROUP BY ALL)
        FULL JOIN (SELECT CAST(date_trunc('week', stop_date) AS DATE) AS week, nearest_port_id AS port_id, count(*) AS stops
                FROM stops GROUP BY ALL) USING (week, port_id)""",
    ),
}
