"""The questions asked of the tables once they are built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.functions.timing import micros_between
from portflow.operators.quality import keep_rejected
from portflow.operators.sessions import stop_candidates
from portflow.settings import Settings


def _count(name: str = "row_count"):
    return F.count(F.lit(1)).alias(name)


def status_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("quality_status").agg(_count()).orderBy("quality_status")


def reason_counts(silver: DataFrame) -> DataFrame:
    """Rejected rows per combination of reasons, the most frequent first."""
    counts = keep_rejected(silver).groupBy("rejection_reason").agg(_count())
    return counts.orderBy(F.desc("row_count"), "rejection_reason")


def port_positions(proximity: DataFrame) -> DataFrame:
    """Per nearest port: positions, positions within the radius and distinct vessels."""
    return (
        proximity.groupBy("nearest_port_name")
        .agg(
            _count("total_positions"),
            F.count_if("is_within_port_radius").alias("positions_within_radius"),
            F.count_distinct("mmsi").alias("distinct_vessels"),
        )
        .orderBy(F.desc("positions_within_radius"), "nearest_port_name")
    )


def ports_near(proximity: DataFrame) -> DataFrame:
    """Per port: distinct vessels and positions within the radius."""
    return (
        proximity.where("is_within_port_radius")
        .groupBy("nearest_port_name")
        .agg(F.count_distinct("mmsi").alias("distinct_vessels"), _count("positions"))
        .orderBy("nearest_port_name")
    )


def min_port_distance(proximity: DataFrame) -> DataFrame:
    return proximity.agg(_count(), F.min("distance_to_port_km").alias("min_distance_km"))


def stop_count(stops: DataFrame) -> DataFrame:
    return stops.agg(_count("stop_count"))


def stops_by_port(stops: DataFrame) -> DataFrame:
    """Per port: stops, stopped vessels, mean and longest dwell."""
    return (
        stops.groupBy("nearest_port_name")
        .agg(
            _count("stops"),
            F.count_distinct("mmsi").alias("stopped_vessels"),
            F.avg("dwell_time_minutes").alias("avg_dwell_minutes"),
            F.max("dwell_time_minutes").alias("max_dwell_minutes"),
        )
        .orderBy(F.desc("stops"), "nearest_port_name")
    )


def congestion_ranking(congestion: DataFrame, limit: int | None = None) -> DataFrame:
    ranked = congestion.orderBy(F.desc("port_congestion_index"), "report_date", "port_id")
    return ranked.limit(limit) if limit is not None else ranked


def candidate_totals(proximity: DataFrame, settings: Settings) -> DataFrame:
    """How many slow messages near ports there are, and from how many vessels."""
    return stop_candidates(proximity, settings).agg(
        _count("candidate_stopped_positions"), F.count_distinct("mmsi").alias("distinct_vessels")
    )


def temporal_density(proximity: DataFrame, settings: Settings, limit: int = 20) -> DataFrame:
    """The vessels and ports with the most slow messages, and the time those span in whole minutes."""
    span = F.floor(micros_between(F.col("first_timestamp"), F.col("last_timestamp")) / 60_000_000)
    return (
        stop_candidates(proximity, settings)
        .groupBy("mmsi", "nearest_port_name")
        .agg(
            _count("stopped_messages"),
            F.min("event_timestamp").alias("first_timestamp"),
            F.max("event_timestamp").alias("last_timestamp"),
        )
        .withColumn("raw_time_span_minutes", span)
        .orderBy(F.desc("stopped_messages"), F.desc("raw_time_span_minutes"), "mmsi", "nearest_port_name")
        .limit(limit)
    )


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counted = [table.agg(_count()).select(F.lit(name).alias("table_name"), "row_count") for name, table in tables.items()]
    result = counted[0]
    for one in counted[1:]:
        result = result.unionByName(one)
    return result


def bronze_volume(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        _count(),
        F.min("event_timestamp").alias("min_event_timestamp"),
        F.max("event_timestamp").alias("max_event_timestamp"),
    )


def anomalies_by_port(anomalies: DataFrame) -> DataFrame:
    """Anomalies within the radius per port, the most first."""
    near = anomalies.where("is_within_port_radius")
    counts = near.groupBy("nearest_port_name").agg(_count("anomaly_count"))
    return counts.orderBy(F.desc("anomaly_count"), "nearest_port_name")


def anomalies_by_type(anomalies: DataFrame) -> DataFrame:
    counts = anomalies.groupBy("anomaly_type", "severity").agg(_count("anomaly_count"))
    return counts.orderBy(F.desc("anomaly_count"), "anomaly_type")


def anomalies_by_severity(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("severity").agg(_count("anomaly_count")).orderBy("severity")
