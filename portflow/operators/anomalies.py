"""Rejected messages as one anomaly per reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portflow.functions.cleaning import piped_sha256
from portflow.operators.places import Ports, with_nearest
from portflow.operators.quality import SILVER_RULES, Rule, keep_rejected
from portflow.schemas import ANOMALY_COLUMNS
from portflow.settings import Settings

_UNLISTED = Rule("", lambda: F.lit(False), "")


def _lookup(reason: Column, field: str) -> Column:
    """A rule's text by reason name; a reason outside the rules gets the default text."""
    pairs = [F.lit(text) for rule in SILVER_RULES for text in (rule.name, getattr(rule, field))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), reason), F.lit(getattr(_UNLISTED, field)))


def vessel_anomalies(silver: DataFrame, ports: Ports, settings: Settings) -> DataFrame:
    """One row per rejected message and reason, with the nearest port where the position is known.

    The anomaly id repeats when several copies of a message carry the same reason.
    """
    rejected = keep_rejected(silver).select(
        "message_id", "event_timestamp", "mmsi", "latitude", "longitude", "rejection_reason"
    )
    placed = with_nearest(rejected, ports)
    names = F.filter(F.split("rejection_reason", r"\|"), lambda name: name != "")
    exploded = placed.withColumn("anomaly_type", F.explode(names))
    return exploded.select(
        piped_sha256([F.col("message_id"), F.col("anomaly_type")]).alias("anomaly_id"),
        "event_timestamp",
        "mmsi",
        "nearest_port_id",
        "nearest_port_name",
        "distance_to_port_km",
        "is_within_port_radius",
        "port_radius_km",
        "anomaly_type",
        _lookup(F.col("anomaly_type"), "severity").alias("severity"),
        _lookup(F.col("anomaly_type"), "description").alias("description"),
        F.col("message_id").alias("source_message_id"),
        settings.as_of_instant.alias("created_at"),
    ).select(*ANOMALY_COLUMNS)
