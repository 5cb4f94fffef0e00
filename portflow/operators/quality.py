"""Row-level quality rules, rejection reasons and the quality reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portflow.functions.cleaning import is_blank, to_event_time, to_number
from portflow.operators.bronze import message_id, with_raw_columns
from portflow.operators.duplicates import KEEP_FIRST, flag_duplicates
from portflow.settings import Settings


def _sure(condition: Column) -> Column:
    """Unknown counts as false, so every flag is a plain boolean."""
    return F.coalesce(condition, F.lit(False))


def valid_latitude(degrees: Column) -> Column:
    return _sure(F.abs(degrees) <= 90.0)


def valid_longitude(degrees: Column) -> Column:
    return _sure(F.abs(degrees) <= 180.0)


def speed_unavailable(knots: Column, settings: Settings) -> Column:
    return _sure(knots == settings.speed_not_available)


def impossible_speed(knots: Column, settings: Settings) -> Column:
    """A missing speed is impossible; the not-available marker is not."""
    in_range = knots.between(0.0, settings.max_speed_knots)
    return ~_sure(in_range | (knots == settings.speed_not_available))


def valid_speed(knots: Column, settings: Settings) -> Column:
    return _sure(knots.between(0.0, settings.max_speed_knots) & (knots != settings.speed_not_available))


def future_time(ts: Column, settings: Settings) -> Column:
    """A missing time counts as a future one."""
    return F.coalesce(ts > settings.as_of_local, F.lit(True))


def message_flags(settings: Settings) -> dict[str, Column]:
    """The quality flags of a typed message, apart from the duplicate flag."""
    speed = F.col("speed_knots")
    return {
        "is_valid_coordinate": valid_latitude(F.col("latitude")) & valid_longitude(F.col("longitude")),
        "is_null_vessel_id": is_blank(F.col("mmsi")),
        "is_speed_unavailable": speed_unavailable(speed, settings),
        "is_impossible_speed": impossible_speed(speed, settings),
        "is_valid_speed": valid_speed(speed, settings),
        "is_future_timestamp": future_time(F.col("event_timestamp"), settings),
        "is_null_source_file": is_blank(F.col("source_file")),
        "is_null_ingestion_timestamp": F.col("ingestion_timestamp").isNull(),
    }


@dataclass(frozen=True)
class Rule:
    """A rejection reason: when it applies to a flagged row, and how the reports and anomalies show it."""

    name: str
    applies: Callable[[], Column]
    counted_as: str
    severity: str = "unknown"
    description: str = "Rejected for a reason without a description."


_COORDINATE = Rule(
    "invalid_coordinate",
    lambda: ~F.col("is_valid_coordinate"),
    "invalid_coordinates_count",
    "high",
    "Latitude or longitude is missing or off the globe.",
)
_VESSEL = Rule(
    "null_vessel_id",
    lambda: F.col("is_null_vessel_id"),
    "null_vessel_id_count",
    "high",
    "The message names no vessel.",
)
_FUTURE = Rule(
    "future_timestamp",
    lambda: F.col("is_future_timestamp"),
    "future_timestamp_count",
    "high",
    "The event time is missing or after the processing time.",
)
_DUPLICATE = Rule(
    "duplicate_message_id",
    lambda: F.col("is_duplicate"),
    "duplicate_records_count",
    "medium",
    "Another message carries the same id.",
)

# Order of the reasons inside a row's reason text.
SILVER_RULES = (
    _COORDINATE,
    _VESSEL,
    Rule(
        "speed_not_available",
        lambda: F.col("is_speed_unavailable"),
        "unavailable_speed_count",
        "low",
        "The speed field holds the marker for a speed that is not available.",
    ),
    Rule(
        "impossible_speed",
        lambda: F.col("is_impossible_speed"),
        "impossible_speed_count",
        "medium",
        "The speed is missing, negative or above the plausible maximum.",
    ),
    _FUTURE,
    Rule("null_source_file", lambda: F.col("is_null_source_file"), "null_source_file_count"),
    Rule(
        "null_ingestion_timestamp",
        lambda: F.col("is_null_ingestion_timestamp"),
        "null_ingestion_timestamp_count",
    ),
    _DUPLICATE,
)

# Whole-source profile: the not-available marker is one more speed out of range.
PROFILE_RULES = (
    _COORDINATE,
    _VESSEL,
    Rule("invalid_speed", lambda: F.col("is_invalid_speed"), "impossible_speed_count"),
    _FUTURE,
    _DUPLICATE,
)


def reasons(rules: Sequence[Rule]) -> Column:
    """Names of the rules a flagged row breaks, in rule order."""
    return F.array_compact(F.array(*[F.when(rule.applies(), F.lit(rule.name)) for rule in rules]))


def any_reason(rules: Sequence[Rule]) -> Column:
    return reduce(or_, [rule.applies() for rule in rules])


def classify(
    bronze: DataFrame,
    settings: Settings,
    order: Sequence[str],
    policy: str = KEEP_FIRST,
    groups: DataFrame | None = None,
) -> DataFrame:
    """All bronze rows with quality flags, reason text and status.

    ``order`` decides which copy of a repeated message is the first. It must tell any two rows apart, so it ends with the
    rows' position.
    """
    flagged = flag_duplicates(bronze, ["message_id"], order, policy, groups).withColumns(message_flags(settings))
    return flagged.withColumn("rejection_reason", F.array_join(reasons(SILVER_RULES), "|")).withColumn(
        "quality_status", F.when(any_reason(SILVER_RULES), "rejected").otherwise("valid")
    )


def keep_valid(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("quality_status") == "valid")


def keep_rejected(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("quality_status") == "rejected")


def rejection_rate() -> Column:
    return F.coalesce(F.try_divide(F.col("rejected_records"), F.col("total_records")), F.lit(0.0))


def quality_report(silver: DataFrame, settings: Settings, source: str) -> DataFrame:
    """One row: totals, one count per rule and the rejection rate, in a single pass.

    The stored silver table lacks the two lineage flags; they are derived again here.
    """
    lineage = ("is_null_source_file", "is_null_ingestion_timestamp")
    flags = message_flags(settings)
    silver = silver.withColumns({name: flags[name] for name in lineage if name not in silver.columns})
    rejected = F.col("quality_status") == "rejected"
    counts = [F.count_if(rule.applies()).alias(rule.counted_as) for rule in SILVER_RULES]
    totals = silver.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(~rejected).alias("valid_records"),
        F.count_if(rejected).alias("rejected_records"),
        *counts,
    )
    return totals.select(
        F.lit(settings.as_of.date()).alias("processing_date"),
        F.lit(source).alias("source_file"),
        "total_records",
        "valid_records",
        "rejected_records",
        "invalid_coordinates_count",
        "null_vessel_id_count",
        "duplicate_records_count",
        "impossible_speed_count",
        "unavailable_speed_count",
        "future_timestamp_count",
        "null_source_file_count",
        "null_ingestion_timestamp_count",
        rejection_rate().alias("rejection_rate"),
        settings.as_of_instant.alias("created_at"),
    )


def _raw_flags(settings: Settings) -> dict[str, Column]:
    knots = to_number(F.col("SOG"))
    return {
        "is_valid_coordinate": valid_latitude(to_number(F.col("LAT")))
        & valid_longitude(to_number(F.col("LON"))),
        "is_null_vessel_id": is_blank(F.col("MMSI")),
        "is_invalid_speed": ~_sure(knots.between(0.0, settings.max_speed_knots)),
        "is_future_timestamp": future_time(to_event_time(F.col("BaseDateTime")), settings),
    }


def classify_raw(
    raw: DataFrame, settings: Settings, order: Sequence[str], policy: str = KEEP_FIRST
) -> DataFrame:
    """Raw rows with the profile's reasons as an array, empty for valid rows."""
    identified = with_raw_columns(raw).withColumn("message_id", message_id())
    flagged = flag_duplicates(identified, ["message_id"], order, policy).withColumns(_raw_flags(settings))
    return flagged.withColumn("quality_reasons", reasons(PROFILE_RULES))


def source_profile(raw: DataFrame, settings: Settings, source: str) -> DataFrame:
    """One row of totals over a raw source, under the profile rules.

    Every profile flag depends only on fields inside the message id, so all copies of an id share them.
    Rows are therefore counted per id first: no copy has to be singled out as the first, and a message
    repeated any number of times costs one row per map task.
    """
    flags = _raw_flags(settings)
    per_id = (
        with_raw_columns(raw)
        .select(message_id().alias("message_id"), *[column.alias(name) for name, column in flags.items()])
        .groupBy("message_id", *flags)
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    per_row = [rule for rule in PROFILE_RULES if rule is not _DUPLICATE]

    def copies_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("copies"))), F.lit(0))

    repeats = F.col("copies") - 1
    totals = per_id.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(F.when(any_reason(per_row), F.col("copies")).otherwise(repeats)), F.lit(0)).alias(
            "rejected_records"
        ),
        F.coalesce(F.sum(repeats), F.lit(0)).alias("duplicate_records_count"),
        *[copies_where(rule.applies()).alias(rule.counted_as) for rule in per_row],
    )
    valid = F.col("total_records") - F.col("rejected_records")
    captured = F.least(F.col("rejected_records"), F.lit(settings.profile_rejected_rows))
    sampled = captured + F.least(valid, F.lit(settings.profile_sample_rows) - captured)
    return totals.select(
        F.lit(source).alias("source_file"),
        "total_records",
        valid.alias("valid_records"),
        "rejected_records",
        "invalid_coordinates_count",
        "null_vessel_id_count",
        "duplicate_records_count",
        "impossible_speed_count",
        "future_timestamp_count",
        rejection_rate().alias("rejection_rate"),
        sampled.cast("bigint").alias("quality_sample_rows"),
        captured.cast("bigint").alias("anomaly_rows_captured"),
        settings.as_of_instant.alias("created_at"),
    )
