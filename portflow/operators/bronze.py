"""Raw message text -> typed messages with stable ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portflow.functions.cleaning import piped_sha256, to_event_time, to_number
from portflow.schemas import MESSAGE_COLUMNS, MESSAGE_ID_FIELDS, RAW_COLUMNS
from portflow.settings import Settings


def message_id() -> Column:
    """SHA-256 of the identifying raw fields, taken from the untouched source text."""
    return piped_sha256(F.col(name) for name in MESSAGE_ID_FIELDS)


def payload_hash() -> Column:
    """SHA-256 of all raw fields in file order, taken from the untouched source text."""
    return piped_sha256(F.col(name) for name in RAW_COLUMNS)


def with_raw_columns(raw: DataFrame) -> DataFrame:
    """Add the source columns a file lacks as nulls, so the operators can name all of them."""
    present = {name.lower() for name in raw.columns}
    missing = {name: F.lit(None).cast("string") for name in RAW_COLUMNS if name.lower() not in present}
    return raw.withColumns(missing) if missing else raw


def _typed(raw_name: str, kind: str) -> Column:
    if kind == "double":
        return to_number(F.col(raw_name))
    return F.col(raw_name)


def to_bronze(raw: DataFrame, settings: Settings, carry: Sequence[str] = ()) -> DataFrame:
    """One typed row per raw message; ``raw`` holds the source columns and ``source_file``.

    ``carry`` names further columns to keep, such as the rows' position.

    Everything is read from the raw columns in one projection. Column names ignore case, so replacing
    ``Heading`` step by step would change the text the payload hash sees.
    """
    raw = with_raw_columns(raw)
    event_time = to_event_time(F.col("BaseDateTime"))
    typed = raw.select(
        *carry,
        message_id().alias("message_id"),
        F.col("source_file"),
        settings.as_of_instant.alias("ingestion_timestamp"),
        event_time.alias("event_timestamp"),
        F.col("MMSI").alias("mmsi"),
        *[_typed(raw_name, kind).alias(name) for raw_name, name, kind in MESSAGE_COLUMNS[2:]],
        payload_hash().alias("raw_payload_hash"),
    )
    return typed.select("*", *date_parts("event_timestamp"))


def date_parts(ts: str, date_name: str = "event_date") -> list[Column]:
    day = F.col(ts).cast("date")
    return [day.alias(date_name), F.year(day).alias("year"), F.month(day).alias("month")]


def padded_date_parts(ts: str) -> list[Column]:
    """Year, two-digit month and two-digit day as text."""
    day = F.col(ts).cast("date")
    return [
        F.year(day).cast("string").alias("year"),
        F.lpad(F.month(day).cast("string"), 2, "0").alias("month"),
        F.lpad(F.dayofmonth(day).cast("string"), 2, "0").alias("day"),
    ]
