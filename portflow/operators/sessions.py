"""Splitting per-key time series into episodes, and vessel stops built on them.

A slot is a half-open time span as wide as the allowed gap. Two rows of one key in the same slot are
never further apart than the gap, so a slot never spans two episodes. That makes slots the unit of work:
rows are first combined per key and slot, with map-side combining, and only the slots are put in order.
A key that owns a third of all rows therefore contributes at most one ordered row per slot of the time
range, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portflow.functions.cleaning import is_blank, piped_sha256
from portflow.functions.timing import MICROS_PER_MINUTE, compact_time, micros_between, minutes_between, slot_start
from portflow.operators.bronze import date_parts
from portflow.operators.places import Ports, with_name
from portflow.schemas import STOP_COLUMNS
from portflow.settings import Settings

SLOT = "_slot"


def _numbered_slots(
    df: DataFrame, keys: Sequence[str], ts: str, max_gap_minutes: int, measures: Sequence[Column] = ()
) -> DataFrame:
    """One row per key and non-empty slot, with the slot's time bounds and its episode number."""
    slots = (
        df.withColumn(SLOT, slot_start(F.col(ts), max_gap_minutes))
        .groupBy(*keys, SLOT)
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), *measures)
    )
    in_time = Window.partitionBy(*keys).orderBy(SLOT)
    so_far = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        slots.withColumn("_before", F.lag("_last").over(in_time))
        .withColumn("_starts", starts_episode(F.col("_before"), F.col("_first"), max_gap_minutes))
        .withColumn("episode", F.sum(F.col("_starts").cast("int")).over(so_far))
    )


def starts_episode(previous: Column, current: Column, max_gap_minutes: float) -> Column:
    return previous.isNull() | (minutes_between(previous, current) > max_gap_minutes)


def episode_sums(
    df: DataFrame, keys: Sequence[str], ts: str, max_gap_minutes: int, average: str | None = None
) -> DataFrame:
    """One row per key and episode: number, first and last time, row count, and the sum and count of a column's values."""
    measures = [F.count(F.lit(1)).alias("_rows")]
    if average:
        measures += [F.sum(average).alias("_sum"), F.count(average).alias("_known")]
    numbered = _numbered_slots(df, keys, ts, max_gap_minutes, measures)
    totals = [
        F.min("_first").alias("episode_start"),
        F.max("_last").alias("episode_end"),
        F.sum("_rows").alias("message_count"),
    ]
    if average:
        totals += [F.sum("_sum").alias("value_sum"), F.sum("_known").alias("value_count")]
    return numbered.groupBy(*keys, "episode").agg(*totals)


def mean_of_sums() -> Column:
    return F.try_divide("value_sum", "value_count")


def episodes(
    df: DataFrame, keys: Sequence[str], ts: str, max_gap_minutes: int, average: str | None = None
) -> DataFrame:
    """One row per key and episode: number, first and last time, row count and the mean of a column."""
    found = episode_sums(df, keys, ts, max_gap_minutes, average)
    if not average:
        return found
    return found.withColumn(f"avg_{average}", mean_of_sums()).drop("value_sum", "value_count")


def sessionize(df: DataFrame, keys: Sequence[str], ts: str, max_gap_minutes: int) -> DataFrame:
    """Every row with its episode number.

    The numbered slots are joined back by key and slot; adaptive execution splits a crowded slot.
    """
    slots = _numbered_slots(df, keys, ts, max_gap_minutes)
    renamed = slots.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], SLOT, "episode")
    rows = df.withColumn("_row_slot", slot_start(F.col(ts), max_gap_minutes))
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    joined = rows.join(renamed, reduce(and_, same, F.col("_row_slot") == F.col(SLOT)))
    return joined.select(*df.columns, "episode")


def position_gaps(df: DataFrame, keys: Sequence[str], ts: str, max_gap_minutes: int) -> DataFrame:
    """Each distinct time of a key with its row count, the time before it, the gap and the episode.

    Rows sharing a time have no gap between them, so they are counted rather than repeated. Ordering
    happens inside one slot; the first time of a slot takes its predecessor from the numbered slots.
    """
    times = (
        df.withColumn(SLOT, slot_start(F.col(ts), max_gap_minutes))
        .groupBy(*keys, SLOT, ts)
        .agg(F.count(F.lit(1)).alias("message_count"))
    )
    slots = _numbered_slots(times, keys, ts, max_gap_minutes).select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)],
        F.col(SLOT).alias("_key_slot"),
        "_before",
        "episode",
    )
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    joined = times.join(slots, reduce(and_, same, F.col(SLOT) == F.col("_key_slot")))
    inside = F.lag(ts).over(Window.partitionBy(*keys, SLOT).orderBy(ts))
    previous = F.coalesce(inside, F.col("_before"))
    return joined.select(
        *keys,
        ts,
        "message_count",
        previous.alias("previous_timestamp"),
        minutes_between(previous, F.col(ts)).alias("gap_minutes"),
        starts_episode(previous, F.col(ts), max_gap_minutes).alias("is_new_episode"),
        "episode",
    )


def episodes_by_session_window(
    df: DataFrame, keys: Sequence[str], ts: str, max_gap_minutes: int
) -> DataFrame:
    """Episodes through Spark's session window, which merges the slots of a key rather than its rows.

    A slot opens a session at its first time that lasts until the gap after its last time, so the sort by
    key and time inside the session window sees one row per slot.
    """
    slots = (
        df.withColumn(SLOT, slot_start(F.col(ts), max_gap_minutes))
        .groupBy(*keys, SLOT)
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_rows"))
    )
    open_for = micros_between(F.col("_first"), F.col("_last")) + F.lit(max_gap_minutes * MICROS_PER_MINUTE)
    session = F.session_window(F.col("_first"), F.concat(open_for.cast("string"), F.lit(" microseconds")))
    return (
        slots.groupBy(*keys, session)
        .agg(
            F.min("_first").alias("episode_start"),
            F.max("_last").alias("episode_end"),
            F.sum("_rows").alias("message_count"),
        )
        .drop("session_window")
    )


STOP_KEYS = ("mmsi", "nearest_port_id")


def stop_candidates(proximity: DataFrame, settings: Settings) -> DataFrame:
    """Slow messages inside a port's radius that name a vessel and a time."""
    return proximity.where(
        F.col("is_within_port_radius")
        & (F.col("speed_knots") < settings.stopped_below_knots)
        & F.col("event_timestamp").isNotNull()
        & ~is_blank(F.col("mmsi"))
        & F.col("nearest_port_id").isNotNull()
    )


def vessel_stops(proximity: DataFrame, settings: Settings, ports: Ports) -> DataFrame:
    """Stop episodes that last long enough, with ids, dwell time and date parts of their start."""
    candidates = stop_candidates(proximity, settings)
    found = episodes(candidates, STOP_KEYS, "event_timestamp", settings.max_gap_minutes, "speed_knots")
    return stops_of_episodes(found, settings, ports)


def stops_of_episodes(found: DataFrame, settings: Settings, ports: Ports) -> DataFrame:
    """The stops among episodes of slow messages, named and dated."""
    dwell = minutes_between(F.col("episode_start"), F.col("episode_end"))
    kept = found.withColumn("dwell_time_minutes", dwell).where(
        F.col("dwell_time_minutes") >= settings.min_dwell_minutes
    )
    # Only kept stops are numbered. A vessel has at most one stop per slot, so the window stays small.
    sequence = F.row_number().over(Window.partitionBy(*STOP_KEYS).orderBy("episode_start"))
    start = F.col("episode_start")
    label_time = F.concat(F.substring(compact_time(start), 1, 8), F.lit("T"), F.substring(compact_time(start), 9, 6))
    named = with_name(kept.withColumn("_sequence", sequence), "nearest_port_id", "nearest_port_name", ports)
    labelled = named.select(
        piped_sha256([F.col("mmsi"), F.col("nearest_port_id"), compact_time(start)]).alias("stop_id"),
        F.concat_ws("_", "mmsi", "nearest_port_id", label_time, F.col("_sequence").cast("string")).alias("stop_label"),
        *STOP_KEYS,
        "nearest_port_name",
        start.alias("stop_start_timestamp"),
        F.col("episode_end").alias("stop_end_timestamp"),
        "dwell_time_minutes",
        F.col("avg_speed_knots"),
        "message_count",
        *date_parts("episode_start", "stop_date"),
    )
    return labelled.select(*STOP_COLUMNS)
