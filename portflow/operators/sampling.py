"""Repeatable samples of exact size that do not depend on how the data is partitioned."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portflow.functions.cleaning import piped_sha256

_TOKEN = "_token"
_BIN = "_bin"
_GROUP = "_group"
_BIN_DIGITS = 5


def sample_token(keys: Sequence[str], seed: int) -> Column:
    """A row's place in the random order: SHA-256 of its key values and the seed."""
    return piped_sha256([*[F.col(k) for k in keys], F.lit(seed)])


def _sample(
    df: DataFrame,
    seed: int,
    keys: Sequence[str],
    group: Column,
    wanted: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Per group, the rows that come first in the order of :func:`sample_token`.

    ``wanted`` adds the column ``_wanted``, the group's sample size, to the counts per group and token
    prefix. Sorting is confined to what the sample needs. Rows are counted per prefix (at most 16^5 counts
    per group), which tells the prefix where a group's sample ends; later prefixes are filtered out during
    a second scan, and only the last one has to be cut inside. Identical rows are combined before the
    shuffle and written out again, so a message repeated endlessly stays cheap.
    """
    tokens = df.select(
        "*", sample_token(keys, seed).alias(_TOKEN), group.alias(_GROUP)
    ).withColumn(_BIN, F.substring(_TOKEN, 1, _BIN_DIGITS))
    # The windows over the counts see one row per prefix, never the data itself.
    in_order = Window.partitionBy(_GROUP).orderBy(_BIN).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = tokens.groupBy(_GROUP, _BIN).agg(F.count(F.lit(1)).alias("_rows"))
    ends = wanted(counts).withColumn("_upto", F.sum("_rows").over(in_order)).where("_upto >= _wanted")
    room = F.col("_wanted") - F.col("_upto") + F.col("_rows")
    last = ends.groupBy(_GROUP).agg(F.min(F.struct(_BIN, room.alias("room"))).alias("last"))
    by_group = last.agg(F.map_from_entries(F.collect_list(F.struct(_GROUP, "last"))).alias("lasts")).scalar()

    candidates = tokens.withColumn("_last", F.try_element_at(by_group, F.col(_GROUP)))
    candidates = candidates.where(F.col(_BIN) <= F.coalesce(F.col(f"_last.{_BIN}"), F.lit("g")))
    distinct_rows = candidates.groupBy(*df.columns, _TOKEN, _GROUP, _BIN, "_last").agg(
        F.count(F.lit(1)).alias("_copies")
    )
    in_bin = (
        Window.partitionBy(_GROUP, _BIN)
        .orderBy(_TOKEN, *df.columns)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = F.sum("_copies").over(in_bin) - F.col("_copies")
    left = F.when(F.col(_BIN) == F.col(f"_last.{_BIN}"), F.col("_last.room") - before)
    taken = F.least(F.col("_copies"), F.coalesce(left, F.col("_copies")))
    kept = distinct_rows.withColumn("_taken", taken).where(F.col("_taken") > 0)
    return kept.select(
        *df.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_taken"))).alias("_copy")
    ).drop("_copy")


def sample_exact(df: DataFrame, n: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """The ``n`` rows that come first in the order of :func:`sample_token`, or all rows if there are fewer.

    ``keys`` should tell the rows apart; rows that share a token are still cut to the exact size.
    """
    return _sample(df, seed, keys, F.lit("all"), lambda counts: counts.withColumn("_wanted", F.lit(n)))


def rejected_capture(flagged: DataFrame, n: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """Up to ``n`` rows that break a rule, with the reasons as text; ``flagged`` has ``quality_reasons``."""
    rejected = flagged.where(F.size("quality_reasons") > 0)
    return sample_exact(rejected, n, seed, keys).withColumn("quality_reasons", F.array_join("quality_reasons", "|"))


def sample_by_class(
    flagged: DataFrame, total: int, rejected_cap: int, seed: int, keys: Sequence[str]
) -> DataFrame:
    """Rejected rows up to their cap, filled up with valid rows to ``total``."""
    if rejected_cap > total:
        raise ValueError("the cap on rejected rows exceeds the sample")
    status = F.when(F.size("quality_reasons") > 0, "rejected").otherwise("valid")

    def wanted(counts: DataFrame) -> DataFrame:
        is_rejected = F.col(_GROUP) == "rejected"
        rejected = F.coalesce(F.sum(F.when(is_rejected, F.col("_rows"))).over(Window.partitionBy()), F.lit(0))
        room = F.lit(total) - F.least(rejected, F.lit(rejected_cap))
        return counts.withColumn("_wanted", F.when(is_rejected, F.lit(rejected_cap)).otherwise(room))

    return _sample(flagged, seed, keys, status, wanted)
