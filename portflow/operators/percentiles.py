"""Exact percentiles whose memory does not grow with a group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_percentile(
    df: DataFrame, keys: Sequence[str], value: str, fraction: float, bin_width: float, alias: str
) -> DataFrame:
    """Percentile with linear interpolation at rank ``(n - 1) * fraction``, one row per key.

    The built-in exact percentile holds every distinct value of a group in one task's memory. Here values
    are counted first (combined before the shuffle), then counted per bin of ``bin_width``; the bins are
    few, and adding them up tells which bin holds the wanted ranks. Only the values of those bins, at
    most two per group, are put in order.
    """
    counted = (
        df.where(F.col(value).isNotNull())
        .withColumn("_bin", F.floor(F.col(value) / bin_width))
        .groupBy(*keys, "_bin", value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    by_bin = Window.partitionBy(*keys).orderBy("_bin")
    running = by_bin.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = by_bin.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = (F.col("_total") - 1) * F.lit(fraction)
    bins = (
        counted.groupBy(*keys, "_bin")
        .agg(F.sum("_n").alias("_in_bin"))
        .withColumn("_upto", F.sum("_in_bin").over(running))
        .withColumn("_total", F.sum("_in_bin").over(whole))
        .withColumn("_low", F.floor(rank))
        .withColumn("_high", F.least(F.col("_low") + 1, F.col("_total") - 1))
        .withColumn("_weight", rank - F.col("_low"))
        .withColumn("_before", F.col("_upto") - F.col("_in_bin"))
        .where((F.col("_before") <= F.col("_high")) & (F.col("_low") < F.col("_upto")))
        .select(
            *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)],
            F.col("_bin").alias("_key_bin"),
            "_before",
            "_low",
            "_high",
            "_weight",
        )
    )
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    wanted = counted.join(bins, reduce(and_, same, F.col("_bin") == F.col("_key_bin")))
    by_value = (
        Window.partitionBy(*keys, "_bin").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = wanted.withColumn("_end", F.col("_before") + F.sum("_n").over(by_value))

    def value_at(wanted_rank: str):
        covers = (F.col("_end") - F.col("_n") <= F.col(wanted_rank)) & (F.col(wanted_rank) < F.col("_end"))
        return F.max(F.when(covers, F.col(value)))

    ends = placed.groupBy(*keys).agg(
        value_at("_low").alias("_lower"), value_at("_high").alias("_upper"), F.max("_weight").alias("_weight")
    )
    between = F.col("_lower") * (1 - F.col("_weight")) + F.col("_upper") * F.col("_weight")
    return ends.select(*keys, between.alias(alias))
