"""Port metrics that can be merged: daily sketches of distinct vessels and dwell times, rolled up to any span.

Distinct counts and percentiles of a week do not follow from those of its days, but their sketches do. A day and port keeps a few
kilobytes, however many messages there are, and a span reads these alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = ("report_date", "port_id")

# 2 ** DISTINCT_BITS registers, and the size of a quantile sketch.
DISTINCT_BITS = 12
QUANTILE_SIZE = 200
# Three standard errors of a distinct count; the rank error of that quantile sketch, at 99 percent confidence, doubled.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (DISTINCT_BITS / 2)
RANK_ERROR = 2 * 0.0133


def daily_sketches(proximity: DataFrame, stops: DataFrame) -> DataFrame:
    """Per day and port: a sketch of the vessels within the radius, the number of stops, their total and a sketch of their dwell times."""
    near = proximity.where("is_within_port_radius").groupBy(
        F.col("event_timestamp").cast("date").alias("report_date"), F.col("nearest_port_id").alias("port_id")
    ).agg(F.hll_sketch_agg("mmsi", F.lit(DISTINCT_BITS)).alias("vessels"), F.count(F.lit(1)).alias("positions"))
    dwell = F.col("dwell_time_minutes").cast("double")
    stopped = stops.groupBy(F.col("stop_date").alias("report_date"), F.col("nearest_port_id").alias("port_id")).agg(
        F.count(F.lit(1)).alias("stops"),
        F.sum(dwell).alias("dwell_sum"),
        F.kll_sketch_agg_double(dwell, F.lit(QUANTILE_SIZE)).alias("dwell"),
    )
    return near.join(stopped, list(DAY), "full")


def span_metrics(sketches: DataFrame, span: Column, percentile: float) -> DataFrame:
    """The metrics of each port and span, a column over ``report_date``, with the errors to expect.

    ``distinct_error`` is relative to the number of vessels, ``rank_error`` to the number of stops.
    """
    merged = sketches.groupBy(span.alias("span"), "port_id").agg(
        F.hll_union_agg("vessels").alias("vessels"),
        F.coalesce(F.sum("positions"), F.lit(0)).alias("positions"),
        F.coalesce(F.sum("stops"), F.lit(0)).alias("stops"),
        F.sum("dwell_sum").alias("dwell_sum"),
        F.kll_merge_agg_double("dwell").alias("dwell"),
    )
    return merged.select(
        "span",
        "port_id",
        F.coalesce(F.hll_sketch_estimate("vessels"), F.lit(0)).alias("vessels_near_port"),
        "positions",
        "stops",
        F.try_divide("dwell_sum", "stops").alias("avg_dwell_minutes"),
        F.when(F.col("stops") > 0, F.kll_sketch_get_quantile_double("dwell", F.lit(percentile))).alias("p90_dwell_minutes"),
        F.lit(DISTINCT_ERROR).alias("distinct_error"),
        F.lit(RANK_ERROR).alias("rank_error"),
    )
