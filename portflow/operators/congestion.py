"""Daily port metrics, min-max normalisation and the weighted congestion index."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portflow.operators.percentiles import exact_percentile
from portflow.operators.places import Ports, with_name
from portflow.schemas import CONGESTION_COLUMNS
from portflow.settings import Settings

PORT_DAY = ("report_date", "port_id")

# Dwell times are ranked in bins of this many minutes.
DWELL_BIN_MINUTES = 60.0


def proximity_metrics(proximity: DataFrame, settings: Settings) -> DataFrame:
    """Per day and port: distinct vessels within the radius and positions of stopped vessels."""
    near = proximity.where("is_within_port_radius")
    return near.groupBy(
        F.col("event_timestamp").cast("date").alias("report_date"), F.col("nearest_port_id").alias("port_id")
    ).agg(
        F.count_distinct("mmsi").alias("vessels_near_port"),
        F.count_if(F.col("speed_knots") < settings.stopped_below_knots).alias("stopped_position_count"),
    )


def stop_metrics(stops: DataFrame, settings: Settings, approx: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Per start day and port: stops, distinct vessels, mean dwell and high-percentile dwell.

    ``approx`` takes the percentile from a bounded sketch, which returns an observed dwell time.
    """
    keyed = stops.withColumnsRenamed({"stop_date": "report_date", "nearest_port_id": "port_id"})
    measures = [
        F.count(F.lit(1)).alias("stops"),
        F.count_distinct("mmsi").alias("stopped_vessels"),
        F.avg("dwell_time_minutes").alias("avg_dwell_time_minutes"),
    ]
    if approx:
        sketch = F.percentile_approx("dwell_time_minutes", settings.dwell_percentile, accuracy)
        return keyed.groupBy(*PORT_DAY).agg(*measures, sketch.alias("p90_dwell_time_minutes"))
    totals = keyed.groupBy(*PORT_DAY).agg(*measures)
    high = exact_percentile(
        keyed, PORT_DAY, "dwell_time_minutes", settings.dwell_percentile, DWELL_BIN_MINUTES, "p90_dwell_time_minutes"
    )
    return totals.join(high, list(PORT_DAY), "left")


def anomaly_metrics(anomalies: DataFrame) -> DataFrame:
    """Per day and port: anomalies within the radius."""
    near = anomalies.where("is_within_port_radius")
    return near.groupBy(
        F.col("event_timestamp").cast("date").alias("report_date"), F.col("nearest_port_id").alias("port_id")
    ).agg(F.count(F.lit(1)).alias("anomaly_count"))


def _scaled(value: Column, low: Column, high: Column) -> Column:
    return F.when(high == low, 0.0).otherwise(F.try_divide(value - low, high - low))


def minmax_normalize(df: DataFrame, columns: Mapping[str, str], partition: Sequence[str] = ()) -> DataFrame:
    """Add each column scaled to [0, 1] under a new name; 0 where all values agree.

    The bounds span all rows, or the rows of each ``partition``. They come from an aggregation rather
    than from a window, which would move all rows into one task.
    """
    bounds = [
        bound
        for name in columns
        for bound in (F.min(name).alias(f"_min_{name}"), F.max(name).alias(f"_max_{name}"))
    ]
    if partition:
        span = df.groupBy(*partition).agg(*bounds)
        # Rows whose group is null are a group, too.
        named = span.withColumnsRenamed({name: f"_of_{name}" for name in partition})
        same_group = reduce(and_, [df[name].eqNullSafe(named[f"_of_{name}"]) for name in partition])
        joined = df.join(named, same_group, "left")
        scaled = {
            new: _scaled(F.col(name), F.col(f"_min_{name}"), F.col(f"_max_{name}")) for name, new in columns.items()
        }
        return joined.select(*[df[name] for name in df.columns], *[scaled[new].alias(new) for new in columns.values()])
    span = df.agg(*bounds)
    whole = span.select(F.struct(*span.columns).alias("span")).scalar()
    spanned = df.withColumn("_span", whole)
    scaled = {
        new: _scaled(F.col(name), F.col(f"_span._min_{name}"), F.col(f"_span._max_{name}"))
        for name, new in columns.items()
    }
    return spanned.withColumns(scaled).drop("_span")


def weighted_index(
    df: DataFrame, weights: Mapping[str, float], alias: str, partition: Sequence[str] = ()
) -> DataFrame:
    """Add the weighted sum of the normalised columns."""
    names = {column: f"_normalized_{column}" for column in weights}
    normalized = minmax_normalize(df, names, partition)
    terms = [F.lit(weight) * F.col(names[column]) for column, weight in weights.items()]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return normalized.withColumn(alias, total).drop(*names.values())


def congestion_weights(settings: Settings) -> dict[str, float]:
    return {
        "stopped_vessels": settings.weight_stopped_vessels,
        "avg_dwell_time_minutes": settings.weight_avg_dwell,
        "stopped_position_count": settings.weight_stopped_positions,
    }


def latest_rejection_rate(report: DataFrame) -> Column:
    """Rejection rate of the newest report, null when there is none; a scalar, so it never drops rows."""
    # Two reports of one time are told apart by the run that added them, then by their source.
    order = F.struct("created_at", *[name for name in ("run", "source_file") if name in report.columns])
    newest = report.agg(F.max_by("rejection_rate", order).alias("rejection_rate"))
    return newest.scalar()


def congestion_base(
    proximity: DataFrame,
    stops: DataFrame,
    anomalies: DataFrame | None,
    report: DataFrame,
    settings: Settings,
    ports: Ports,
    join: str = "full",
    approx: bool = False,
) -> DataFrame:
    """The metrics of each day and port side by side, a missing one being zero.

    ``join="full"`` keeps every day and port any source knows; ``join="left"`` only those with positions.
    """
    keys = list(PORT_DAY)
    merged = proximity_metrics(proximity, settings).join(
        stop_metrics(stops, settings, approx), keys, join
    )
    if anomalies is not None:
        merged = merged.join(anomaly_metrics(anomalies), keys, join)
    else:
        merged = merged.withColumn("anomaly_count", F.lit(0).cast("bigint"))
    filled = merged.fillna(
        0,
        [
            "vessels_near_port",
            "stopped_vessels",
            "avg_dwell_time_minutes",
            "p90_dwell_time_minutes",
            "stopped_position_count",
            "anomaly_count",
        ],
    )
    named = with_name(filled, "port_id", "port_name", ports)
    return named.withColumn("data_quality_rejection_rate", latest_rejection_rate(report))


def congestion_index(base: DataFrame, settings: Settings, partition: Sequence[str] = ()) -> DataFrame:
    """Score the merged metrics.

    Scores are relative to all rows of the run; ``partition=["report_date"]`` keeps a day's scores
    unchanged when other days join the run.
    """
    scored = weighted_index(base, congestion_weights(settings), "port_congestion_index", partition)
    return scored.withColumn("created_at", settings.as_of_instant).select(*CONGESTION_COLUMNS)
