"""Thresholds and run parameters shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Settings:
    """One run's parameters. ``as_of`` is the processing time, a naive UTC value fixed once per run."""

    # Thresholds that decide the results.
    max_speed_knots: float = 60.0
    speed_not_available: float = 102.3
    stopped_below_knots: float = 1.0
    max_gap_minutes: int = 60
    min_dwell_minutes: float = 30.0
    dwell_percentile: float = 0.90
    weight_stopped_vessels: float = 0.40
    weight_avg_dwell: float = 0.35
    weight_stopped_positions: float = 0.25
    sample_rows: int = 500_000
    sample_seed: int = 42
    profile_sample_rows: int = 50_000
    profile_rejected_rows: int = 10_000

    as_of: datetime = field(default_factory=_utc_now)

    @property
    def as_of_local(self) -> Column:
        """Processing time as a zone-less timestamp, comparable with event times."""
        return F.lit(self.as_of.isoformat(sep=" ")).cast("timestamp_ntz")

    @property
    def as_of_instant(self) -> Column:
        """Processing time as an instant, whatever the session time zone is."""
        micros = (self.as_of - datetime(1970, 1, 1)) // _MICROSECOND
        return F.timestamp_micros(F.lit(micros))


_MICROSECOND = datetime.resolution
