"""The batch job: raw messages to lake tables, each stage reading what the one before has stored."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from portflow.operators.anomalies import vessel_anomalies
from portflow.operators.bronze import to_bronze
from portflow.operators.congestion import congestion_base, congestion_index
from portflow.operators.duplicates import KEEP_FIRST, find_groups
from portflow.operators.places import Ports, with_nearest
from portflow.operators.quality import classify, keep_valid, quality_report
from portflow.operators.sessions import stop_candidates, vessel_stops
from portflow.schemas import SILVER_COLUMNS
from portflow.session import scratch_dir
from portflow.settings import Settings
from portflow.sources.layers import BY_MONTH, LAYERS, POSITION_COLUMNS, batch_name, layer_path, store, with_position
from portflow.sources.ports import DEFAULT_PORTS
from portflow.sources.raw import BROKEN, broken_lines, without_broken_lines
from portflow.sources.runs import read_newest_parts, read_table_runs, retire_runs, subfolders, write_run

BROKEN_LINES = "bronze_broken_lines"

# Decides which copy of a message counts as the first; the position tells exact copies apart.
COPY_ORDER = ("source_file", "raw_payload_hash", *POSITION_COLUMNS)


@dataclass
class Pipeline:
    """One run over a raw source. ``counts`` collects the row counts each write reported.

    Every table is written once and read back by its consumers, so no stage is computed twice, and a lost
    executor costs only the tasks of the running stage. A run owns its source: it replaces exactly the bronze rows that came
    from that source before, those without a readable time and of far months among them, and leaves other sources' rows. All
    later tables are computed from the whole table before them and replaced as a whole.
    """

    spark: SparkSession
    root: str
    settings: Settings
    ports: Ports = DEFAULT_PORTS
    duplicate_policy: str = KEEP_FIRST
    congestion_join: str = "full"
    approx_percentile: bool = False
    normalize_within: Sequence[str] = ()
    counts: dict[str, dict[str, int]] = field(default_factory=dict)

    def table(self, name: str, position: bool = False) -> DataFrame:
        rows = read_table_runs(self.spark, self.root, name)
        return with_position(rows) if position else rows

    def _write(self, name: str, rows: DataFrame, counts: dict | None = None) -> None:
        self.counts[name] = write_run(rows, layer_path(self.root, name), LAYERS[name], counts)

    def _scratch(self, rows: DataFrame) -> DataFrame:
        return store(rows, scratch_dir(self.spark))

    def bronze(self, raw: DataFrame, source: str) -> None:
        """Map-only: input files hold consecutive days, so every task writes to few partitions.

        Lines that the reader has set apart (``quarantine``) go to a table of their own, so lines read are rows plus broken lines.
        """
        batch = f"batch={batch_name(source)}"
        if BROKEN in raw.columns:
            path = f"{layer_path(self.root, BROKEN_LINES)}/{batch}"
            self.counts[BROKEN_LINES] = write_run(broken_lines(raw), path)
            raw = without_broken_lines(raw)
        path = f"{layer_path(self.root, 'bronze_messages')}/{batch}"
        self.counts["bronze_messages"] = write_run(to_bronze(raw, self.settings), path, BY_MONTH)

    def broken_lines(self) -> DataFrame:
        """The broken lines of all sources that were read with ``quarantine``."""
        return read_newest_parts(self.spark, layer_path(self.root, BROKEN_LINES), "batch")

    def silver(self) -> None:
        """Flag every message; wide rows are not shuffled unless very many ids repeat.

        Repeated ids are narrowed down by hash, then found exactly among the few rows left over.
        """
        bronze = self.table("bronze_messages", position=True)
        groups = find_groups(bronze, ["message_id"], COPY_ORDER)
        flagged = classify(bronze, self.settings, COPY_ORDER, self.duplicate_policy, groups)
        status = F.col("quality_status")
        self._write(
            "silver_positions",
            flagged.select(*SILVER_COLUMNS),
            {"valid": status == "valid", "rejected": status == "rejected"},
        )

    def report(self, source: str) -> None:
        """A run of its own: the table is all of them, so a report that was cut off never shows."""
        report = quality_report(self.table("silver_positions"), self.settings, source)
        self._write("silver_quality_report", report)

    def proximity(self) -> None:
        valid = keep_valid(self.table("silver_positions"))
        self._write(
            "silver_proximity", with_nearest(valid, self.ports), {"within_radius": F.col("is_within_port_radius")}
        )

    def stops(self) -> None:
        seen = Observation()
        candidates = stop_candidates(self.table("silver_proximity"), self.settings)
        counted = candidates.observe(seen, F.count(F.lit(1)).alias("candidates"))
        stops = vessel_stops(counted, self.settings, self.ports)
        self._write("silver_stops", stops.hint("rebalance", *BY_MONTH))
        self.counts["silver_stops"].update(seen.get)

    def anomalies(self) -> None:
        found = vessel_anomalies(self.table("silver_positions"), self.ports, self.settings)
        # As many files as tasks, and a task of the scan takes small files together: no shuffle for the files' sake.
        self._write("gold_anomalies", found, {"within_radius": F.col("is_within_port_radius")})

    def congestion(self) -> None:
        base = congestion_base(
            self.table("silver_proximity"),
            self.table("silver_stops"),
            self.table("gold_anomalies"),
            self.table("silver_quality_report"),
            self.settings,
            self.ports,
            self.congestion_join,
            self.approx_percentile,
        )
        scored = congestion_index(self._scratch(base), self.settings, self.normalize_within)
        self._write("gold_congestion", scored.hint("rebalance", "report_date"))

    def run(self, raw: DataFrame, source: str) -> dict[str, dict[str, int]]:
        self.bronze(raw, source)
        self.silver()
        self.report(source)
        self.proximity()
        self.stops()
        self.anomalies()
        self.congestion()
        return self.counts

    def retire(self) -> None:
        """Remove what earlier runs have left behind; not while a reader may still be on them."""
        for name in LAYERS:
            path = layer_path(self.root, name)
            if name == "silver_quality_report":
                continue
            parts = [f"{path}/{part}" for part in subfolders(self.spark, path, "batch=")]
            for folder in parts or [path]:
                retire_runs(self.spark, folder)
