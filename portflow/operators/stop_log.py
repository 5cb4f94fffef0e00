"""Stop episodes kept up to date batch by batch.

An episode is a chain of messages with no gap longer than allowed. Whatever lies between its first and last message, two
episodes of a key belong together exactly if the time between them is no longer than the gap. So the episodes found so far stand for
all messages seen: a batch is split into episodes by itself, and those are joined with the known ones near them, in whatever
order batches arrive. Only keys with new messages are touched, and of those only episodes near the batch in time.

The log is a table of runs, one per batch: episodes that are new, and those they have replaced. The current episodes are
those that nothing has replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portflow.functions.timing import MICROS_PER_MINUTE
from portflow.operators.places import Ports
from portflow.operators.sessions import STOP_KEYS, episode_sums, mean_of_sums, starts_episode, stops_of_episodes
from portflow.session import scratch_dir
from portflow.settings import Settings
from portflow.sources.layers import store, write_layer
from portflow.sources.ports import DEFAULT_PORTS
from portflow.sources.runs import RUN, begin_run, publish, published_runs, read_all_runs, run_info

TIME = "event_timestamp"
BY_END = ("end_year", "end_month")


class StopLog:
    """The stop episodes of all batches added so far.

    ``path`` is the log's folder. Candidates are slow messages near a port (:func:`portflow.operators.sessions.stop_candidates`);
    every message belongs to one batch. A batch that is cut off leaves the log as it was.
    """

    def __init__(self, spark: SparkSession, path: str, settings: Settings, keys: Sequence[str] = STOP_KEYS) -> None:
        self.spark, self.path, self.settings, self.keys = spark, path, settings, tuple(keys)

    @property
    def batches(self) -> list[str]:
        return [run_info(self.spark, run)["batch"] for run in published_runs(self.spark, self.path)]

    def add(self, candidates: DataFrame, batch: str) -> dict[str, int]:
        """Join a batch's messages with the log; returns the numbers of rows added to it, by kind."""
        if batch in self.batches:
            raise ValueError(f"batch {batch} has been added before")
        found = self._scratch(self._parts(candidates))
        span = found.agg(F.min("episode_start"), F.max("episode_end")).first()
        chained = self._chained(found, *span) if span[0] else found.limit(0).withColumns({"chain": F.lit(0), "has_new": F.lit(True)})
        chained = self._scratch(chained.where("has_new"))
        measures = [F.min("episode_start").alias("episode_start"), F.max("episode_end").alias("episode_end")]
        measures += [F.sum(name).alias(name) for name in ("message_count", "value_sum", "value_count")]
        added = chained.groupBy(*self.keys, "chain").agg(*measures).withColumn("is_replaced", F.lit(False))
        replaced = chained.where(~F.col("is_new")).withColumn("is_replaced", F.lit(True))
        rows = added.drop("chain").unionByName(replaced.drop("chain", "is_new", "has_new"))
        dated = rows.withColumns({"end_year": F.year("episode_end"), "end_month": F.month("episode_end")})
        target = begin_run(self.spark, self.path)
        counts = write_layer(dated.hint("rebalance", *BY_END), target, BY_END, counts={"replaced": F.col("is_replaced")})
        publish(self.spark, target, {**counts, "batch": batch})
        return counts

    def _scratch(self, rows: DataFrame) -> DataFrame:
        return store(rows, scratch_dir(self.spark))

    def _parts(self, candidates: DataFrame) -> DataFrame:
        """The batch's own episodes."""
        sums = episode_sums(candidates, self.keys, TIME, self.settings.max_gap_minutes, "speed_knots")
        return sums.drop("episode").withColumn("is_new", F.lit(True))

    def _chained(self, found: DataFrame, first, last) -> DataFrame:
        """New episodes and the known ones near them, numbered by the episodes they form together."""
        gap = F.expr(f"INTERVAL {int(self.settings.max_gap_minutes * MICROS_PER_MINUTE)} MICROSECOND")
        together = found
        if published_runs(self.spark, self.path):
            since, until = F.lit(first) - gap, F.lit(last) + gap
            # The months are folders: earlier ones are not read.
            month = F.col("end_year") * 12 + F.col("end_month")
            known = self._current((month >= F.year(since) * 12 + F.month(since)) & (F.col("episode_end") >= since))
            near = known.where(F.col("episode_start") <= until).join(found.select(*self.keys).distinct(), list(self.keys), "left_semi")
            together = found.unionByName(near.withColumn("is_new", F.lit(False)))
        in_time = Window.partitionBy(*self.keys).orderBy("episode_start", "episode_end")
        before = F.max("episode_end").over(in_time.rowsBetween(Window.unboundedPreceding, -1))
        starts = starts_episode(before, F.col("episode_start"), self.settings.max_gap_minutes)
        so_far = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        chained = together.withColumn("starts", starts).withColumn("chain", F.sum(F.col("starts").cast("int")).over(so_far))
        return chained.drop("starts").withColumn("has_new", F.max("is_new").over(Window.partitionBy(*self.keys, "chain")))

    def _current(self, condition: Column | None = None) -> DataFrame:
        rows = read_all_runs(self.spark, self.path).drop(RUN)
        if condition is not None:
            rows = rows.where(condition)
        # A replacement holds more messages than what it replaces, so an episode never comes back.
        identity = [*self.keys, "episode_start", "message_count"]
        replaced = rows.where("is_replaced").select(*identity)
        return rows.where(~F.col("is_replaced")).join(replaced, identity, "left_anti").drop("is_replaced", *BY_END)

    def episodes(self) -> DataFrame:
        """The current episodes, with their mean speed."""
        means = self._current().withColumn("avg_speed_knots", mean_of_sums())
        return means.drop("value_sum", "value_count")

    def stops(self, ports: Ports = DEFAULT_PORTS) -> DataFrame:
        """The stops among them, as one run over all batches would give."""
        return stops_of_episodes(self.episodes(), self.settings, ports)
