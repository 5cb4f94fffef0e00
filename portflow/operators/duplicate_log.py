"""Repeated keys kept up to date batch by batch, without regrouping the rows seen before.

The log is a table of runs, one per batch. A run holds an index of the batch's keys, one row per key with the number of copies and the
first copy's order values, and the rows whose flag it has decided. The index is partitioned by a prefix of the key's hash
and by columns that equal keys share, such as the month; adding a batch reads only the partitions its keys fall into.

Of the rows of other batches that share a key, all but the first are flagged already, or, with ``flag_all``, all of them if
they are two or more. So a batch changes the flag of one row per key at most, the first of the others, and the index knows it:
rows of earlier batches are never read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.operators import duplicates
from portflow.operators.duplicates import FLAG_ALL, KEEP_FIRST, broadcast_if_few, hashes_of, with_hash_in
from portflow.session import scratch_dir
from portflow.sources.layers import CODEC, store, write_layer
from portflow.sources.runs import RUN, begin_run, publish, published_runs, read_all_runs, run_info

PREFIXES = 64


class DuplicateLog:
    """Which rows of all batches added so far repeat an earlier row's key.

    ``order`` decides the first copy and tells any two rows apart. A batch that is added again under its name replaces what it held
    before. Null keys repeat nothing. A batch that is cut off leaves the log as it was.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        order: Sequence[str],
        policy: str = KEEP_FIRST,
        within: Sequence[str] = (),
        prefixes: int = PREFIXES,
    ) -> None:
        if policy not in (KEEP_FIRST, FLAG_ALL):
            raise ValueError(f"unknown duplicate policy: {policy}")
        self.spark, self.path, self.policy, self.prefixes = spark, path, policy, prefixes
        self.keys, self.order, self.within = tuple(keys), tuple(order), tuple(within)
        self.places = (*[f"at_{name}" for name in self.within], "prefix")

    def _batches(self) -> dict[str, str]:
        """Batch -> the newest run that holds it."""
        runs = published_runs(self.spark, self.path)
        return {run_info(self.spark, run)["batch"]: run.rsplit("=", 1)[1] for run in runs}

    def _scratch(self, rows: DataFrame) -> DataFrame:
        return store(rows, scratch_dir(self.spark), CODEC)

    def _located(self, rows: DataFrame) -> DataFrame:
        """Rows with a key, and the index partition of each."""
        known = reduce(and_, [F.col(key).isNotNull() for key in self.keys])
        prefix = F.pmod(F.xxhash64(*self.keys), F.lit(self.prefixes)).cast("int")
        spans = [F.col(name).alias(f"at_{name}") for name in self.within]
        return rows.where(known).select(*self.keys, *spans, F.struct(*self.order).alias("row"), prefix.alias("prefix"))

    def _touched(self, *tables: DataFrame) -> Column:
        """A condition on partition columns alone: the index partitions these keys fall into, at most one per prefix and span."""
        places = [table.select(*self.places) for table in tables]
        found = reduce(DataFrame.unionByName, places).distinct().collect()
        values = {name: {place[name] for place in found} for name in self.places}
        condition = F.lit(bool(found))
        for name, chosen in values.items():
            known = sorted(value for value in chosen if value is not None)
            inside = F.col(name).isin(known) if known else F.lit(False)
            condition = condition & (inside | F.col(name).isNull() if None in chosen else inside)
        return condition

    def _index(self, batches: dict[str, str]) -> DataFrame:
        """The index rows of all batches as they stand."""
        rows = read_all_runs(self.spark, self.path).where((F.col("kind") == "index") & F.col(RUN).isin(list(batches.values())))
        return rows.select(*self.keys, *self.places, "copies", "row", "batch")

    def add(self, rows: DataFrame, batch: str) -> dict[str, int]:
        """Flag a batch's rows, and change the flags of others where it makes a difference; returns counts of what was written."""
        located = self._scratch(self._located(rows))
        keys = list(self.keys)

        def hashed(rows: DataFrame, part: str) -> DataFrame:
            return rows.select(F.xxhash64(*keys).alias("_hash"), F.lit(part).alias("part"))

        seen, known = hashed(located, "new"), self._batches()
        if known:
            index = self._index(known)
            replaced = index.where(F.col("batch") == batch) if batch in known else index.limit(0)
            others = index.where((F.col("batch") != batch) & self._touched(located, replaced))
            seen = seen.unionAll(hashed(replaced, "old")).unionAll(hashed(others, "other"))
        # All that follows is about keys that occur twice in the batch, or in it, before or now, and in another one. The 64-bit
        # hashes of the keys tell the few rows that may have one; the others are not shuffled for them.
        counts = [F.count_if(F.col("part") == part).alias(part) for part in ("new", "old", "other")]
        met = seen.groupBy("_hash").agg(*counts).where("new > 1 OR (new + old > 0 AND other > 0)")
        hashes = broadcast_if_few(self._scratch(met.select("_hash")))
        located_few = with_hash_in(located, keys, hashes)
        several = self._scratch(
            located_few.groupBy(*keys, *self.places).agg(F.count(F.lit(1)).alias("copies"), F.min("row").alias("row"))
        )
        alone = with_hash_in(located, keys, hashes, "left_anti")
        alone = alone.select(*keys, *self.places, F.lit(1).cast("long").alias("copies"), "row")
        new = several.unionAll(alone).withColumn("batch", F.lit(batch))
        sources = [several.withColumn("batch", F.lit(batch)).withColumn("part", F.lit("new"))]
        if known:
            sources += [with_hash_in(replaced, keys, hashes).withColumn("part", F.lit("old"))]
            sources += [with_hash_in(others, keys, hashes).withColumn("part", F.lit("other"))]
        measures = []
        for part in ("new", "old", "other"):
            mine = F.col("part") == part
            measures.append(F.sum(F.when(mine, F.col("copies")).otherwise(0)).alias(f"{part}_copies"))
            measures.append(F.min(F.when(mine, F.struct("row", "batch"))).alias(f"{part}_first"))
        keyed = reduce(DataFrame.unionByName, sources).groupBy(*self.keys, *self.places).agg(*measures)
        # An index row of another batch whose hash, but not whose key, is met changes nothing.
        keyed = self._scratch(keyed.where("new_copies + old_copies > 0"))

        written = [
            new.select(F.lit("index").alias("kind"), *self.places, *self.keys, "copies", "row", "batch", F.lit(None).cast("boolean").alias("is_duplicate")),
            self._flags(self._flagged(located_few, keyed), batch=F.lit(batch), flag=F.lit(True)),
            self._flags(self._changed(keyed), batch=F.col("of_batch"), flag=F.col("flag")),
        ]
        target = begin_run(self.spark, self.path)
        kinds = {"flags": F.col("kind") == "flag", "keys": F.col("kind") == "index"}
        counts = write_layer(
            reduce(DataFrame.unionByName, written).hint("rebalance", "kind", *self.places), target, ("kind", *self.places), counts=kinds
        )
        publish(self.spark, target, {**counts, "batch": batch})
        return counts

    def _flags(self, rows: DataFrame, batch: Column, flag: Column) -> DataFrame:
        return rows.select(
            F.lit("flag").alias("kind"), *self.places, *self.keys, F.lit(None).cast("long").alias("copies"), "row",
            batch.alias("batch"), flag.alias("is_duplicate"),
        )

    def _flagged(self, located: DataFrame, keyed: DataFrame) -> DataFrame:
        """The batch's rows that repeat a key."""
        repeated = keyed.where(F.col("new_copies") + F.col("other_copies") > 1).where("new_copies > 0")
        # Nulls are skipped, so a key without other copies is its own first.
        first = F.least("new_first.row", "other_first.row")
        joined = located.join(repeated.select(*self.keys, first.alias("first")), list(self.keys))
        return joined.where(~F.col("row").eqNullSafe(F.col("first"))) if self.policy == KEEP_FIRST else joined

    def _changed(self, keyed: DataFrame) -> DataFrame:
        """The rows of other batches whose flag differs now: for each key, only the first of them can."""
        row = F.col("other_first.row")
        if self.policy == KEEP_FIRST:
            before = F.coalesce(F.col("old_first.row") < row, F.lit(False))
            after = F.coalesce(F.col("new_first.row") < row, F.lit(False))
        else:
            before, after = F.col("old_copies") > 0, F.col("new_copies") > 0
        others = keyed.where("other_copies > 0")
        if self.policy == FLAG_ALL:
            others = others.where("other_copies = 1")
        judged = others.select(
            *self.keys, *self.places, row.alias("row"), F.col("other_first.batch").alias("of_batch"), before.alias("before"), after.alias("flag")
        )
        return judged.where(F.col("before") != F.col("flag"))

    def duplicates(self) -> DataFrame:
        """The order columns of all rows that are flagged now."""
        rows = read_all_runs(self.spark, self.path).where("kind = 'flag'")
        runs = self.spark.createDataFrame(list(self._batches().items()), "batch string, since string")
        # What was said of a batch's rows before it was added again is void.
        # Spark does not know how few batches there are; by their names alone the flags would be dealt to as few tasks.
        valid = rows.join(F.broadcast(runs), "batch").where(F.col(RUN) >= F.col("since"))
        latest = valid.groupBy("row").agg(F.max_by("is_duplicate", RUN).alias("is_duplicate"))
        return latest.where("is_duplicate").select("row.*")

    def flagged(self, rows: DataFrame, flag: str = "is_duplicate") -> DataFrame:
        """Rows of any batches with their flag."""
        renamed = [F.col(name).alias(f"_dup_{name}") for name in self.order]
        found = self._scratch(self.duplicates().select(*renamed, F.lit(True).alias("_dup")))
        same = reduce(and_, [rows[name].eqNullSafe(found[f"_dup_{name}"]) for name in self.order])
        flagged = [*[rows[name] for name in rows.columns], F.col("_dup").isNotNull().alias(flag)]
        if found.count() > duplicates.BROADCAST_HASHES:
            # Telling the rows apart by hash would shuffle all of them, too, and those with a hash once more.
            return rows.join(found, same, "left").select(*flagged)
        hashes = hashes_of(found, [f"_dup_{name}" for name in self.order])
        joined = with_hash_in(rows, self.order, hashes).join(found, same, "left")
        alone = with_hash_in(rows, self.order, hashes, "left_anti").select("*", F.lit(False).alias(flag))
        return joined.select(*flagged).unionAll(alone)
