"""Fixity audit of web-archive replicas with Merkle trees.

Records lie in an archive one after another, in the order of their keys. A leaf of the tree is the hash of all records that start in one
range of offsets; sixteen neighbouring nodes hash into their parent, up to one root. Each replica has its own tree, made where its
records are. An audit compares the roots, and then on each level only the children of nodes that differ, so that only
the records of damaged ranges are ever compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portflow.llm.common import stored

RANGE_BYTES = 1 << 16
FANOUT = 16


def record(url: str = "url", body: str = "html") -> Column:
    """A WARC response record of the page, as text; null counts as empty."""
    address, content = F.coalesce(F.col(url), F.lit("")), F.coalesce(F.col(body), F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        address,
        F.lit("\r\nContent-Length: "),
        F.octet_length(content).cast("string"),
        F.lit("\r\n\r\n"),
        content,
        F.lit("\r\n\r\n"),
    )


def digest(data: Column) -> Column:
    return F.sha2(data.cast("binary"), 256)


def laid_out(records: DataFrame, key: str, order: str, length: str) -> DataFrame:
    """Add ``offset``: the sum of the lengths of all records before, by key (null last), then by ``order``.

    The order is a range partitioning, whose parts are summed first: no task sees all records.
    """
    ranged = records.withColumn("_missing", F.col(key).isNull()).orderBy("_missing", key, order)
    placed = stored(ranged.drop("_missing").withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    sums = placed.groupBy(part.alias("_part")).agg(F.sum(length).alias("_sum"))
    before = sums.select("_part", (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_before"))
    within = F.sum(length).over(Window.partitionBy("_part").orderBy("_place")) - F.col(length)
    return (
        placed.withColumn("_part", part)
        .join(before, "_part")
        .withColumn("offset", F.col("_before") + within)
        .drop("_part", "_before", "_place")
    )


def _hash_of(order: str, entry: Column) -> Column:
    """The hash of a group's entries in the order of a column; the groups here are bounded."""
    entries = F.sort_array(F.collect_list(F.struct(F.col(order).alias("place"), entry.alias("entry"))))
    return digest(F.array_join(F.transform(entries, lambda x: x["entry"]), "\n")).alias("hash")


def tree(records: DataFrame, last_leaf: int, range_bytes: int = RANGE_BYTES) -> list[DataFrame]:
    """The levels of a replica's tree, leaves first: (node, hash). ``records``: offset, length, digest.

    The tree is as high as leaves 0 to ``last_leaf`` need. An archive without records has no nodes.
    """
    entry = F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"), F.col("digest"))
    leaf = F.floor(F.col("offset") / range_bytes).alias("node")
    levels = [stored(records.groupBy(leaf).agg(_hash_of("offset", entry)))]
    while last_leaf > 0:
        children = levels[-1].withColumnRenamed("node", "child")
        entry = F.concat_ws("=", F.col("child").cast("string"), F.col("hash"))
        parent = F.floor(F.col("child") / FANOUT).alias("node")
        levels.append(stored(children.groupBy(parent).agg(_hash_of("child", entry))))
        last_leaf //= FANOUT
    return levels


def damaged_ranges(one: list[DataFrame], two: list[DataFrame]) -> DataFrame:
    """The leaves in which two trees of the same height differ, found from the roots down."""
    differing = None
    for a, b in reversed(list(zip(one, two))):
        if differing is not None:
            parent = F.floor(F.col("node") / FANOUT)
            a, b = (x.withColumn("parent", parent).join(differing, "parent", "left_semi").drop("parent") for x in (a, b))
        joined = a.withColumnRenamed("hash", "hash_a").join(b.withColumnRenamed("hash", "hash_b"), "node", "full")
        found = joined.where(~F.col("hash_a").eqNullSafe(F.col("hash_b"))).select("node")
        differing = stored(found.withColumnRenamed("node", "parent"))
    return differing.withColumnRenamed("parent", "node")


def audit(one: DataFrame, two: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(offset, length, status) of every record in which two replicas differ: changed, or missing in one of them.

    Both replicas have offset, length and digest of each record, offsets being those of the archive as it was written.
    Equal replicas, empty ones too, give no rows.
    """
    ends = [x.agg(F.max("offset")).first()[0] or 0 for x in (one, two)]
    last_leaf = max(ends) // range_bytes
    ranges = damaged_ranges(tree(one, last_leaf, range_bytes), tree(two, last_leaf, range_bytes))
    sides = []
    for side, records in (("a", one), ("b", two)):
        node = F.floor(F.col("offset") / range_bytes).alias("node")
        kept = records.select("offset", "length", "digest", node).join(ranges, "node", "left_semi").drop("node")
        sides.append(kept.select("offset", F.col("length").alias(f"length_{side}"), F.col("digest").alias(f"digest_{side}")))
    joined = sides[0].join(sides[1], "offset", "full")
    status = (
        F.when(F.col("digest_b").isNull(), "missing")
        .when(F.col("digest_a").isNull(), "unexpected")
        .otherwise("changed")
    )
    differs = ~F.col("digest_a").eqNullSafe(F.col("digest_b")) | ~F.col("length_a").eqNullSafe(F.col("length_b"))
    return joined.where(differs).select("offset", F.coalesce("length_a", "length_b").alias("length"), status.alias("status"))
