"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. Distinct blocks are sorted, and a block's place in that
order is its integer name. Then neighbouring names are paired, the distinct pairs are sorted and named in the
same way, and so on until every document has one name. Two documents have the same name at the same level
exactly if their texts are equal: equal names stand for equal blocks on every level, so nothing can collide.

Blocks are sorted by (64-bit fingerprint, content). Content is only compared, and only kept, for fingerprints
that several distinct blocks share, so text passes one shuffle, with copies combined before it, and all later
steps move integers. A group of copies that holds a third of all rows stays spread: it is counted with
map-side combination, and joins on its names are plain equi-joins that adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portflow.llm.common import ROW, stored, text_or_empty, with_row

BLOCK_BYTES = 4096
BROADCAST_BYTES = 64 << 20


def _blocks(docs: DataFrame, text: str, block_bytes: int, fingerprint: Callable[[Column], Column]) -> DataFrame:
    data = with_row(docs).select(ROW, F.encode(text_or_empty(text), "utf-8").alias("data"))
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("data") / block_bytes)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.col("data").substr(i * block_bytes + 1, F.lit(block_bytes))
    )
    return data.select(ROW, count.cast("long").alias("n"), F.posexplode(cut).alias("pos", "block")).select(
        ROW, "n", F.col("pos").cast("long").alias("pos"), fingerprint(F.col("block")).alias("print"), "block"
    )


def _named(entries: DataFrame, *order: str) -> DataFrame:
    """Number distinct rows by their place in sorted order; the numbers rise but are not gapless."""
    return stored(entries.orderBy(*order).withColumn("name", F.monotonically_increasing_id()))


def _block_names(blocks: DataFrame, block_bytes: int) -> DataFrame:
    """(row, n, pos, name) of every block."""
    distinct = blocks.select("print", "block").distinct()
    prints = stored(distinct.groupBy("print").agg((F.count(F.lit(1)) > 1).alias("shared")))
    plain = prints.where(~F.col("shared")).select("print", F.lit(None).cast("binary").alias("block"))
    shared = prints.where("shared").select("print")
    n_shared = shared.count()
    if not n_shared:
        names = _named(plain, "print")
        return blocks.select(ROW, "n", "pos", "print").join(names.select("print", "name"), "print").drop("print")
    few = n_shared * 2 * block_bytes <= BROADCAST_BYTES
    suspects = blocks.join(F.broadcast(shared) if few else shared, "print", "left_semi")
    contents = suspects.select("print", "block").distinct()
    names = _named(plain.unionByName(contents), "print", "block")
    told = names.where(F.col("block").isNotNull())
    return (
        blocks.select(ROW, "n", "pos", "print")
        .join(names.where(F.col("block").isNull()).select("print", "name"), "print")
        .drop("print")
        .unionByName(suspects.join(told, ["print", "block"]).select(ROW, "n", "pos", "name"))
    )


def identities(
    docs: DataFrame,
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    fingerprint: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row (row number, level, name) per row of ``docs``; (level, name) is equal exactly for equal texts.

    Null counts as the empty text, which is one empty block. Any ``fingerprint`` gives right results; a poor one
    costs time. ``docs`` must be a stored table (see :func:`with_row`).
    """
    level = stored(_block_names(_blocks(docs, text, block_bytes, fingerprint), block_bytes))
    done, depth = [], 0
    while True:
        single = F.col("n") == 1
        done.append(level.where(single).select(ROW, F.lit(depth).alias("level"), "name"))
        if level.where(~single).isEmpty():
            break
        depth += 1
        half = F.col("pos") % 2 == 0
        pairs = (
            level.where(~single)
            .groupBy(ROW, F.ceil(F.col("n") / 2).alias("n"), F.floor(F.col("pos") / 2).alias("pos"))
            .agg(
                F.max(F.when(half, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(~half, F.col("name"))), F.lit(-1)).alias("right"),
            )
        )
        pairs = stored(pairs)
        names = _named(pairs.select("left", "right").distinct(), "left", "right")
        level = stored(pairs.join(names, ["left", "right"]).select(ROW, "n", "pos", "name"))
    found = done[0]
    for rows in done[1:]:
        found = found.unionByName(rows)
    return found


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(row, doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Of equal texts the row with the largest id stays; of rows with that same id, exactly one. A null id is
    smaller than any other. Null counts as the empty text. An empty table gives no rows. Other columns of ``docs``,
    whatever their names, have no influence.
    """
    ids = with_row(docs).select(
        ROW, F.col(doc_id).alias("doc_id"), F.sha2(F.encode(text_or_empty(text), "utf-8"), 256).alias("text_sha256")
    )
    rows = stored(ids.join(identities(docs, text, **options), ROW))
    best = F.max(F.struct("doc_id", ROW)).alias("best")
    groups = stored(rows.groupBy("level", "name").agg(best, F.count(F.lit(1)).alias("group_size")))
    return rows.join(groups, ["level", "name"]).select(
        ROW,
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col(f"best.{ROW}") == F.col(ROW)).alias("kept"),
        "text_sha256",
    )


def without_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    kept = exact_duplicates(docs, doc_id, text).where("kept").select(ROW)
    return with_row(docs).join(kept, ROW, "left_semi").drop(ROW)
