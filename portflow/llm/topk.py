"""Exact top-k inner products by norm order and partial sums in a rotated basis.

Vectors are rotated by the right singular vectors of a sample, so that their first components carry most of the length. Candidates
are dealt into blocks by descending length. For a query q and a candidate x, the product is a partial sum over the first rotated
components plus a rest that the Cauchy-Schwarz inequality bounds by the lengths of both rests. The block of the longest candidates is
searched first and gives every query a k-th best score to beat; then whole blocks are skipped by the lengths alone, and candidates by
their partial sums. Scores of what is left are exact integers. The rotation only decides how much is pruned, never the result.

Queries and candidates are both cut into blocks of bounded size and joined block by block through an equi-join on the number of the
query block, which each candidate block lists: no task sees more than one block of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portflow.llm.common import ROW, stored, with_row

SCALE = 1024
TOP = 10
BLOCK_ROWS = 4096
QUERY_ROWS = 512
# The rotation is fitted to at most so many vectors, those with the smallest hashes of their row numbers.
ROTATION_ROWS = 10_000
STAGES = (8, 24)
# Products below this are exact in 64-bit floats.
EXACT = 2.0**52


def scaled(vector: Column) -> Column:
    """floor(1024 * x) of every component, x as a 64-bit float; fails where that is beyond 64-bit integers."""
    beyond = F.raise_error(F.lit("a scaled component is beyond 64-bit integers")).cast("long")
    whole = lambda x: F.when(F.abs(x) < 2.0**63, F.floor(x)).otherwise(beyond)
    return F.transform(vector, lambda x: whole(x.cast("double") * SCALE))


def usable(vector: Column) -> Column:
    """Vectors that are neither null nor hold null, infinite or undefined components."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: fine(x.cast("double"))), F.lit(False))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of equal width; missing components of shorter vectors are zero."""
    sizes = lists.value_lengths().to_numpy()
    values = lists.flatten().to_numpy()
    out = np.zeros((len(lists), width), np.int64)
    if len(values):
        rows = np.repeat(np.arange(len(lists)), sizes)
        out[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of a bounded sample, the largest singular value first."""
    sample = vectors.orderBy(F.xxhash64(ROW), ROW).limit(ROTATION_ROWS).select("vector").toArrow()
    column = sample.column("vector").combine_chunks()
    if not len(column) or not width:
        return np.eye(width)
    matrix = _matrix(column, width).astype(np.float64)
    return np.linalg.svd(matrix.T @ matrix)[0]


def _blocks(vectors: DataFrame, number: Column, width: int) -> DataFrame:
    """(block, ids, data, norm): the vectors of each block, packed, and the length of its longest one."""

    def pack(table: pa.Table) -> pa.Table:
        matrix = _matrix(table.column("vector").combine_chunks(), width)
        norm = float(np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1)).max()) if len(matrix) else 0.0
        return pa.table(
            {
                "block": table.column("block").slice(0, 1),
                "rows": pa.array([table.column(ROW).to_pylist()], pa.list_(pa.int64())),
                "ids": pa.array([table.column("id").to_pylist()], pa.list_(pa.int64())),
                "data": pa.array([np.ascontiguousarray(matrix).tobytes()], pa.binary()),
                "norm": [norm],
            }
        )

    schema = "block long, rows array<long>, ids array<long>, data binary, norm double"
    return vectors.select(number.alias("block"), ROW, "id", "vector").groupBy("block").applyInArrow(pack, schema)


def best_of(
    queries: np.ndarray, candidates: np.ndarray, same: np.ndarray, least: np.ndarray, basis: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, candidate and score of everything that can be among the best ``k`` of its query.

    ``same`` names the candidate each query must not meet (-1: none); ``least`` is the score a query has ``k`` times already. Ties
    with it are kept. A score of a pair that is not ruled out fails if it is beyond 64-bit integers.
    """
    width = queries.shape[1]
    left, right = queries.astype(np.float64), candidates.astype(np.float64)
    norms = np.sqrt((left**2).sum(axis=1)), np.sqrt((right**2).sum(axis=1))
    # Room for rounding in the rotated sums, which are only bounds.
    slack = 1e-9 * norms[0][:, None] * norms[1][None, :] + 1e-6
    alive = norms[0][:, None] * norms[1][None, :] + slack >= least[:, None]
    rotated = left @ basis, right @ basis
    done, partial = 0, np.zeros(alive.shape)
    for depth in [d for d in STAGES if d < width]:
        live = np.flatnonzero(alive.any(axis=0))
        if not len(live):
            break
        partial[:, live] += rotated[0][:, done:depth] @ rotated[1][live, done:depth].T
        done = depth
        rests = [np.sqrt((x[:, done:] ** 2).sum(axis=1)) for x in rotated]
        alive[:, live] &= (
            partial[:, live] + rests[0][:, None] * rests[1][None, live] + slack[:, live] >= least[:, None]
        )
    exact = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(1, width) < EXACT
    live = np.flatnonzero(alive.any(axis=0))
    scores = (left @ right[live].T).astype(np.int64) if exact else queries @ candidates[live].T
    if not exact:
        # Integer products wrap around, so those within 64 bits are right; the others are told by their estimates.
        size = norms[0][:, None] * norms[1][None, live]
        near = alive[:, live] & (live[None, :] != same[:, None]) & (np.abs(left @ right[live].T) + 1e-9 * size >= 2.0**63)
        for i, j in zip(*np.nonzero(near)):
            value = sum(a * b for a, b in zip(queries[i].tolist(), candidates[live[j]].tolist()))
            if not -(1 << 63) <= value < 1 << 63:
                raise OverflowError(f"an inner product is beyond 64-bit integers: {value}")
    good = alive[:, live] & (scores >= least[:, None]) & (live[None, :] != same[:, None])
    return (*np.nonzero(good), scores, live)


def _search(pairs: DataFrame, width: int, basis: np.ndarray, k: int) -> DataFrame:
    """The best ``k`` of each query within each candidate block."""
    shared = pairs.sparkSession.sparkContext.broadcast(basis)
    names = ["q_rows", "q_ids", "q_data", "q_least", "rows", "ids", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part = {name: batch.column(j)[i] for j, name in enumerate(names)}
                q_rows, q_ids, rows, ids = (np.array(part[x].as_py(), np.int64) for x in ("q_rows", "q_ids", "rows", "ids"))
                q, x = (np.frombuffer(part[d].as_py(), np.int64).reshape(-1, width) for d in ("q_data", "data"))
                least = np.array([-np.inf if v is None else v for v in part["q_least"].as_py()], np.float64)
                order = np.argsort(rows)
                at = np.minimum(np.searchsorted(rows[order], q_rows), len(rows) - 1)
                same = np.where(rows[order][at] == q_rows, order[at], -1)
                query, column, scores, live = best_of(q, x, same, least, shared.value, k)
                found = live[column]
                value = scores[query, column]
                ranked = np.lexsort((rows[found], ids[found], -value, query))
                query, found, value = query[ranked], found[ranked], value[ranked]
                heads = np.searchsorted(query, np.arange(len(q_rows)))
                keep = np.arange(len(query)) - heads[query] < k
                query, found, value = query[keep], found[keep], value[keep]
                columns = [q_rows[query], q_ids[query], rows[found], ids[found], value]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _FOUND)

    return pairs.select(*names).mapInArrow(run, ", ".join(f"{n} long" for n in _FOUND))


_FOUND = ["q_row", "query_id", "row", "vec_id", "score"]


def _best(found: DataFrame, k: int) -> DataFrame:
    """A query's best over all blocks; every block gives it ``k`` rows at most."""
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_products(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products of each query with all other rows.

    Ties go to the smaller id. Unusable vectors (see :func:`usable`) and null ids take no part. Repeated ids are rows of their
    own; a query is only kept from meeting its own row. A shorter vector counts as filled up with zeros. Without
    queries or candidates there are no rows.
    """
    rows = with_row(vectors).where(usable(F.col(vector)) & F.col(vec_id).isNotNull())
    rows = stored(
        rows.select(ROW, F.col(vec_id).cast("long").alias("id"), scaled(F.col(vector)).alias("vector"), is_query.alias("asked"))
    )
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    seen = rows.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.count_if("asked")).first()
    n, width, n_queries = seen[0], seen[1] or 0, seen[2]
    n_blocks = max(1, -(-n // BLOCK_ROWS))
    basis = rotation(rows, width)
    # Blocks by descending length: numbers of a range partitioning, which spreads equal lengths by row.
    sized = rows.withColumn("size", -square)
    ranged = sized.repartitionByRange(n_blocks, "size", ROW).withColumn("place", F.spark_partition_id().cast("long"))
    candidates = stored(_blocks(stored(ranged.drop("size")), F.col("place"), width))
    n_query_blocks = max(1, -(-n_queries // QUERY_ROWS))
    asked = rows.where("asked")
    queries = stored(_blocks(asked, F.pmod(F.xxhash64(ROW), F.lit(n_query_blocks)), width))
    first = candidates.agg(F.min("block")).first()[0] or 0

    def search(blocks: DataFrame, queries: DataFrame) -> DataFrame:
        listed = blocks.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1))))
        named = queries.withColumnsRenamed({"rows": "q_rows", "ids": "q_ids", "data": "q_data", "norm": "q_norm"})
        pairs = listed.join(named.withColumnRenamed("block", "q_block"), F.col("query_block") == F.col("q_block"))
        # A block none of whose candidates can reach any query's k-th best is not searched.
        reach = F.col("norm") * F.col("q_norm") * (1 + 1e-9) + 1e-6
        needed = F.exists("q_least", lambda least: least.isNull() | (least <= reach))
        return _search(pairs.where(needed), width, basis, k)

    unknown = queries.withColumn("q_least", F.transform("rows", lambda _: F.lit(None).cast("double")))
    seeds = stored(_best(search(candidates.where(F.col("block") == first), unknown), k).drop("rank"))
    reached = seeds.groupBy("q_row").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    reached = reached.where(F.col("n") >= k).select("q_row", F.col("least").cast("double").alias("least"))
    flat = queries.select("block", F.posexplode("rows").alias("at", "q_row")).join(reached, "q_row", "left")
    least = flat.groupBy("block").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "least"))), lambda x: x["least"]).alias("q_least")
    )
    known = queries.join(least, "block")
    rest = search(candidates.where(F.col("block") != first), known)
    return _best(seeds.unionByName(rest), k).select("query_id", "rank", "vec_id", "score", "q_row")
