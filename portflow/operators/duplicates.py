"""Flagging repeated keys without a window, so one hot key never lands in one task's sort."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.session import scratch_dir
from portflow.sources.layers import CODEC, store

KEEP_FIRST = "keep_first"
FLAG_ALL = "flag_all"

# So many stored hashes, 16 MB, are broadcast whatever Spark estimates.
BROADCAST_HASHES = 1 << 21
# With more repeated keys than this, rows are told apart by hash first, so that most of them are not shuffled with the keys. With
# more than can be broadcast, that would shuffle all rows, too, and those with a hash once more.
MANY_GROUPS = 20_000


def duplicate_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The keys that occur more than once, with the number of copies and the first copy's order values.

    Only the key and order columns are shuffled, and a key's copies are combined before the shuffle: a
    key that owns a third of all rows arrives as one row per map task.
    """
    measures = [F.count(F.lit(1)).alias("_copies")]
    if order:
        measures.append(F.min(F.struct(*order)).alias("_first"))
    return df.groupBy(*keys).agg(*measures).where(F.col("_copies") > 1)


def repeated_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """64-bit hashes shared by two or more rows' keys: a superset of the repeated keys, eight bytes each.

    Counting hashes is far cheaper than counting long text keys. Stored and joined back through
    :func:`with_hash_in`, they leave few rows for the exact search.
    """
    hashed = df.select(F.xxhash64(*keys).alias("_hash"))
    return hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1).select("_hash")


def with_hash_in(df: DataFrame, keys: Sequence[str], hashes: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose key has one of the hashes, or with ``left_anti`` the others."""
    return df.join(hashes, F.xxhash64(*[df[key] for key in keys]) == hashes["_hash"], how)


def broadcast_if_few(hashes: DataFrame) -> DataFrame:
    """Stored hashes; beyond :data:`BROADCAST_HASHES` Spark decides how to join them."""
    return F.broadcast(hashes) if hashes.count() <= BROADCAST_HASHES else hashes


def hashes_of(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The stored, distinct hashes of a table's keys, for :func:`with_hash_in`."""
    hashes = table.select(F.xxhash64(*keys).alias("_hash")).distinct()
    return broadcast_if_few(store(hashes, scratch_dir(table.sparkSession), CODEC))


def find_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """:func:`duplicate_groups`, stored, after narrowing the rows by hash.

    Both steps are written to scratch storage. So the joins with them know their sizes in bytes: Spark broadcasts a table below
    its own threshold, and otherwise shuffles both sides, where adaptive execution splits the partition of a hot key.
    """
    spark = df.sparkSession
    hashes = broadcast_if_few(store(repeated_hashes(df, keys), scratch_dir(spark), CODEC))
    suspects = with_hash_in(df, keys, hashes)
    return store(duplicate_groups(suspects, keys, order), scratch_dir(spark), CODEC)


def flag_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    policy: str = KEEP_FIRST,
    groups: DataFrame | None = None,
    flag: str = "is_duplicate",
) -> DataFrame:
    """Add a boolean column telling which rows repeat an earlier row's key.

    A null key repeats nothing. ``keep_first`` clears the flag on the first copy by ``order``, which must tell any two copies
    apart, byte-identical ones too: end it with the rows' position. ``flag_all`` sets it on every copy. ``groups`` is the result of
    :func:`find_groups`; without it the groups are found, and stored, on the spot.
    """
    if policy not in (KEEP_FIRST, FLAG_ALL):
        raise ValueError(f"unknown duplicate policy: {policy}")
    if policy == KEEP_FIRST and not order:
        raise ValueError("keep_first needs order columns")
    if groups is None:
        groups = find_groups(df, keys, order if policy == KEEP_FIRST else ())
    renamed = groups.withColumnsRenamed({key: f"_key_{i}" for i, key in enumerate(keys)})
    same_key = reduce(and_, [df[key] == renamed[f"_key_{i}"] for i, key in enumerate(keys)])
    alone = None
    if MANY_GROUPS < groups.count() <= BROADCAST_HASHES:
        hashes = hashes_of(groups, keys)
        alone = with_hash_in(df, keys, hashes, "left_anti")
        joined = with_hash_in(df, keys, hashes).join(renamed, same_key, "left")
    else:
        joined = df.join(renamed, same_key, "left")
    repeated = F.col("_copies").isNotNull()
    if policy == KEEP_FIRST:
        repeated = repeated & ~F.struct(*order).eqNullSafe(F.col("_first"))
    flagged = joined.select(*[df[name] for name in df.columns], repeated.alias(flag))
    return flagged if alone is None else flagged.unionAll(alone.select("*", F.lit(False).alias(flag)))
