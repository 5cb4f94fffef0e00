"""Helpers the operators share: stored intermediate tables, row ids, word hashes."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.session import scratch_dir
from portflow.sources.layers import store

# Tells rows apart even where ids repeat or are null.
ROW = "_llm_row"
# No file has that many rows.
FILE_ROWS = 1 << 40
_SCHEME = "^([A-Za-z][A-Za-z0-9+.-]*):/+"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's shared scratch folder and read it back.

    It cuts the lineage: whatever reads the table later survives lost executors without computing it again.
    """
    return store(df, scratch_dir(df.sparkSession))


def with_row(docs: DataFrame) -> DataFrame:
    """Add a row number that is the same in every scan of the same stored table, however its files are split.

    It is made of the file's place in the table's list of files and the row's place in the file, so executors may come and go
    between two scans. ``docs`` must be a scan of stored files, filtered or projected at most, or local rows. The plan
    carries the list of files, one path each.
    """
    # Spark writes the slashes behind the scheme in two ways.
    files = sorted({re.sub(_SCHEME, r"\1:/", name) for name in docs.inputFiles()})
    if not files:
        return docs.withColumn(ROW, F.monotonically_increasing_id())
    listed = F.posexplode(F.from_json(F.lit(json.dumps(files)), "array<string>"))
    places = docs.sparkSession.range(1).select(listed.alias("_llm_place", "_llm_file"))
    scanned = docs.metadataColumn("_metadata")
    located = docs.withColumns({"_llm_file": F.regexp_replace(scanned["file_path"], _SCHEME, "$1:/"), "_llm_index": scanned["row_index"]})
    numbered = located.join(places, "_llm_file", "left").withColumn(
        ROW, F.coalesce(F.col("_llm_place"), F.raise_error(F.lit("a file is not in the table's list")).cast("int")).cast("long") * FILE_ROWS + F.col("_llm_index")
    )
    return numbered.drop("_llm_file", "_llm_index", "_llm_place")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_hash_mod(name: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % modulus


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the n + 1 offsets of a binary or string column without nulls, without copying the bytes."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    first = int(bounds[0])
    return raw[first : int(bounds[-1])], bounds.astype(np.int64) - first


def slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to ``limit`` at most, or hold one larger item."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat_ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The concatenation of the ranges start ... start + size - 1."""
    filled = sizes > 0
    starts, sizes = starts[filled], sizes[filled]
    ends = np.cumsum(sizes)
    steps = np.ones(int(ends[-1]) if len(ends) else 0, np.int64)
    if len(steps):
        steps[0] = starts[0]
        steps[ends[:-1]] = starts[1:] - starts[:-1] - sizes[:-1] + 1
    return np.cumsum(steps)


# Bytes of words: ASCII letters and digits, and every byte of a non-ASCII character.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
# Upper-case ASCII letters count as lower-case ones.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        steps = np.full(n, np.uint64(base), np.uint64)
        if n:
            steps[0] = 1
        return np.multiply.accumulate(steps)


def word_hashes(
    raw: np.ndarray, bounds: np.ndarray, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hash every word of the concatenated texts; returns the hashes, per text, where its words start, and for
    each of ``prefixes`` the hashes of so many first bytes of the words, 0 for words that are no longer.

    A word is a maximal run of word bytes. Its hash is a polynomial over its bytes, modulo 2**64, mixed.
    """
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64), [np.zeros(0, np.uint64)] * len(prefixes)
    inside = WORD_BYTE[raw]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[bounds[:-1][bounds[:-1] < n]] = False
    starts = np.flatnonzero(inside & ~before)
    ends_mask = np.empty(n, bool)
    ends_mask[-1] = True
    ends_mask[:-1] = ~inside[1:]
    inner = bounds[1:-1]
    ends_mask[inner[inner > 0] - 1] = True
    ends = np.flatnonzero(inside & ends_mask) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((LOWER[raw].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
    scale = _powers(_INVERSE, n)[starts]
    hashes = mix64((sums[ends] - sums[starts]) * scale)
    begun = []
    for size in prefixes:
        cut = np.minimum(starts + size, ends)
        found = mix64((sums[cut] - sums[starts]) * scale + np.uint64(size))
        begun.append(np.where(ends - starts > size, found, np.uint64(0)))
    return hashes, np.searchsorted(starts, bounds).astype(np.int64), begun
