"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is the weighted set of its five-word shingles: occurrences times an inverse document frequency. Document
frequencies are counted exactly over all texts; only shingles above a frequency whose number has a proven bound are broadcast, since
the inverse frequency is taken to saturate below it. Improved consistent weighted sampling draws, for every hash function, one
(shingle, level) pair per text, and two texts draw the same one with the probability of their weighted Jaccard similarity. The draws are
banded; texts that share a band are candidates, and a link is a candidate pair whose exact weighted Jaccard similarity is 0.8 or more.

Classes are the connected components of the links. They are found without comparing all pairs of a large bucket: texts with the same words are
one vertex, and for large buckets an exact filter on prefixes tells which pairs can be links at all. Shingles that many of their texts have are
*common*, the others *rare*. With rare shingles ordered before common ones, a pair of similarity 0.8 has a rare shingle in common among the
first ninth of the lighter text's weight and the first fifth of the heavier one's, or none at all. The first kind meets by these rare shingles, of which
each is in few texts. The second kind has in common at most what both have of the common shingles, summed over groups of them. In every large
bucket those with the largest part of common shingles, its *pivots*, are compared first, as all others are likely linked to them; the
rest of both kinds is compared if the two are not in one class by then.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portflow.llm.common import ROW, binary_parts, mix64, slices, stored, text_or_empty, with_row, word_hashes

WORDS = 5
SIMILARITY = 0.8
BANDS = 12
BAND_ROWS = 4
# The inverse document frequency counts for this part of a weight; the rest is the same for all shingles. With it, texts
# whose common part is shared by a large group still count as near copies of one another.
IDF_SHARE = 0.15
# Shares of documents below this have the full inverse frequency, and so have shingles beyond the most frequent ones that
# fit the bound on the broadcast.
RARE_SHARE = 0.001
MAX_FREQUENT = 2_000_000
BATCH_BYTES = 2 << 20
FLUSH_SHINGLES = 1 << 22
RANGE_BYTES = 12 << 20
COUNT_BITS = 40
VECTOR_BITS = 48
BROADCAST_ROWS = 1 << 20
# A large bucket's members meet so many pivots in the first round, and so many times more in the second. Buckets of at
# most twice the pivots have all their pairs compared, which costs no more.
PIVOTS = 6
PIVOT_GROWTH = 4
# Shingles that so many texts of large buckets have are common; their weights are summed in so many groups.
COMMON_TEXTS = 20
GROUPS = 16
RANGE_ENTRIES = 1 << 18
# Bounds on weights give way by this part for rounding.
SLACK = 1e-5


def shingles(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct shingle hashes of each text in ascending order, how often each occurs, where each text's start, and two
    hashes of each text's sequence of words. A text of fewer than five words has one shingle of all its words."""
    words, first, _ = word_hashes(raw, bounds)
    n, counts = len(bounds) - 1, np.diff(first)
    place = np.arange(len(words)) - np.repeat(first[:-1], counts)
    left = np.repeat(counts, counts) - place
    padded = np.concatenate([words, np.zeros(WORDS, np.uint64)])
    total = np.zeros(len(words), np.uint64)
    for k in range(WORDS):
        part = np.where(left > k, padded[k : k + len(words)], np.uint64(0))
        total = mix64(total * np.uint64(0x9E3779B97F4A7C15) + part)
    owner = np.repeat(np.arange(n), counts)
    keep = (left >= WORDS) | (place == 0)
    hashes, owners = total[keep], owner[keep]
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    at = np.flatnonzero(new)
    times = np.diff(at, append=len(hashes))
    signs = []
    for salt in (1, 2):
        weights = mix64(place.astype(np.uint64) * np.uint64(2) + np.uint64(salt))
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mix64(words ^ np.uint64(salt)) * weights, out=sums[1:])
        signs.append(mix64(sums[first[1:]] - sums[first[:-1]] + counts.astype(np.uint64)))
    return hashes[at], times, np.searchsorted(owners[at], np.arange(n + 1)), signs[0], signs[1]


def _batches(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, bounds = binary_parts(column)
    for lo, hi in slices(np.diff(bounds), BATCH_BYTES):
        yield lo, hi, raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]


def _packed(values: np.ndarray, extra: np.ndarray) -> bytes:
    """Ascending integers, as differences, and 32-bit values for them; bytes of one kind lie together."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    others = np.ascontiguousarray(extra).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(gaps.tobytes() + others.tobytes())


def _unpacked(data: bytes, kind: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = len(raw) // 12
    gaps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view("<u8")[:, 0]
    return np.cumsum(gaps, dtype=np.uint64), np.ascontiguousarray(raw[8 * n :].reshape(4, n).T).view(kind)[:, 0]


def _of_texts(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for _, _, raw, bounds in _batches(batch.column(1)):
        yield shingles(raw, bounds)[0] >> np.uint64(64 - COUNT_BITS)


def _of_vectors(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for data in batch.column(1).to_pylist():
        yield _unpacked(data, "<f4")[0] >> np.uint64(VECTOR_BITS - COUNT_BITS)


def frequent_shingles(
    texts: DataFrame, least: float, n_ranges: int, of: Callable[[pa.RecordBatch], Iterator[np.ndarray]] = _of_texts
) -> DataFrame:
    """(shingle, n) of the shingles, by the first ``COUNT_BITS`` bits of their hashes, that ``least`` texts or more have."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            owner = (found * np.uint64(n_ranges)) >> np.uint64(COUNT_BITS)
            edges = np.searchsorted(owner, np.arange(n_ranges + 1))
            for k in range(n_ranges):
                lo, hi = edges[k], edges[k + 1]
                if hi > lo:
                    data = _packed(found[lo:hi], counts[lo:hi].astype("<u4"))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([data], pa.binary())], ["part", "data"]
                    )

        with np.errstate(over="ignore"):
            size = 0
            for batch in batches:
                for found in of(batch):
                    held.append(found)
                    size += len(found)
                    if size >= FLUSH_SHINGLES:
                        yield from flush()
                        size = 0
            if size:
                yield from flush()

    def total(table: pa.Table) -> pa.Table:
        parts = [_unpacked(data, "<u4") for data in table.column("data").to_pylist()]
        values, group = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        counts = np.bincount(group, np.concatenate([p[1] for p in parts]), len(values)).astype(np.int64)
        some = counts >= least
        return pa.table({"shingle": values[some].astype(np.int64), "n": counts[some]})

    sent = texts.mapInArrow(send, "part int, data binary")
    return sent.groupBy("part").applyInArrow(total, "shingle long, n long")


@dataclass(frozen=True)
class Weights:
    """Shingle weights: 1 for rare ones, less for the frequent ones, listed by ascending hash."""

    frequent: np.ndarray
    weights: np.ndarray

    def of(self, hashes: np.ndarray, times: np.ndarray) -> np.ndarray:
        factor = np.ones(len(hashes), np.float32)
        if len(self.frequent):
            short = hashes >> np.uint64(64 - COUNT_BITS)
            at = np.minimum(np.searchsorted(self.frequent, short), len(self.frequent) - 1)
            found = self.frequent[at] == short
            factor[found] = self.weights[at[found]]
        return factor * times.astype(np.float32)


def shingle_weights(texts: DataFrame) -> Weights:
    """Weights from the document frequencies over all ``texts`` (row, data).

    A text of b bytes has at most b / 2 + 1 words, so at most (bytes / 2 + texts) / least shingles occur in ``least``
    texts or more; ``least`` keeps that number below ``MAX_FREQUENT``.
    """
    seen = texts.agg(F.count(F.lit(1)), F.sum(F.octet_length("data"))).first()
    n_texts, n_bytes = seen[0], seen[1] or 0
    if not n_texts:
        return Weights(np.zeros(0, np.uint64), np.zeros(0, np.float32))
    least = max(1.0, RARE_SHARE * n_texts, (n_bytes / 2 + n_texts) / MAX_FREQUENT)
    found = frequent_shingles(texts, least, max(1, -(-n_bytes // RANGE_BYTES))).toArrow().sort_by("shingle")
    share = found.column("n").to_numpy() / n_texts
    rare = min(RARE_SHARE, 0.5) if least <= RARE_SHARE * n_texts or least <= 1 else min(least / n_texts, 0.5)
    idf = np.clip(np.log(1 / np.maximum(share, 1e-12)) / np.log(1 / rare), 0, 1)
    values = (1 - IDF_SHARE + IDF_SHARE * idf).astype(np.float32)
    return Weights(found.column("shingle").to_numpy().astype(np.uint64), values)


class Sampler:
    """Improved consistent weighted sampling.

    For hash function i and shingle k the method needs r and c, drawn from Gamma(2, 1), and b, uniform, as functions of (i, k).
    They come from tables of 2**16 draws, indexed by a hash of (i, k).
    """

    def __init__(self, n: int, seed: int = 42):
        random = np.random.default_rng(seed)
        size = 1 << 16
        self.rate = random.gamma(2.0, 1.0, size).astype(np.float32)
        self.log_c = np.log(random.gamma(2.0, 1.0, size)).astype(np.float32)
        self.shift = random.random(size).astype(np.float32)
        self.salts = mix64(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)

    def draws(self, hashes: np.ndarray, weights: np.ndarray, first: np.ndarray) -> np.ndarray:
        """One row per hash function, one column per text that has shingles."""
        filled = np.flatnonzero(np.diff(first))
        starts, counts = first[filled], np.diff(first)[filled]
        owner = np.repeat(np.arange(len(filled)), counts)
        log_weight = np.log(weights)
        out = np.zeros((len(self.salts), len(filled)), np.uint64)
        for i, salt in enumerate(self.salts):
            draw = (hashes * salt) >> np.uint64(48)
            rate, shift = self.rate[draw], self.shift[draw]
            level = np.floor(log_weight / rate + shift)
            value = self.log_c[draw] - rate * (level - shift + 1)
            least = np.minimum.reduceat(value, starts)
            at = np.flatnonzero(value == least[owner])
            at = at[np.concatenate(([True], owner[at][1:] != owner[at][:-1]))]
            out[i] = mix64(hashes[at] ^ mix64(level[at].astype(np.int64).view(np.uint64) + salt))
        return out


def signatures(texts: DataFrame, weights: Weights) -> DataFrame:
    """(row, sign_1, sign_2, bands) of every text with words; equal signs mean the same sequence of words."""
    shared = texts.sparkSession.sparkContext.broadcast(weights)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(BANDS * BAND_ROWS)
        with np.errstate(over="ignore"):
            for batch in batches:
                rows = batch.column(0).to_numpy()
                for lo, hi, raw, bounds in _batches(batch.column(1)):
                    hashes, times, first, one, two = shingles(raw, bounds)
                    filled = np.flatnonzero(np.diff(first))
                    if not len(filled):
                        continue
                    draws = sampler.draws(hashes, shared.value.of(hashes, times), first)
                    bands = np.zeros((len(filled), BANDS), np.uint64)
                    for k in range(BANDS):
                        key = np.full(len(filled), np.uint64(k), np.uint64)
                        for draw in draws[k * BAND_ROWS : (k + 1) * BAND_ROWS]:
                            key = mix64(key * np.uint64(31) ^ draw)
                        bands[:, k] = key
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.arange(len(filled) + 1) * BANDS, pa.int32()), pa.array(bands.ravel().view(np.int64))
                    )
                    signs = [pa.array(x[filled].view(np.int64)) for x in (one, two)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[lo:hi][filled]), *signs, lists], [ROW, "sign_1", "sign_2", "bands"]
                    )

    return texts.mapInArrow(sign, f"{ROW} long, sign_1 long, sign_2 long, bands array<long>")


def vectors(texts: DataFrame, weights: Weights) -> DataFrame:
    """(id, vector, n): the weighted shingles of every text, packed, and how many these are."""
    shared = texts.sparkSession.sparkContext.broadcast(weights)
    drop = np.uint64(64 - VECTOR_BITS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for lo, hi, raw, bounds in _batches(batch.column(1)):
                    hashes, times, first, _, _ = shingles(raw, bounds)
                    values = shared.value.of(hashes, times).astype("<f4")
                    packed = [_packed(hashes[a:b] >> drop, values[a:b]) for a, b in zip(first[:-1], first[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(lo, hi - lo), pa.array(packed, pa.binary()), pa.array(np.diff(first).astype(np.int32))],
                        ["id", "vector", "n"],
                    )

    return texts.mapInArrow(build, "id long, vector binary, n int")


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    both = a[0][at] == b[0]
    common = float(np.minimum(a[1][at[both]], b[1][both]).sum(dtype=np.float64))
    total = float(a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64))
    return common / (total - common) if total > common else 1.0


def similarities(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """Add ``similarity`` to distinct pairs (a, b); ``a`` is the one that occurs in many pairs."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            found = []
            for one, two in zip(batch.column(2), batch.column(3)):
                one = one.as_py()
                if one != last:
                    last, left = one, _unpacked(one, "<f4")
                found.append(weighted_jaccard(left, _unpacked(two.as_py(), "<f4")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64())], ["a", "b", "similarity"]
            )

    with_b = pairs.join(table.select(F.col("id").alias("b"), F.col("vector").alias("vector_b")), "b")
    both = with_b.join(table.select(F.col("id").alias("a"), F.col("vector").alias("vector_a")), "a")
    return both.select("a", "b", "vector_a", "vector_b").mapInArrow(compare, "a long, b long, similarity double")


def components(links: DataFrame) -> DataFrame:
    """(id, class) for every id of the links (a, b): the smallest id of its connected component.

    Every round each id takes the smallest class among its neighbours, then the class of its class.
    """
    edges = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    classes = stored(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("class")))
    while True:
        near = (
            edges.join(classes.withColumnsRenamed({"id": "b", "class": "near"}), "b").groupBy("a").agg(F.min("near").alias("near"))
        )
        closer = stored(
            classes.join(near, F.col("id") == F.col("a"))
            .select("id", F.col("class").alias("old"), F.least("class", "near").alias("class"))
        )
        jumped = closer.select("id", "old", "class").join(
            closer.select(F.col("id").alias("class"), F.col("class").alias("further")), "class"
        )
        classes = stored(jumped.select("id", F.least("class", "further").alias("class"), "old"))
        if classes.where("class <> old").isEmpty():
            return classes.select("id", "class")
        classes = classes.select("id", "class")


def _classes_of(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with their class; an id without links is a class of its own."""
    classes = components(links)
    return members.join(classes, "id", "left").withColumn("class", F.coalesce("class", "id"))


def _is_in(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which values are among ``found``, which ascend."""
    if not len(found):
        return np.zeros(len(values), bool)
    return found[np.minimum(np.searchsorted(found, values), len(found) - 1)] == values


class Overlaps:
    """Which pairs of texts, given by their ``table`` of vectors, can be links.

    The vectors are those of texts in large buckets. A shingle is common if ``COMMON_TEXTS`` of them or more have it. That number is
    raised where the common shingles would be more than ``MAX_FREQUENT``.
    """

    def __init__(self, table: DataFrame):
        self.table = table
        entries = table.agg(F.sum("n")).first()[0] or 0
        self.n_ranges = max(1, -(-entries // RANGE_ENTRIES))
        least = max(COMMON_TEXTS, entries / MAX_FREQUENT)
        found = frequent_shingles(table.select("id", "vector"), least, self.n_ranges, _of_vectors)
        common = np.sort(found.select("shingle").toArrow().column(0).to_numpy().astype(np.uint64))
        self.common = table.sparkSession.sparkContext.broadcast(common)

    def profiles(self) -> DataFrame:
        """(id, total, base, g0, g1, ...): the weight of all shingles, of the common ones, and of these by groups."""
        shared, names = self.common, [f"g{k}" for k in range(GROUPS)]

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                total, sums = np.zeros(len(batch)), np.zeros((GROUPS, len(batch)))
                for i, data in enumerate(batch.column(1).to_pylist()):
                    keys, weights = _unpacked(data, "<f4")
                    some = _is_in(keys >> np.uint64(VECTOR_BITS - COUNT_BITS), shared.value)
                    total[i] = weights.sum(dtype=np.float64)
                    sums[:, i] = np.bincount((keys[some] % np.uint64(GROUPS)).astype(np.int64), weights[some], GROUPS)
                columns = [batch.column(0), pa.array(total), pa.array(sums.sum(axis=0)), *[pa.array(x.astype(np.float32)) for x in sums]]
                yield pa.RecordBatch.from_arrays(columns, ["id", "total", "base", *names])

        schema = "id long, total double, base double, " + ", ".join(f"{name} float" for name in names)
        return self.table.select("id", "vector").mapInArrow(build, schema)

    def rare_pairs(self) -> DataFrame:
        """Pairs (x, y) that have a rare shingle in common where a link with one must have one.

        In a link the lighter text has in common with the other at least 2 s / (1 + s) of its weight, s being the least similarity, and the
        heavier one at least s of its. If they have rare shingles in common, the first in the order of hashes has at least
        that much weight, common shingles with it, from it onwards in either.
        """
        shared, n_ranges = self.common, self.n_ranges

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple[np.ndarray, ...]] = []

            def flush() -> Iterator[pa.RecordBatch]:
                keys, ids, totals, light = (np.concatenate(column) for column in zip(*held))
                held.clear()
                order = np.argsort(keys, kind="stable")
                owner = (keys[order] * np.uint64(n_ranges)) >> np.uint64(VECTOR_BITS)
                edges = np.flatnonzero(np.diff(owner.astype(np.int64), prepend=-1))
                for lo, hi in zip(edges, np.append(edges[1:], len(order))):
                    part = order[lo:hi]
                    raw = b"".join(column[part].tobytes() for column in (keys, ids, totals, light))
                    data = zstandard.ZstdCompressor(level=1).compress(raw)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(owner[lo])], pa.int32()), pa.array([data], pa.binary())], ["part", "data"]
                    )

            size = 0
            for batch in batches:
                for id_, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    keys, weights = _unpacked(data, "<f4")
                    rare = ~_is_in(keys >> np.uint64(VECTOR_BITS - COUNT_BITS), shared.value)
                    keys, total = keys[rare], weights.sum(dtype=np.float64)
                    rest = total - np.cumsum(weights[rare], dtype=np.float64) + weights[rare]
                    heavy = rest >= SIMILARITY * total * (1 - SLACK)
                    light = rest >= 2 * SIMILARITY / (1 + SIMILARITY) * total * (1 - SLACK)
                    n = np.count_nonzero(heavy)
                    held.append((keys[heavy], np.full(n, id_, np.int64), np.full(n, total, np.float32), light[heavy].astype(np.uint8)))
                    size += n
                    if size >= FLUSH_SHINGLES:
                        yield from flush()
                        size = 0
            if size:
                yield from flush()

        def match(table: pa.Table) -> pa.Table:
            parts = []
            for data in table.column("data").to_pylist():
                raw = zstandard.ZstdDecompressor().decompress(data)
                n = len(raw) // 21
                kinds = (("<u8", 0), ("<i8", 8 * n), ("<f4", 16 * n), ("u1", 20 * n))
                parts.append([np.frombuffer(raw, kind, n, at) for kind, at in kinds])
            keys, ids, totals, light = (np.concatenate(column) for column in zip(*parts))
            order = np.lexsort((ids, totals, keys))
            keys, ids, totals, light = keys[order], ids[order], totals[order], light[order]
            found = [np.zeros((0, 2), np.int64)]
            step, left = 0, np.flatnonzero(light)
            while len(left):
                step += 1
                left = left[left + step < len(keys)]
                near = totals[left] >= SIMILARITY * totals[left + step] * (1 - SLACK)
                left = left[(keys[left + step] == keys[left]) & near]
                found.append(np.unique(np.stack([ids[left], ids[left + step]], axis=1), axis=0))
            pairs = np.unique(np.concatenate(found), axis=0)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            return pa.table({"x": pairs[:, 0], "y": pairs[:, 1]})

        sent = self.table.select("id", "vector").mapInArrow(send, "part int, data binary")
        return sent.groupBy("part").applyInArrow(match, "x long, y long")


def _common_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (x, y) of one bucket and two classes whose common shingles alone can make a link."""
    names = ["total", "base", *[f"g{k}" for k in range(GROUPS)]]
    one = left.select("key", F.col("id").alias("x"), F.col("class").alias("class_x"), *[F.col(name).alias(f"x_{name}") for name in names])
    two = right.select("key", F.col("id").alias("y"), F.col("class").alias("class_y"), *[F.col(name).alias(f"y_{name}") for name in names])
    need = (F.col("x_total") + F.col("y_total")) * (SIMILARITY / (1 + SIMILARITY) * (1 - SLACK))
    least = [F.least(f"x_{name}", f"y_{name}").cast("double") for name in names]
    possible = (F.col("class_x") != F.col("class_y")) & (least[1] >= need) & (sum(least[3:], least[2]) >= need)
    return one.join(two, "key").where(possible).select("x", "y")


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` (id, class), each named by its smallest id, with those joined that links (a, b) connect."""
    ends = links.join(classes.select(F.col("id").alias("a"), F.col("class").alias("one")), "a")
    ends = ends.join(classes.select(F.col("id").alias("b"), F.col("class").alias("two")), "b").where("one <> two")
    found = components(ends.select(F.col("one").alias("a"), F.col("two").alias("b")))
    named = classes.join(found.select(F.col("id").alias("class"), F.col("class").alias("further")), "class", "left")
    return stored(named.select("id", F.coalesce("further", "class").alias("class")))


def linked_classes(signed: DataFrame, table_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(id, class) of the ids that share a band with others; ``signed`` is (id, bands), one row per distinct text."""
    band = signed.select("id", F.explode("bands").alias("key"))
    shared = band.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    active = stored(band.join(shared, "key").select("key", "id", "n"))
    table = table_of(active.select("id").distinct())
    compared: list[DataFrame] = []

    def new_links(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
        for before in compared:
            pairs = pairs.join(before.select("a", "b"), ["a", "b"], "left_anti")
        compared.append(stored(similarities(pairs, table)))
        return compared[-1].where(F.col("similarity") >= SIMILARITY).select("a", "b")

    small = active.where(F.col("n") <= 2 * PIVOTS)
    other = small.select("key", F.col("id").alias("y"))
    pairs = small.select("key", F.col("id").alias("x")).join(other, "key").where("x < y").select("x", "y")
    large = active.where(F.col("n") > 2 * PIVOTS).select("key", "id")
    if large.isEmpty():
        return _classes_of(table.select("id"), new_links(pairs)).select("id", "class")
    ids = stored(large.select("id").distinct())
    overlaps = Overlaps(stored(table.join(ids, "id", "left_semi")))
    base_part = F.col("base") / F.col("total")
    based = overlaps.profiles().where(base_part >= SIMILARITY * (1 - SLACK))
    members = stored(large.join(stored(based), "id"))

    def with_pivots(placed: DataFrame, wanted: int) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc(base_part), "id"))
        return _common_pairs(stored(placed.withColumn("rank", rank).where(F.col("rank") <= wanted).drop("rank")), placed)

    first = with_pivots(members.withColumn("class", F.col("id")), PIVOTS)
    classes = stored(_classes_of(table.select("id"), new_links(first.unionByName(pairs))).select("id", "class"))
    classes = _merged(classes, new_links(with_pivots(stored(members.join(classes, "id")), PIVOTS * PIVOT_GROWTH)))
    placed = stored(members.join(classes, "id"))
    # A pair of two classes has one that is not in the bucket's largest.
    sizes = placed.groupBy("key", "class").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("key").agg(F.max_by("class", F.struct("size", "class")).alias("largest"))
    others = stored(placed.join(largest, "key").where("class <> largest").drop("largest"))
    rare = overlaps.rare_pairs().distinct()
    for end in ("x", "y"):
        known = classes.join(signed, "id")
        rare = rare.join(known.select(F.col("id").alias(end), F.col("class").alias(f"class_{end}"), F.col("bands").alias(f"bands_{end}")), end)
    rare = rare.where((F.col("class_x") != F.col("class_y")) & F.arrays_overlap("bands_x", "bands_y")).select("x", "y")
    return _merged(classes, new_links(_common_pairs(others, placed).unionByName(rare)))


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, class_id, class_size, kept) for every row of ``docs``.

    Words are runs of letters and digits, in lower case. class_id is the smallest id of the class and its row stays; a null id comes
    last, and of rows with equal ids one stays. Texts without words, null among them, are classes of their own.
    An empty table gives no rows. Other columns have no influence.
    """
    rows = with_row(docs)
    data = F.lower(text_or_empty(text)).cast("binary").alias("data")
    texts = rows.select(ROW, data)
    weights = shingle_weights(texts)
    signed = stored(signatures(texts, weights))
    first = stored(signed.groupBy("sign_1", "sign_2").agg(F.min(ROW).alias("id"), F.any_value("bands").alias("bands")))

    def table_of(ids: DataFrame) -> DataFrame:
        ids = stored(ids.select(F.col("id").alias(ROW)))
        few = ids.count() <= BROADCAST_ROWS
        return stored(vectors(texts.join(F.broadcast(ids) if few else ids, ROW, "left_semi"), weights))

    linked = linked_classes(first.select("id", "bands"), table_of)
    classes = first.select("id", "sign_1", "sign_2").join(linked, "id", "left")
    classes = classes.select("sign_1", "sign_2", F.coalesce("class", "id").alias("class"))
    grouped = signed.select(ROW, "sign_1", "sign_2").join(classes, ["sign_1", "sign_2"]).select(ROW, "class")
    ids = rows.select(ROW, F.col(doc_id).alias("doc_id"))
    # A text without words is a class of its own; its number cannot clash, as classes are named by their members.
    judged = stored(ids.join(grouped, ROW, "left").withColumn("class", F.coalesce("class", ROW)))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", ROW)).alias("best")
    kept = stored(judged.groupBy("class").agg(best, F.count(F.lit(1)).alias("class_size")))
    return judged.join(kept, "class").select(
        ROW,
        "doc_id",
        F.col("best.doc_id").alias("class_id"),
        "class_size",
        (F.col(f"best.{ROW}") == F.col(ROW)).alias("kept"),
    )


def without_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class, all columns kept."""
    kept = near_classes(docs, doc_id, text).where("kept").select(ROW)
    return with_row(docs).join(kept, ROW, "left_semi").drop(ROW)
