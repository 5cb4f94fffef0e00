"""Removing long passages that earlier documents hold, with a logarithmic family of sorted fingerprints.

A suffix matters here only by its first ``length`` bytes, its *window*. Windows are dealt to key ranges by the smallest
hash of the 8-byte strings inside them, so equal windows always meet, and neighbouring windows
mostly share that key: they travel as one string that covers them all. Within a key range, documents arrive in
the order of their ids, in batches. Each batch sorts its windows' fingerprints and finds them by binary search
in the sorted arrays of the levels that exist already, in the task's memory. Then it becomes a level itself, and while the last level
is no larger than the one after it, the two merge. So a window is merged a logarithmic number of times.

Windows are sorted by a 46-bit fingerprint of their bytes instead of lexicographically; for matches of the whole window any
order serves. Every match is checked byte by byte, and fingerprints that two different windows share are settled by content.

A string that occurs again in the same map task's chunk, in a later document, is known to be covered without asking; only
the occurrence in the smallest document is sent. So copies that hold a third of all rows shrink to one
per chunk before the shuffle. The number of key ranges follows the input's size, but a key is never split: the range of a
very frequent 8-byte string grows with the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.llm.common import ROW, binary_parts, flat_ranges, mix64, text_or_empty, with_row

LENGTH = 50
GRAM = 8
RANGE_BYTES = 2 << 20
FLUSH_BYTES = 16 << 20
CHUNK_BYTES = 1 << 20
# Fingerprints leave room for a window's place in its batch.
PLACE_BITS = 18
PRINT_BITS = 64 - PLACE_BITS
BATCH_WINDOWS = 1 << PLACE_BITS
SEEN_BITS = 24
BUNDLE_ROWS = 32
ZSTD_LEVEL = 6
NO_ID = np.iinfo(np.int64).max

_MULTIPLIERS = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def _words(raw: np.ndarray) -> np.ndarray:
    """Entry i holds bytes i to i + 7 as one integer."""
    return np.lib.stride_tricks.as_strided(raw.view(np.uint8), (max(0, len(raw) - 7), 8), (1, 1)).view("<u8")[:, 0]


def _hashes(raw: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each string of ``length`` (8 or more) bytes."""
    total = _words(raw) * _MULTIPLIERS[0]
    total ^= total >> np.uint64(32)
    reach, k = GRAM, 1
    while reach < length:
        step = min(reach, length - reach)
        joined = total[: len(total) - step] * _MULTIPLIERS[k]
        joined ^= total[step:]
        joined ^= joined >> np.uint64(32)
        total, reach, k = joined, reach + step, k + 1
    return mix64(total)


def _prints(raw: np.ndarray, length: int, bits: int) -> np.ndarray:
    """Fingerprints of ``bits`` bits; their last ``PLACE_BITS`` bits are free."""
    return (_hashes(raw, length) & np.uint64((1 << bits) - 1)) << np.uint64(PLACE_BITS)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if width > reach else values


class _Runs:
    """Strings of windows with one key, gathered for one flush: key, document, place and bytes of each."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, row: int, doc: int, text: np.ndarray, length: int) -> None:
        """The runs of one document; a long one is read in overlapping chunks."""
        for begin in range(0, max(0, len(text) - length + 1), CHUNK_BYTES):
            raw = text[begin : begin + CHUNK_BYTES + length - 1]
            grams = _hashes(raw, GRAM)
            keys = _sliding_min(grams, length - GRAM + 1)
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            sizes = np.diff(starts, append=len(keys)) + length - 1
            # The sum of a run's 8-byte strings tells it well enough, as equal prints are checked.
            sums = np.zeros(len(grams) + 1, np.uint64)
            np.cumsum(grams, out=sums[1:])
            print_ = sums[starts + sizes - GRAM + 1] - sums[starts]
            same = np.full(len(starts), row, np.int64), np.full(len(starts), doc, np.int64)
            body = raw[flat_ranges(starts, sizes)]
            self.parts.append((keys[starts], print_, *same, starts + begin, sizes, body))
            self.size += len(raw)

    def take(self) -> tuple[np.ndarray, ...]:
        joined = tuple(np.concatenate(column) for column in zip(*self.parts))
        self.parts, self.size = [], 0
        return joined


def _repeats(prints: np.ndarray, docs: np.ndarray, sizes: np.ndarray, body: np.ndarray) -> np.ndarray:
    """Which runs equal a run of a smaller document; equal prints are checked byte by byte."""
    order = np.lexsort((docs, sizes, prints))
    new = np.empty(len(order), bool)
    new[:1] = True
    new[1:] = (prints[order][1:] != prints[order][:-1]) | (sizes[order][1:] != sizes[order][:-1])
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = docs[order] > docs[first]
    mine, other = order[later], first[later]
    repeated = np.zeros(len(docs), bool)
    if len(mine):
        begins = np.cumsum(sizes) - sizes
        same = body[flat_ranges(begins[mine], sizes[mine])] == body[flat_ranges(begins[other], sizes[mine])]
        ends = np.cumsum(sizes[mine])
        repeated[mine] = np.logical_and.reduceat(same, ends - sizes[mine])
    return repeated


def _joined_spans(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Merge spans, in order of row and start, that touch or overlap."""
    if not len(rows):
        return rows, starts, ends
    order = np.lexsort((starts, rows))
    rows, starts, ends = rows[order], starts[order], ends[order]
    new_row = np.concatenate(([True], rows[1:] != rows[:-1]))
    # Ends so far, counted per row: shift each row beyond all ends of the row before.
    shift = np.cumsum(new_row) * (int(ends.max()) + 1)
    reach = np.maximum.accumulate(ends + shift)
    new = new_row.copy()
    new[1:] |= starts[1:] + shift[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return rows[at], starts[at], np.maximum.reduceat(ends, at)


def _planes(values: np.ndarray) -> bytes:
    """Integers as their first bytes, their second bytes, and so on: bytes of one kind compress together."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(raw: bytes, n: int, at: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, at).reshape(8, n).T).view("<i8")[:, 0]


def _packed(steps: list[np.ndarray], plain: list[np.ndarray], body: np.ndarray) -> bytes:
    """Columns of integers, ``steps`` as differences from row to row, and bytes, compressed."""
    parts = [_planes(np.diff(x, prepend=0)) for x in steps] + [_planes(x) for x in plain]
    return zstandard.ZstdCompressor(level=ZSTD_LEVEL).compress(b"".join([*parts, body.tobytes()]))


def _unpacked(data: bytes, n: int, steps: int, plain: int) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    columns = [_from_planes(raw, n, 8 * n * k) for k in range(steps + plain)]
    columns[:steps] = [np.cumsum(x) for x in columns[:steps]]
    return [*columns, np.frombuffer(raw, np.uint8, offset=8 * n * (steps + plain))]


_SHIP = [("bucket", pa.int32()), ("kind", pa.int8()), ("n", pa.int32()), ("data", pa.binary())]
_SPANS = [(ROW, pa.int64()), ("from", pa.int64()), ("to", pa.int64())]


def _ship(runs: _Runs, buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    """One compressed row per key range, and the spans that are settled already."""
    keys, prints, rows, docs, places, sizes, body = runs.take()
    repeated = _repeats(prints, docs, sizes, body)
    out: list[tuple] = []
    known = _joined_spans(rows[repeated], places[repeated], (places + sizes)[repeated])
    if len(known[0]):
        data = _packed([known[0]], [*known[1:]], np.zeros(0, np.uint8))
        out.append((int(mix64(rows[:1].astype(np.uint64))[0] % np.uint64(buckets)), 1, len(known[0]), data))
    owner = (mix64(keys) % np.uint64(buckets)).astype(np.int32)
    # Runs come by rows and places, which a stable sort keeps; it takes linear time for 16-bit integers.
    order = np.argsort(owner.astype(np.uint16) if buckets <= 1 << 16 else owner, kind="stable")
    order = order[~repeated[order]]
    begins = np.cumsum(sizes) - sizes
    edges = np.flatnonzero(np.diff(owner[order], prepend=-1))
    size = 0
    for lo, hi in zip(edges, np.append(edges[1:], len(order))):
        chosen = order[lo:hi]
        text = body[flat_ranges(begins[chosen], sizes[chosen])]
        data = _packed([rows[chosen], docs[chosen]], [places[chosen], sizes[chosen]], text)
        out.append((int(owner[chosen[0]]), 0, len(chosen), data))
        size += len(data)
        if size > 8 << 20:
            yield _batch(out)
            out, size = [], 0
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(column, kind) for column, (_, kind) in zip(zip(*rows), _SHIP)]
    return pa.RecordBatch.from_arrays(columns, schema=pa.schema(_SHIP))


class _Levels:
    """The index family of a key range: sorted (fingerprint, smallest document, place of its window)."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        # Whether a fingerprint with these first bits is in some level; most are not and need no search.
        self.seen = np.zeros(1 << SEEN_BITS, bool)

    def find(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The document and place of each fingerprint, -1 where no level has it. ``prints`` are sorted."""
        place = np.full(len(prints), -1, np.int64)
        docs = np.zeros(len(prints), np.int64)
        maybe = np.flatnonzero(self.seen[prints >> np.uint64(64 - SEEN_BITS)])
        prints = prints[maybe]
        for known, owners, places in self.levels:
            at = np.minimum(np.searchsorted(known, prints), len(known) - 1)
            hit = known[at] == prints
            place[maybe[hit]], docs[maybe[hit]] = places[at[hit]], owners[at[hit]]
        return docs, place

    def add(self, level: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.seen[level[0] >> np.uint64(64 - SEEN_BITS)] = True
        self.levels.append(level)
        while len(self.levels) > 1 and len(self.levels[-1][0]) >= len(self.levels[-2][0]):
            pair = [np.concatenate(column) for column in zip(self.levels[-2], self.levels[-1])]
            order = np.argsort(pair[0], kind="stable")
            self.levels[-2:] = [tuple(column[order] for column in pair)]


def covered_windows(
    docs: np.ndarray, sizes: np.ndarray, body: np.ndarray, length: int, bits: int = PRINT_BITS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For runs in order of their documents: each window's run, its place in the run, and whether a smaller
    document has it. Fewer ``bits`` make shorter fingerprints, for tests."""
    begins = np.cumsum(sizes) - sizes
    counts = sizes - length + 1
    levels = _Levels()
    views = np.lib.stride_tricks.as_strided(body, (max(0, len(body) - length + 1), length), (1, 1))
    edges = np.concatenate(([0], np.cumsum(counts)))
    covered = np.zeros(int(edges[-1]), bool)
    shared: list[np.ndarray] = []
    run = 0
    while run < len(docs):
        past = max(run + 1, int(np.searchsorted(edges, edges[run] + BATCH_WINDOWS, "right")) - 1)
        region = body[begins[run] : begins[past - 1] + sizes[past - 1]]
        starts = flat_ranges(begins[run:past], counts[run:past])
        prints = _prints(region, length, bits)[starts - begins[run]]
        owner = np.repeat(docs[run:past], counts[run:past])
        if len(prints) <= 1 << PLACE_BITS:
            # Each with its place in one integer: sorting these is faster than sorting places by fingerprint.
            prints |= np.arange(len(prints), dtype=np.uint64)
            prints.sort()
            order = (prints & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
            ordered = prints ^ order.astype(np.uint64)
        else:
            order = np.argsort(prints, kind="stable")
            ordered = prints[order]
        new = np.empty(len(order), bool)
        new[:1] = True
        new[1:] = ordered[1:] != ordered[:-1]
        heads = order[new]
        known, place = levels.find(ordered[new])
        old = place >= 0
        known[~old], place[~old] = owner[heads[~old]], starts[heads[~old]]
        # Most windows are the first with their fingerprint and need no more.
        again = ~new
        again[np.flatnonzero(new)[old]] = True
        group = (np.cumsum(new) - 1)[again]
        window, print_ = order[again], ordered[again]
        mine, first = starts[window], place[group]
        differ = np.zeros(len(window), bool)
        for lo in range(0, len(window), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            differ[part] = (views[mine[part]] != views[first[part]]).any(axis=1)
        if differ.any():
            shared.append(np.unique(print_[differ]))
        covered[edges[run] + window] = owner[window] > known[group]
        if not old.all():
            levels.add((ordered[new][~old], known[~old], place[~old]))
        run = past
    index = np.repeat(np.arange(len(docs)), counts)
    offset = np.arange(int(edges[-1])) - edges[index]
    if shared:
        _settle(np.unique(np.concatenate(shared)), docs, begins, index, offset, views, body, length, bits, covered)
    return index, offset, covered


def _settle(shared, docs, begins, index, offset, views, body, length, bits, covered) -> None:
    """Decide windows whose fingerprint stands for several contents by the contents."""
    starts = begins[index] + offset
    prints = _prints(body, length, bits)[starts]
    unsure = np.flatnonzero(np.isin(prints, shared))
    smallest: dict[bytes, int] = {}
    for i in unsure.tolist():
        key, doc = views[starts[i]].tobytes(), int(docs[index[i]])
        smallest[key] = min(doc, smallest.get(key, doc))
    for i in unsure.tolist():
        covered[i] = docs[index[i]] > smallest[views[starts[i]].tobytes()]


def _scan_range(table: pa.Table, length: int) -> pa.Table:
    """All matches within one key range, as spans."""
    parts, spans = [], []
    for kind, n, data in zip(*(table.column(c).to_pylist() for c in ("kind", "n", "data"))):
        if kind:
            spans.append(tuple(_unpacked(data, n, 1, 2)[:3]))
        else:
            parts.append(_unpacked(data, n, 2, 2))
    if parts:
        rows, docs, places, sizes, body = (np.concatenate(column) for column in zip(*parts))
        del parts
        order = np.lexsort((places, rows, docs))
        body = body[flat_ranges((np.cumsum(sizes) - sizes)[order], sizes[order])]
        rows, docs, places, sizes = rows[order], docs[order], places[order], sizes[order]
        run, offset, covered = covered_windows(docs, sizes, body, length)
        before = np.concatenate(([False], covered[:-1])) & (offset > 0)
        heads = np.flatnonzero(covered & ~before)
        tails = np.flatnonzero(covered & ~np.concatenate((covered[1:] & (offset[1:] > 0), [False])))
        spans.append((rows[run[heads]], places[run[heads]] + offset[heads], places[run[tails]] + offset[tails] + length))
    merged = _joined_spans(*(np.concatenate(c) for c in zip(*spans))) if spans else [[], [], []]
    return pa.table([pa.array(c, pa.int64()) for c in merged], schema=pa.schema(_SPANS))


def repeated_spans(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    range_bytes: int = RANGE_BYTES,
    flush_bytes: int = FLUSH_BYTES,
) -> DataFrame:
    """(row, from, to): byte spans covered by ``length``-byte strings that start in a document with a smaller id.

    Spans of one row may touch or overlap. Rows with equal ids do not match one another; a null id counts as larger
    than any other, and as equal to null. Texts shorter than ``length`` bytes, empty ones and null have no spans.
    """
    size = docs.agg(F.sum(F.octet_length(text_or_empty(text)))).first()[0] or 0
    buckets = max(1, -(-size // range_bytes))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs()
        with np.errstate(over="ignore"):
            for batch in batches:
                raw, bounds = binary_parts(batch.column(2))
                for i, (row, doc) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                    runs.add(row, NO_ID if doc is None else doc, raw[bounds[i] : bounds[i + 1]], length)
                    if runs.size >= flush_bytes:
                        yield from _ship(runs, buckets, length)
            if runs.parts:
                yield from _ship(runs, buckets, length)

    def scan(table: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            return _scan_range(table, length)

    rows = with_row(docs).select(ROW, F.col(doc_id).cast("long").alias("doc"), text_or_empty(text).cast("binary"))
    sent = rows.mapInArrow(send, "bucket int, kind byte, n int, data binary")
    return sent.groupBy("bucket").applyInArrow(scan, f"{ROW} long, `from` long, `to` long")


_KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _bundles(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Neighbouring rows in one compressed bundle each: their texts are to be shuffled once more."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            docs = batch.column(1).fill_null(NO_ID).to_numpy()
            raw, bounds = binary_parts(batch.column(2))
            edges = np.flatnonzero(np.diff(rows // BUNDLE_ROWS, prepend=-1))
            for lo, hi in zip(edges, np.append(edges[1:], len(rows))):
                data = _packed([rows[lo:hi], docs[lo:hi]], [np.diff(bounds[lo : hi + 1])], raw[bounds[lo] : bounds[hi]])
                columns = [[int(rows[lo]) // BUNDLE_ROWS], [int(hi - lo)], [data]]
                kinds = [pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "n", "data"])

    rows = with_row(docs).select(ROW, F.col(doc_id).cast("long").alias("doc"), text_or_empty(text).cast("binary"))
    return rows.mapInArrow(bundle, "part long, n int, data binary")


_KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _without(text: bytes, spans: list[tuple[int, int]], digest_only: bool) -> tuple:
    """Sizes, digest and rest of a text without the spans, which are sorted but may overlap."""
    view, digest, kept = memoryview(text), hashlib.sha256(), []
    removed = n_spans = at = 0
    end = -1
    for lo, hi in spans:
        if lo > end:
            n_spans += 1
            digest.update(view[at:lo])
            kept.append(view[at:lo])
            removed += hi - lo
            at = end = hi
        elif hi > end:
            removed += hi - end
            at = end = hi
    digest.update(view[at:])
    kept.append(view[at:])
    return len(text), removed, n_spans, digest.hexdigest(), None if digest_only else b"".join(kept)


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, digest_only: bool = False, **options
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the bytes that are ``kept``.

    A cut can fall inside a character, so the kept text is binary. ``digest_only`` leaves it null.
    """
    spans = repeated_spans(docs, doc_id, text, length, **options)
    gathered = spans.groupBy(F.floor(F.col(ROW) / BUNDLE_ROWS).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct(ROW, "from", "to"))).alias("spans")
    )
    joined = _bundles(docs, doc_id, text).join(gathered.hint("shuffle_hash"), "part", "left").select("n", "data", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, data, found in zip(*(batch.column(i) for i in range(3))):
                rows, docs, sizes, raw = _unpacked(data.as_py(), n.as_py(), 2, 1)
                spans: dict[int, list[tuple[int, int]]] = {}
                for span in found.as_py() or ():
                    spans.setdefault(span[ROW], []).append((span["from"], span["to"]))
                ends, out = np.cumsum(sizes), []
                for row, doc, a, b in zip(rows.tolist(), docs.tolist(), (ends - sizes).tolist(), ends.tolist()):
                    found_here = _without(raw[a:b].tobytes(), spans.get(row, []), digest_only)
                    out.append((None if doc == NO_ID else doc, *found_here))
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return joined.mapInArrow(cut, _KEPT)
