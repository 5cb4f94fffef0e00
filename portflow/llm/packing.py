"""Packing token sequences by minimum bin slack.

Every document's tokens are cut into full windows of the capacity and one remainder. Remainders are packed by
their lengths alone: a histogram, at most one counter per length below the capacity, is all the planner sees, at
any size of the input. The planner fills one window at a time: the longest remaining length is fixed, a bitset
subset-sum over the remaining multiset finds the fill closest to the capacity, and backtracking gives
the counts of each length. The same filling is used as often as the counts allow, so every step uses up at least
one length for good and a plan has few patterns. The documents then find their places by joining their rank
within their length to the patterns.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portflow.llm.common import ROW, flat_ranges, id_hash_mod, mix64, stored, text_or_empty, with_row

CAPACITY = 1024
TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
SEGMENT_CHARS = 1 << 18
# Two halves of that many pieces below 32 characters: an executor's workers hold one such cache each.
CACHED_PIECES = 1 << 17
FILLERS = 8
# Fixed: how this vocabulary's texts are cut into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# White space outside the general categories' separators: Unicode's White_Space property, as code points.
WHITE_SPACE = [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
LETTER, NUMBER, OTHER, SPACE, END = range(5)
END_CODE = sys.maxunicode + 1


def code_classes() -> np.ndarray:
    """The kind of every code point; END_CODE, which is none, ends a text."""
    kinds = {"L": LETTER, "N": NUMBER}
    found = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(END_CODE)), np.uint8, END_CODE)
    found[WHITE_SPACE] = SPACE
    return np.append(found, np.uint8(END))


def _piece_starts(codes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of byte-level BPE start in texts that each end with END_CODE.

    They are runs of letters, digits, other characters or white space. A run takes a single space before it along; only the
    last of several white-space characters can be that one. A lone apostrophe takes s, t, m, d, re, ve or ll after it.
    """
    n = len(codes)
    fresh = np.ones(n, bool)
    fresh[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == END)
    starts = fresh.copy()
    white = kinds == SPACE
    starts[1:] &= ~(fresh[1:] & (codes[:-1] == 32) & (kinds[1:] != END))
    starts[:-1] |= white[:-1] & ~white[1:] & (kinds[1:] != END)
    quotes = np.flatnonzero((codes[:-1] == 39) & starts[:-1] & fresh[:-1] & (kinds[1:] == LETTER))
    if len(quotes):
        padded = np.append(codes, [END_CODE, END_CODE])
        one, two = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l")))
        for chosen, size in ((quotes[short], 2), (quotes[long], 3)):
            starts[chosen + 1] = False
            after = chosen[chosen + size < n] + size
            starts[after] |= kinds[after] == LETTER
    return np.flatnonzero(starts)


class PieceTokenizer:
    """A byte-level BPE tokenizer that encodes each distinct pre-token once per group of texts.

    Byte-level BPE never joins symbols across pre-tokens, so the ids of a text are those of its pre-tokens in
    turn. Pre-tokens are found for many texts at a time and told apart by a hash that is then checked by content.
    With ``added_tokens`` the file's added tokens have ids of their own wherever they stand in a text; else they are
    plain characters.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        import tiktoken

        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(moved)}
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {token["content"]: token["id"] for token in model.get("added_tokens", [])}
        self.added = special if added_tokens else {}
        # At one place the longest one counts.
        self.marks = re.compile("|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        vocabulary = model["model"]["vocab"]
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        self.encode_piece = tiktoken.Encoding(
            "byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.kinds = code_classes()
        self.powers = mix64(np.arange(1, 1 << 12, dtype=np.uint64)) | np.uint64(1)
        # Pieces met again while they are in the older half are kept; the others go when the newer half is full.
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, piece: str) -> bytes:
        """The ids of a piece that is not in the cache's newer half."""
        found = self.older.get(piece)
        if found is None:
            found = array("I", self.encode_piece(piece)).tobytes()
        if len(piece) < 32:
            if len(self.cache) >= CACHED_PIECES:
                self.older, self.cache = self.cache, {}
            self.cache[piece] = found
        return found

    def encode(self, texts: list[str], last: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts in a row, each followed by the end id (``last``), and where each text's ids end."""
        joined = "".join(texts)
        raw = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes + 1) - 1
        codes = np.full(len(raw) + len(texts), END_CODE, np.int32)
        keep = np.ones(len(codes), bool)
        keep[ends] = False
        codes[keep] = raw
        starts = _piece_starts(codes, self.kinds[codes])
        lengths = np.diff(starts, append=len(codes))
        with np.errstate(over="ignore"):
            place = np.arange(len(codes), dtype=np.int32)
            place -= np.repeat(starts.astype(np.int32), lengths)
            values = self.powers[np.minimum(place, len(self.powers) - 1, out=place)]
            values *= (codes + 1).astype(np.uint64)
            prints = np.add.reduceat(values, starts)
            del place, values
            prints = mix64(prints ^ (lengths.astype(np.uint64) << np.uint64(40)))
        _, first, group = np.unique(prints, return_index=True, return_inverse=True)
        # The pieces follow one another without gaps.
        same = codes == codes[flat_ranges(starts[first][group], lengths)]
        odd = np.flatnonzero((lengths != lengths[first][group]) | ~np.logical_and.reduceat(same, np.cumsum(lengths) - lengths))
        if len(odd):
            group[odd] = len(first) + np.arange(len(odd))
            first = np.append(first, odd)
        # Places in the joined text: every text before adds one end mark.
        begin = starts[first]
        begin = begin - np.searchsorted(ends, begin)
        closing = codes[starts[first]] == END_CODE
        pieces = (joined[a : a + size] for a, size in zip(begin.tolist(), lengths[first].tolist()))
        end_ids = END_ID.to_bytes(4, "little") if last else b""
        coded = [
            end_ids if closes else self.cache.get(piece) or self._ids(piece) for piece, closes in zip(pieces, closing.tolist())
        ]
        counts = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        begins = np.cumsum(counts) - counts
        ids = np.frombuffer(b"".join(coded), "<u4")[flat_ranges(begins[group], counts[group])]
        return ids, np.cumsum(counts[group])[np.searchsorted(starts, ends)]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _segments(text: str) -> Iterator[str]:
    """Parts of a long text. A cut lies before a single space between other characters: no pre-token spans it."""
    start, n = 0, len(text)
    while n - start > SEGMENT_CHARS:
        cut = text.find(" ", start + SEGMENT_CHARS)
        while cut > 0 and (cut + 1 >= n or text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def _encoded(encoder: PieceTokenizer, texts: Iterator[str]) -> Iterator[tuple[bytes, bool]]:
    """The ids of the texts in parts, and whether a part ends its text."""
    group, size = [], 0
    for text in texts:
        marks = list(encoder.marks.finditer(text)) if encoder.added else []
        if group and (marks or size + len(text) > SEGMENT_CHARS):
            yield from _whole(encoder, group)
            group, size = [], 0
        begin = 0
        for mark in marks:
            # What stands before an added token is cut into pre-tokens like a text that ends there.
            for part in _segments(text[begin : mark.start()]):
                yield encoder.encode([part], last=False)[0].tobytes(), False
            yield encoder.added[mark.group()].to_bytes(4, "little"), False
            begin = mark.end()
        text = text[begin:]
        if len(text) > SEGMENT_CHARS:
            *parts, end = _segments(text)
            for part in parts:
                yield encoder.encode([part], last=False)[0].tobytes(), False
            text = end
        group.append(text)
        size += len(text)
    yield from _whole(encoder, group)


def _whole(encoder: PieceTokenizer, texts: list[str]) -> Iterator[tuple[bytes, bool]]:
    if texts:
        ids, ends = encoder.encode(texts)
        view, begin = memoryview(ids.tobytes()), 0
        for end in (4 * ends).tolist():
            yield bytes(view[begin:end]), True
            begin = end


def _cut(parts: Iterator[tuple[bytes, bool]], capacity: int, fine: list[bool]) -> Iterator[tuple[list, int]]:
    """Per text, (start, length, crc32) of each piece and the number of tokens; holds one window and one part."""
    window, rest, start, found, done = 4 * capacity, b"", 0, [], 0
    for part, ends in parts:
        rest += part
        view, whole = memoryview(rest), len(rest) - len(rest) % window
        for i in range(0, whole, window):
            found.append((start, capacity, zlib.crc32(view[i : i + window])))
            start += capacity
        rest = rest[whole:]
        if ends:
            if fine[done]:
                found.extend(_binary(rest, start))
            elif rest:
                found.append((start, len(rest) // 4, zlib.crc32(rest)))
            yield found, start + len(rest) // 4
            rest, start, found, done = b"", 0, [], done + 1


def _binary(rest: bytes, start: int) -> Iterator[tuple[int, int, int]]:
    """A remainder in pieces whose lengths are powers of two, the longest first."""
    at, left = 0, len(rest) // 4
    while left:
        length = 1 << (left.bit_length() - 1)
        yield start + at, length, zlib.crc32(rest[4 * at : 4 * (at + length)])
        at, left = at + length, left - length


PIECES = pa.schema(
    [(ROW, pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64())]
    + [("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
)


def token_pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    added_tokens: bool = False,
) -> DataFrame:
    """Cut the tokens of every document, with the end id, into full windows and a remainder.

    The remainders of one document in ``FILLERS``, by a hash of the id, are cut into powers of two: small pieces that let
    the other windows be filled. ``tokenizer`` is the path of the vocabulary file; by default each
    executor finds it in the installed package. ``added_tokens``: see :class:`PieceTokenizer`.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceTokenizer(tokenizer or tokenizer_path(), added_tokens)
        for batch in batches:
            rows = []
            keys = zip(*(batch.column(i).to_pylist() for i in range(3)))
            parts = _encoded(encoder, (x.as_py() for x in batch.column(3)))
            for (row, key, _), (found, total) in zip(keys, _cut(parts, capacity, batch.column(2).to_pylist())):
                rows.extend((row, key, *piece, total) for piece in found)
            columns = zip(*rows) if rows else [()] * len(PIECES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, PIECES.types)], schema=PIECES)

    fine = id_hash_mod(doc_id, FILLERS) == 0
    rows = with_row(docs).select(
        ROW, F.col(doc_id).cast("long").alias("doc_id"), fine.alias("fine"), text_or_empty(text).alias("text")
    )
    schema = f"{ROW} long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return rows.mapInArrow(cut, schema)


@dataclass(frozen=True)
class Pattern:
    """A filling that is used for ``times`` windows: (length, copies) pairs."""

    times: int
    counts: tuple[tuple[int, int], ...]


def _fill(seed: int, lengths: list[int], left: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset with ``seed`` whose sum comes closest to the capacity, by bitset subset-sum."""
    room = capacity - seed
    mask = (1 << (room + 1)) - 1
    reached, history = 1, []
    for length in lengths:
        copies = min(left[length] - (length == seed), room // length)
        # Copies in binary portions: any count up to ``copies`` is a sum of some of them.
        portion = 1
        while copies > 0:
            portion = min(portion, copies)
            history.append((length, portion, reached))
            reached |= (reached << (length * portion)) & mask
            copies -= portion
            portion *= 2
        if reached >> room & 1:
            break
    total, used = reached.bit_length() - 1, {seed: 1}
    for length, portion, before in reversed(history):
        if not before >> total & 1:
            total -= length * portion
            used[length] = used.get(length, 0) + portion
    return used


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Windows for the given numbers of remainders per length."""
    left = {length: count for length, count in sorted(histogram.items(), reverse=True) if count > 0}
    patterns = []
    while left:
        lengths = list(left)
        used = _fill(lengths[0], lengths, left, capacity)
        times = min(left[length] // copies for length, copies in used.items())
        patterns.append(Pattern(times, tuple(sorted(used.items(), reverse=True))))
        for length, copies in used.items():
            left[length] -= copies * times
            if not left[length]:
                del left[length]
    return patterns


def _places(spark: SparkSession, patterns: list[Pattern]) -> DataFrame:
    """Which ranks of a length go to which windows and offsets; bounded by the patterns of one histogram."""
    rows, taken, window = [], {}, 0
    for pattern in patterns:
        offset = 0
        for length, copies in pattern.counts:
            first = taken.get(length, 0)
            taken[length] = first + copies * pattern.times
            rows.append((length, first, taken[length], copies, window, offset))
            offset += length * copies
        window += pattern.times
    schema = "length long, first long, past long, copies long, window long, base long"
    return spark.createDataFrame(rows, schema)


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    added_tokens: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null counts as the empty text, whose only token is the end id. Rows with equal or null ids are documents of
    their own. An empty table gives no rows. Other columns have no influence. Sequences hold whole pieces; ids
    are dense: windows of remainders first, then windows filled by one piece.
    """
    spark = docs.sparkSession
    pieces = token_pieces(docs, doc_id, text, capacity, tokenizer, added_tokens)
    pieces = stored(pieces.withColumn("place", F.monotonically_increasing_id()))
    rests = pieces.where(F.col("length") < capacity)
    histogram = {length: n for length, n in rests.groupBy("length").count().collect()}
    patterns = plan(histogram, capacity)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    # Ranks in two steps: within the rows one task wrote, then over tasks. One common length is no hot spot.
    part = F.shiftright("place", 33)
    counts = rests.groupBy("length", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    local = F.row_number().over(Window.partitionBy("length", "part").orderBy("place")) - 1
    ranked = (
        rests.withColumn("part", part)
        .join(counts.select("length", "part", before.alias("before")), ["length", "part"])
        .withColumn("rank", F.col("before") + local)
    )
    places = _places(spark, patterns)
    inside = (F.col("r.length") == F.col("p.length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past"))
    nth = F.col("rank") - F.col("first")
    mixed = (
        ranked.alias("r")
        .join(F.broadcast(places).alias("p"), inside)
        .select(
            *[F.col(f"r.{name}") for name in columns],
            (F.col("window") + F.floor(nth / F.col("copies"))).alias("sequence_id"),
            (F.col("base") + nth % F.col("copies") * F.col("r.length")).alias("offset"),
        )
    )
    n_mixed = sum(pattern.times for pattern in patterns)
    full = pieces.where(F.col("length") == capacity)
    full_part = full.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    full_before = full_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    full_local = F.row_number().over(Window.partitionBy("part").orderBy("place")) - 1
    alone = (
        full.withColumn("part", part)
        .join(full_before, "part")
        .select(*columns, (n_mixed + F.col("before") + full_local).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    )
    return mixed.unionByName(alone)
