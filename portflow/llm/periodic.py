"""Periodic runs of words: stretches in which words a fixed distance apart are identical.

Every text is worked on by itself, whole, in the task that reads it; no text is shuffled. Its suffixes are ordered by
prefix doubling, and neighbours in that order know how many first words they share. Then, as in Kruskal's
algorithm, classes of suffixes are united by descending shared length: a union-find whose classes are ordered sets of
positions, the smaller one going into the larger. Where a union makes positions i < j neighbours, they share
exactly ``shared`` words; if their distance is at most that, words i ... j + shared - 1 repeat with period j - i. The period
is the smallest one, as a position at a smaller one would lie between them. The run is reported by its leftmost
pair only. Pairs that share fewer words than half of the shortest run can't start one, so suffixes whose first words are unique
in their text, nearly all of an ordinary one, never reach the union-find.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.llm.common import slices

MIN_WORDS = 12
# Text worked on at once, unless one text is longer.
BATCH_BYTES = 4 << 20
BLOCK = 1024

RUN_TYPE = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Positions:
    """An ordered set of positions, in blocks, so that an insertion moves few of them."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, position: int) -> None:
        self.blocks, self.firsts, self.size = [[position]], [position], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def insert(self, position: int) -> tuple[int, int]:
        """Add a position; returns its neighbours, -1 where there is none."""
        blocks = self.blocks
        at = max(bisect_right(self.firsts, position) - 1, 0) if len(blocks) > 1 else 0
        block = blocks[at]
        place = bisect_left(block, position)
        before = block[place - 1] if place else (blocks[at - 1][-1] if at else -1)
        after = block[place] if place < len(block) else (self.firsts[at + 1] if at + 1 < len(blocks) else -1)
        block.insert(place, position)
        if not place:
            self.firsts[at] = position
        self.size += 1
        if len(block) > BLOCK:
            blocks[at : at + 1] = [block[: BLOCK // 2], block[BLOCK // 2 :]]
            self.firsts.insert(at + 1, block[BLOCK // 2])
        return before, after


def ranks_by_width(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of all positions by their first 1, 2, 4, ... words, until no two are equal; one more rank, -1, ends each array.

    ``ids`` number the words from 0 without gaps. Only positions that are still tied are sorted again.
    """
    n = len(ids)
    sizes = np.bincount(ids)
    rank = np.full(n + 1, -1, np.int64)
    rank[:n] = (np.cumsum(sizes) - sizes)[ids]
    tied = np.flatnonzero(sizes[ids] > 1)
    levels, width = [rank], 1
    while len(tied):
        key = rank[tied] * (n + 1) + rank[np.minimum(tied + width, n)] + 1
        order = np.argsort(key)
        tied, key = tied[order], key[order]
        old = rank[tied]
        place = np.arange(len(tied))
        starts = np.append(True, key[1:] != key[:-1])
        class_start = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), place, 0))
        rank = rank.copy()
        rank[tied] = old + np.maximum.accumulate(np.where(starts, place, 0)) - class_start
        levels.append(rank)
        sizes = np.diff(np.append(np.flatnonzero(starts), len(tied)))
        tied = tied[np.repeat(sizes > 1, sizes)]
        width *= 2
    return levels


def neighbours(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions that are next to each other in suffix order and share ``least`` words or more, with the number of shared words."""
    levels = ranks_by_width(ids)
    near = least.bit_length() - 1
    if len(levels) <= near:
        return (np.zeros(0, np.int64),) * 3
    order = np.empty(len(ids), np.int64)
    order[levels[-1][:-1]] = np.arange(len(ids))
    left, right = order[:-1], order[1:]
    alike = levels[near][left] == levels[near][right]
    left, right = left[alike], right[alike]
    shared = np.zeros(len(left), np.int64)
    for i in range(len(levels) - 1, -1, -1):
        shared += (levels[i][left + shared] == levels[i][right + shared]).astype(np.int64) << i
    enough = shared >= least
    return left[enough], right[enough], shared[enough]


def find_runs(ids: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``min_words`` words or more and at least two periods, in no order.

    Word numbers run from 0 without gaps. Several texts may be concatenated if they share no numbers.
    """
    left, right, shared = neighbours(ids, max((min_words + 1) // 2, 1))
    falling = np.argsort(-shared, kind="stable")
    owner: dict[int, int] = {}
    classes: dict[int, Positions] = {}
    found = []

    def root(position: int) -> int:
        above = owner.setdefault(position, position)
        while above != position:
            owner[position] = position = owner[above]
            above = owner[position]
        return position

    def seed(i: int, j: int, common: int) -> None:
        period = j - i
        if period <= common and period + common >= min_words and (not i or ids[i - 1] != ids[j - 1]):
            found.append((i, period + common, period))

    for a, b, common in zip(left[falling].tolist(), right[falling].tolist(), shared[falling].tolist()):
        a, b = root(a), root(b)
        into = classes.pop(a, None) or Positions(a)
        other = classes.pop(b, None) or Positions(b)
        if into.size < other.size:
            into, other, a, b = other, into, b, a
        joining = list(other)
        previous = -1
        for position, following in zip(joining, [*joining[1:], -1]):
            before, after = into.insert(position)
            # Neighbours from the same class were neighbours before.
            if before > previous:
                seed(before, position, common)
            if after >= 0 and (following < 0 or after < following):
                seed(position, after, common)
            previous = position
        owner[b] = a
        classes[a] = into
    return found


def _runs_of(texts: list[bytes], min_words: int) -> Iterator[tuple[int, list[dict], bytes]]:
    """(number of words, runs by start and period, text without the repeats) of every text."""
    number = count()
    words, ids, bounds = [], [], [0]
    for text in texts:
        parts = text.split()
        words.append(parts)
        ids.extend(map(defaultdict(number.__next__).__getitem__, parts))
        bounds.append(len(ids))
    runs = sorted(find_runs(np.array(ids, np.int64), min_words), key=lambda run: (run[0], run[2])) if ids else []
    owners = np.searchsorted(bounds, [run[0] for run in runs], side="right") - 1
    per_text = defaultdict(list)
    for owner, run in zip(owners.tolist(), runs):
        per_text[owner].append(run)
    for i, parts in enumerate(words):
        mine = [(start - bounds[i], length, period) for start, length, period in per_text.get(i, ())]
        if mine:
            steps = np.zeros(len(parts) + 1, np.int64)
            spans = np.array(mine)
            np.add.at(steps, spans[:, 0] + spans[:, 2], 1)
            np.add.at(steps, spans[:, 0] + spans[:, 1], -1)
            kept = np.cumsum(steps[:-1]) == 0
            parts = [word for word, keep in zip(parts, kept.tolist()) if keep]
        found = [{"start": start, "length": length, "period": period} for start, length, period in mine]
        yield bounds[i + 1] - bounds[i], found, b" ".join(parts)


def periodic_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs``.

    Words are separated by ASCII white space and numbered from 0. A run is a longest stretch with a smallest period q, of at least
    two periods and ``min_words`` words. ``collapsed`` is the text, joined by single spaces, without the words that any run
    holds after its first q. Null counts as the empty text, which has no words and no runs. Repeated ids and rows give a row
    each; a null id stays null. An empty table gives no rows. Other columns, whatever their names, have no
    influence. A text's words are in one task's memory, about 300 bytes a word.
    """
    if min_words < 2:
        raise ValueError("a run has two words at least")
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    schema = f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, n_words long, runs {RUN_TYPE}, collapsed binary"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(value) for value in (x.as_buffer() for x in batch["text"])], np.int64)
            for start, stop in slices(sizes, BATCH_BYTES):
                part = batch.slice(start, stop - start)
                rows = list(_runs_of(part["text"].to_pylist(), min_words))
                columns = [
                    part["doc_id"],
                    pa.array([row[0] for row in rows], pa.int64()),
                    pa.array([row[1] for row in rows], pa.list_(_RUN)),
                    pa.array([row[2] for row in rows], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return chosen.mapInArrow(scan, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def longest_run() -> F.Column:
    """Of the column ``runs``: the longest run, of equally long ones the first, then the one with the smallest period."""
    ranked = F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"], r.alias("run")))
    return F.array_min(ranked)["run"]
