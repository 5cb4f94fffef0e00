"""How the sources of a language differ in their words, by chunk factorization.

A chunk is what stands between white space. Every task counts the chunks of each document it reads and combines them per chunk, so
a frequent chunk leaves a task as one row. Rows meet by chunk, where each globally distinct chunk is cut into terms once, however
often it occurs, and its terms are joined back to its counts: occurrences per source, and the number of documents of each language.

Occurrences of a term add up over its chunks. Documents do not, as one may hold several chunks of a term; but they only matter up
to the threshold of kept terms. So a chunk in fewer documents than that keeps their numbers, and a term's documents are counted
exactly where neither the sum over its chunks nor its most frequent chunk decides. Smoothed shares of kept terms are then
compared in integers: each task sums up the differences between all sources over its terms and keeps its largest rises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portflow.llm.common import LOWER, binary_parts, flat_ranges, slices, stored

MIN_DOCS = 30
TOP_TERMS = 50
# Added to every count, and what shares are multiplied with.
SMOOTHING = 5
SCALE = 1_000_000_000

# Bytes of terms, ASCII letters and all of characters beyond ASCII, and of chunks, all but white space.
TERM_BYTE = np.zeros(256, bool)
TERM_BYTE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
CHUNK_BYTE = np.ones(256, bool)
CHUNK_BYTE[[32, *range(9, 14)]] = False

# Text that is split at once, unless one document is longer; different (document, chunk) pairs a task combines at once; rows
# it hands over at once; sources that one row block compares with all others; cells of the matrices of differences a task holds.
BATCH_BYTES = 2 << 20
PAIRS = 1 << 21
ROWS = 1 << 14
SIDE = 512
CELLS = 1 << 22

GROUP = ["lang", "source"]


def byte_runs(raw: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The longest runs of bytes that ``table`` marks, in every one of the concatenated texts, and how many each text has."""
    n = len(raw)
    inside = table[raw]
    before = np.zeros(n + 1, bool)
    before[1:] = inside
    before[bounds[:-1]] = False
    starts = np.flatnonzero(inside & ~before[:n])
    place = np.cumsum(inside, dtype=np.int32)
    data = raw[inside]
    offsets = np.append(place[starts] - 1, len(data)).astype(np.int32)
    runs = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return runs, np.diff(np.searchsorted(starts, bounds))


def _places(sizes: np.ndarray) -> np.ndarray:
    """Where each of consecutive pieces starts."""
    return np.cumsum(sizes) - sizes


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Indexes at which any of the columns changes."""
    changed = np.zeros(max(len(columns[0]) - 1, 0), bool)
    for column in columns:
        changed |= column[1:] != column[:-1]
    return np.flatnonzero(np.append(True, changed)) if len(columns[0]) else np.zeros(0, np.int64)


def _lengths(starts: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.append(starts, total))


def _pairs(raw: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The different chunks of some documents; and for each (chunk, document) pair both, and how often it occurs."""
    chunks, per_doc = byte_runs(raw, bounds, CHUNK_BYTE)
    coded = chunks.dictionary_encode()
    key = coded.indices.to_numpy().astype(np.int64) * len(per_doc) + np.repeat(np.arange(len(per_doc)), per_doc)
    key.sort()
    first = _starts(key)
    chunk, doc = np.divmod(key[first], max(len(per_doc), 1))
    return coded.dictionary, chunk.astype(np.int32), doc.astype(np.int32), _lengths(first, len(key)).astype(np.int32)


def _combined(
    pieces: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]], langs: np.ndarray, places: np.ndarray, min_docs: int
) -> tuple[pa.Array, pa.Array]:
    """The different chunks of some pieces of :func:`_pairs`, and a payload of integers for each.

    A payload holds the number of its groups, for each of them language, place, occurrences and documents, and then, group
    after group, the numbers of the documents of every group with fewer than ``min_docs``.
    """
    names = pa.concat_arrays([piece[0] for piece in pieces]).dictionary_encode()
    codes = names.indices.to_numpy()
    offsets = np.append(0, np.cumsum([len(piece[0]) for piece in pieces]))
    chunk = np.concatenate([codes[piece[1] + offset] for piece, offset in zip(pieces, offsets)])
    doc = np.concatenate([piece[2] for piece in pieces])
    times = np.concatenate([piece[3] for piece in pieces])
    order = np.lexsort((doc, places[doc], langs[doc], chunk))
    chunk, doc, times = chunk[order], doc[order], times[order]
    lang, place = langs[doc], places[doc]

    segment = _starts(chunk, lang, place)
    n_docs = _lengths(segment, len(chunk))
    listed = np.where(n_docs < min_docs, n_docs, 0)
    of_chunk = _starts(chunk[segment])
    groups = _lengths(of_chunk, len(segment))
    sizes = 1 + 4 * groups + (np.add.reduceat(listed, of_chunk) if len(of_chunk) else groups)
    starts = _places(sizes)
    payload = np.empty(int(sizes.sum()), np.int32)
    payload[starts] = groups
    heads = np.repeat(starts + 1, groups) + 4 * flat_ranges(np.zeros(len(groups), np.int64), groups)
    payload[heads] = lang[segment]
    payload[heads + 1] = place[segment]
    payload[heads + 2] = np.add.reduceat(times, segment) if len(segment) else 0
    payload[heads + 3] = n_docs
    so_far = _places(listed)
    payload[flat_ranges(np.repeat(starts + 1 + 4 * groups - so_far[of_chunk], groups) + so_far, listed)] = doc[flat_ranges(segment, listed)]
    ends = np.append(0, np.cumsum(sizes * 4)).astype(np.int32)
    packed = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(payload)])
    return names.dictionary, packed


def _chunk_rows(rows: DataFrame, min_docs: int) -> DataFrame:
    """(chunk, base, payload): per task, how often a chunk occurs where; ``base`` plus a listed number is a document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        pieces, langs, places = [], [], []

        def flushed() -> Iterator[pa.RecordBatch]:
            chunks, payload = _combined(pieces, np.concatenate(langs), np.concatenate(places), min_docs)
            bases = pa.array(np.full(len(chunks), base), pa.int64())
            whole = pa.RecordBatch.from_arrays([chunks, bases, payload], ["chunk", "base", "payload"])
            for start in range(0, len(whole), ROWS):
                yield whole.slice(start, ROWS)

        for batch in batches:
            _, bounds = binary_parts(batch["text"])
            for start, stop in slices(np.diff(bounds), BATCH_BYTES):
                part = batch.slice(start, stop - start)
                names, chunk, doc, times = _pairs(*binary_parts(part["text"]))
                pieces.append((names, chunk, doc + np.int32(sum(map(len, langs))), times))
                langs.append(part["lang_no"].to_numpy())
                places.append(part["place"].to_numpy())
                if sum(len(piece[1]) for piece in pieces) >= PAIRS:
                    yield from flushed()
                    base += sum(map(len, langs))
                    pieces, langs, places = [], [], []
        if pieces:
            yield from flushed()

    return rows.mapInArrow(scan, "chunk binary, base long, payload binary")


def _terms_of(chunk: pa.Array, bases: np.ndarray, payload: pa.Array, min_docs: int) -> pa.RecordBatch:
    """Cut each different chunk into terms, and give each the sums over the chunk's rows, per language."""
    coded = chunk.dictionary_encode()
    raw, bounds = binary_parts(payload)
    values = np.frombuffer(raw.tobytes(), np.int32)
    starts = bounds[:-1] // 4
    groups = values[starts].astype(np.int64)
    heads = np.repeat(starts + 1, groups) + 4 * flat_ranges(np.zeros(len(groups), np.int64), groups)
    row = np.repeat(np.arange(len(groups)), groups)
    code = coded.indices.to_numpy().astype(np.int64)[row]
    lang, place, times, n_docs = (values[heads + i].astype(np.int64) for i in range(4))
    listed = np.where(n_docs < min_docs, n_docs, 0)
    so_far = _places(listed)
    first_of_row = _starts(row)
    at = np.repeat(starts + 1 + 4 * groups - so_far[first_of_row], groups) + so_far

    order = np.lexsort((place, lang, code))
    code, lang, place, times, n_docs, listed, at, row = (x[order] for x in (code, lang, place, times, n_docs, listed, at, row))
    cell = _starts(code, lang, place)
    cell_times, cell_place = np.add.reduceat(times, cell), place[cell]
    group = _starts(code, lang)
    group_docs, group_lang = np.add.reduceat(n_docs, group), lang[group]
    in_group = _lengths(group, len(code))
    # Beyond the threshold the documents' numbers are of no use.
    listed = np.where(np.repeat(group_docs < min_docs, in_group), listed, 0)
    docs = values[flat_ranges(at, listed)] + np.repeat(bases[row], listed)
    docs_in, cells_in = np.add.reduceat(listed, group), _lengths(np.searchsorted(cell, group), len(cell))
    docs_at, cells_at = _places(docs_in), _places(cells_in)
    of_chunk = _starts(code[group])
    langs_in = _lengths(of_chunk, len(group))

    raw, bounds = binary_parts(coded.dictionary)
    terms, per_chunk = byte_runs(LOWER[raw], bounds, TERM_BYTE)
    named = terms.dictionary_encode()
    key = np.repeat(np.arange(len(per_chunk)), per_chunk) * max(len(named.dictionary), 1) + named.indices.to_numpy()
    key.sort()
    once = _starts(key)
    owner, name = np.divmod(key[once], max(len(named.dictionary), 1))

    copies = langs_in[owner]
    term = np.repeat(np.arange(len(owner)), copies)
    found = flat_ranges(of_chunk[owner], copies)
    n_listed, n_cells = docs_in[found], cells_in[found]
    cells = flat_ranges(cells_at[found], n_cells)
    counts = pa.StructArray.from_arrays(
        [
            pa.array(cell_place[cells], pa.int32()),
            pa.array(cell_times[cells] * np.repeat(_lengths(once, len(key))[term], n_cells), pa.int64()),
        ],
        ["place", "occurrences"],
    )
    columns = [
        pa.array(group_lang[found], pa.int32()),
        named.dictionary.take(pa.array(name[term])),
        pa.array(group_docs[found], pa.int64()),
        _listed(pa.array(docs[flat_ranges(docs_at[found], n_listed)], pa.int64()), n_listed),
        _listed(counts, n_cells),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang_no", "term", "n_docs", "docs", "counts"])


def _listed(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), values)


def _chunk_terms(chunks: DataFrame, min_docs: int) -> DataFrame:
    """(lang_no, term, n_docs, docs, counts), a row per language, chunk and different term of the chunk.

    Every chunk's rows are next to each other in one task, and the chunk is cut into terms once.
    """
    schema = "lang_no int, term binary, n_docs long, docs array<long>, counts array<struct<place: int, occurrences: bigint>>"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flushed(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(rows).combine_chunks()
            if table.num_rows:
                (batch,) = table.to_batches()
                yield _terms_of(batch["chunk"], batch["base"].to_numpy(), batch["payload"], min_docs)

        for batch in batches:
            if not len(batch):
                continue
            # A batch may end within the rows of a chunk: its last chunk waits for the next one.
            last = batch["chunk"][len(batch) - 1].as_py()
            codes = batch["chunk"].dictionary_encode().indices.to_numpy()
            cut = int(np.searchsorted(codes, codes[-1]))
            if held and held[0]["chunk"][0].as_py() == last and not cut:
                held.append(batch)
                continue
            yield from flushed([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        if held:
            yield from flushed(held)

    met = chunks.repartition("chunk").sortWithinPartitions("chunk")
    return met.mapInArrow(scan, schema)


def _kept_terms(found: DataFrame, min_docs: int) -> DataFrame:
    """(lang_no, term) of the terms in ``min_docs`` documents of the language or more."""
    key = ["lang_no", "term"]
    bounds = stored(
        found.groupBy(*key).agg(F.max("n_docs").alias("most"), F.sum("n_docs").alias("total")).where(F.col("total") >= min_docs)
    )
    open_terms = bounds.where(F.col("most") < min_docs).select(*key)
    counted = found.join(open_terms, key, "left_semi").select(*key, F.explode("docs").alias("doc"))
    exact = counted.groupBy(*key).agg(F.count_distinct("doc").alias("n")).where(F.col("n") >= min_docs)
    return bounds.where(F.col("most") >= min_docs).select(*key).unionByName(exact.select(*key))


def term_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS
) -> tuple[DataFrame, DataFrame]:
    """Two stored tables: groups (lang, source, lang_no, place) and counts (lang_no, term, counts).

    Groups are all pairs that occur, even without a term; ``place`` is the source's among those of its language, from 1. There is
    one row per kept term of a language, with its occurrences by place where there are any. The window numbers
    distinct pairs, not documents; the audit compares every two of a language, so its result outgrows their number by far.
    """
    rows = docs.select(
        F.coalesce(F.col(lang), F.lit("")).alias("lang"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    groups = stored(
        rows.select(*GROUP).distinct().select(
            *GROUP,
            F.dense_rank().over(Window.orderBy("lang")).alias("lang_no"),
            F.row_number().over(Window.partitionBy("lang").orderBy("source")).alias("place"),
        )
    )
    numbered = rows.join(groups, GROUP).select("lang_no", "place", "text")
    found = stored(_chunk_terms(_chunk_rows(numbered, min_docs), min_docs))
    kept = stored(_kept_terms(found, min_docs))
    sums = (
        found.join(kept, ["lang_no", "term"], "left_semi")
        .select("lang_no", "term", F.inline("counts"))
        .groupBy("lang_no", "term", "place")
        .agg(F.sum("occurrences").alias("occurrences"))
    )
    lists = sums.groupBy("lang_no", "term").agg(F.collect_list(F.struct("place", "occurrences")).alias("counts"))
    return groups, stored(lists.withColumn("term", F.col("term").cast("string")))


def shares(occurrences: np.ndarray, totals: np.ndarray, n_terms: int) -> np.ndarray:
    """1 + floor(SCALE * (occurrences + SMOOTHING) / (total + SMOOTHING * n_terms)), exact for totals below 2 ** 53."""
    below = totals + SMOOTHING * n_terms
    rest = occurrences + SMOOTHING
    result = np.zeros(np.broadcast_shapes(rest.shape, below.shape), np.int64)
    # A share is below one, so the scale's decimal places come one after another, as in long division.
    for _ in range(len(str(SCALE)) - 1):
        digit, rest = np.divmod(rest * 10, below)
        result = result * 10 + digit
    return result + 1


def _compared(counts: DataFrame, totals: DataFrame, top_terms: int) -> DataFrame:
    """Per task: rows (lang_no, place, sums) of the matrix of differences over its terms, and its largest rises (place, term, value).

    ``totals`` holds, per language, the occurrences of all kept terms by place, and the number of kept terms. A task adds up the
    matrix for ``SIDE`` sources at a time.
    """
    blocks = F.sequence(F.lit(0), F.floor((F.size("totals") - 1) / SIDE).cast("int"))
    rows = counts.join(totals, "lang_no").select(
        "lang_no", F.explode(blocks).alias("block"), "term", F.col("counts.place").alias("places"),
        F.col("counts.occurrences").alias("known"), "totals", "n_terms",
    )
    schema = "lang_no int, place int, sums array<long>, term string, value long"
    names = ["lang_no", "place", "sums", "term", "value"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices: dict[tuple[int, int], np.ndarray] = {}
        rises: dict[tuple[int, int], list[tuple[int, bytes]]] = {}

        def sums_of(key: tuple[int, int]) -> pa.RecordBatch:
            matrix = matrices.pop(key)
            n = len(matrix)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, key[0], np.int32)),
                    pa.array(np.arange(n, dtype=np.int32) + key[1] * SIDE + 1),
                    pa.array(matrix.tolist(), pa.list_(pa.int64())),
                    pa.nulls(n, pa.string()),
                    pa.nulls(n, pa.int64()),
                ],
                names,
            )

        def add(key: tuple[int, int], piece: pa.RecordBatch, totals: np.ndarray, n_terms: int) -> None:
            own = slice(key[1] * SIDE, (key[1] + 1) * SIDE)
            places, known = piece["places"], piece["known"]
            counted = np.zeros((len(piece), len(totals)), np.int64)
            of_row = np.repeat(np.arange(len(piece)), places.value_lengths().to_numpy())
            counted[of_row, places.flatten().to_numpy() - 1] = known.flatten().to_numpy()
            p = shares(counted, totals, n_terms)
            q = shares(counted.sum(1), totals.sum(), n_terms)
            matrix = matrices[key]
            for i, column in enumerate(p[:, own].T):
                matrix[i] += np.abs(p - column[:, None]).sum(0)
            for i in range(own.start, min(own.stop, len(totals))):
                rise = np.where(counted[:, i] > 0, p[:, i] - q, 0)
                chosen = np.flatnonzero(rise > 0)
                if len(chosen) > top_terms:
                    # All that tie with the last one stay, until names decide.
                    chosen = chosen[rise[chosen] >= np.partition(rise[chosen], -top_terms)[-top_terms]]
                found = zip((-rise[chosen]).tolist(), (x.encode() for x in piece["term"].take(pa.array(chosen)).to_pylist()))
                best = rises.setdefault((key[0], i + 1), [])
                rises[key[0], i + 1] = sorted([*best, *found])[:top_terms]

        for batch in batches:
            langs, parts = batch["lang_no"].to_numpy(), batch["block"].to_numpy()
            edges = [*_starts(langs, parts).tolist(), len(langs)]
            for start, stop in zip(edges, edges[1:]):
                key = (int(langs[start]), int(parts[start]))
                totals = np.array(batch["totals"][start].as_py(), np.int64)
                width = min(SIDE, len(totals) - key[1] * SIDE)
                if key not in matrices and sum(m.size for m in matrices.values()) + width * len(totals) > CELLS:
                    for other in list(matrices):
                        yield sums_of(other)
                matrices.setdefault(key, np.zeros((width, len(totals)), np.int64))
                step = max((1 << 20) // len(totals), 1)
                for at in range(start, stop, step):
                    add(key, batch.slice(at, min(step, stop - at)), totals, batch["n_terms"][start].as_py())
        for key in list(matrices):
            yield sums_of(key)
        listed = [(lang, place, term.decode(), -value) for (lang, place), best in rises.items() for value, term in best]
        if listed:
            lang, place, term, value = zip(*listed)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(lang, pa.int32()), pa.array(place, pa.int32()), pa.nulls(len(listed), pa.list_(pa.int64())),
                    pa.array(term, pa.string()), pa.array(value, pa.int64()),
                ],
                names,
            )

    return stored(rows.mapInArrow(scan, schema))


def source_divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far the sources of each language lie apart, and by which terms.

    Terms are runs of ASCII letters and characters beyond ASCII, with A-Z lower-cased. A language keeps those in at least
    ``min_docs`` of its rows. Each source has a smoothed share p of each kept term, in billionths. Part ``pair`` compares a source with
    every other one of its language, item, by the sum of the differences of p; part ``term`` lists the ``top_terms`` terms
    that exceed their share q in the whole language most. Ranks count from 1, larger values first, ties by item.

    Null text, language and source count as ''. Repeated rows and ids count as often as they stand. Without kept terms all pairs
    have the value 0; a single source has none. An empty table gives no rows. Other columns have no influence.
    """
    if min_docs < 1 or top_terms < 1:
        raise ValueError("min_docs and top_terms are 1 at least")
    groups, counts = term_counts(docs, text, lang, source, min_docs)
    by_place = counts.select("lang_no", F.inline("counts")).groupBy("lang_no", "place").agg(F.sum("occurrences").alias("total"))
    n_terms = counts.groupBy("lang_no").agg(F.count(F.lit(1)).alias("n_terms"))
    known = groups.join(n_terms, "lang_no", "left").join(by_place, ["lang_no", "place"], "left").na.fill(0, ["n_terms", "total"])
    known = stored(known)
    ordered = F.sort_array(F.collect_list(F.struct("place", "total")))["total"]
    filled = known.where(F.col("n_terms") > 0)
    totals = filled.groupBy("lang_no").agg(ordered.alias("totals"), F.max("n_terms").alias("n_terms"))
    compared = _compared(counts, totals, top_terms)

    named = known.select("lang_no", "place", *GROUP)
    others = known.select("lang_no", F.col("place").alias("other"), F.col("source").alias("item"))
    apart = (
        compared.where(F.col("term").isNull())
        .select("lang_no", "place", F.posexplode("sums").alias("other", "value"))
        .groupBy("lang_no", "place", (F.col("other") + 1).alias("other"))
        .agg(F.sum("value").alias("value"))
    )
    bare = known.where(F.col("n_terms") == 0).select("lang_no", "place")
    alike = bare.join(others.select("lang_no", "other"), "lang_no").withColumn("value", F.lit(0).cast("long"))
    pairs = apart.unionByName(alike).where(F.col("place") != F.col("other")).join(others, ["lang_no", "other"])
    ranked = F.row_number().over(Window.partitionBy("part", *GROUP).orderBy(F.desc("value"), "item")).alias("rank")
    rises = compared.where(F.col("term").isNotNull()).withColumnRenamed("term", "item")
    columns = ["lang_no", "place", "part", "item", "value"]
    both = (
        pairs.withColumn("part", F.lit("pair")).select(*columns)
        .unionByName(rises.withColumn("part", F.lit("term")).select(*columns))
        .join(named, ["lang_no", "place"])
        .select(*GROUP, "part", "item", "value", ranked)
    )
    return both.where((F.col("part") == "pair") | (F.col("rank") <= top_terms))
