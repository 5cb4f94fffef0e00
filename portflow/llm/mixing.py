"""Mixing sources to target weights with a low-discrepancy schedule. DataFrame functions only.

Every source's documents are shuffled (by a hash of their ids) into a stream of words, repeated as often as its
target needs, and cut into blocks of the same number of words. The mix is a sequence of N slots, each for one
block. Golden-ratio points, rounded to the N positions and so a permutation of them, are mapped through the
cumulative slot counts of the sources: slot i belongs to the source whose interval holds the point i * g mod N.
So any stretch of the mix has nearly the target shares. A source's slots are ranked, and slot rank k takes the
source's k-th block. The points are inverted rather than searched: a source lists the points of its own interval.

The order within a source is a running sum in two steps (within ranges of the hash, then over the ranges), so a
source that holds a third of all rows is not sorted in one task. One-task windows see one row per source.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portflow.llm.common import ROW, stored, text_or_empty, with_row

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"
SLOTS_PER_SOURCE = 2048
MAX_SLOTS = 1 << 31
SEED = "mix-1"
CHUNK = 4096


def _named_source(name: str = "source") -> list[Column]:
    """A source as two columns without nulls, for plain equi-joins."""
    return [F.coalesce(F.col(name), F.lit("")).alias("source_key"), F.col(name).isNull().alias("source_missing")]


KEY = ["source_key", "source_missing"]


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source with its size, weight, and target.

    Sources in code-point order, null last, have the weights 5, 2, 1, 5, 2, 1, ... and share the total size. A
    target stops at three times its source's size; the excess goes to the others by weight. The limit that sources
    reach first is the one with the lowest ratio to the weight, so in that order a source is capped
    exactly if its share of what the ones before it left over is not below its limit.
    """
    total = sizes.groupBy(*KEY).agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("source_missing", "source_key"))
    weights = F.array(*map(F.lit, WEIGHTS))
    weighted = total.withColumn("place", rank).withColumn(
        "weight", F.element_at(weights, ((F.col("place") - 1) % len(WEIGHTS) + 1).cast("int")).cast("long")
    )
    limit = F.col("source_size") * MAX_REPEATS
    order = Window.orderBy("ratio", "place")
    everything = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        weighted.withColumn("limit", limit)
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn(
            "spent", F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        )
        .withColumn("weights_left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    )

    def exact(column: Column, digits: int) -> Column:
        return column.cast(f"decimal({digits},0)")

    share = exact(F.col("total") - F.col("spent"), 20) * exact(F.col("weight"), 17)
    capped = ranked.withColumn("capped", share >= exact(F.col("limit"), 20) * exact(F.col("weights_left"), 17))
    used = F.sum(F.when(F.col("capped"), F.col("limit")).otherwise(0)).over(everything)
    open_weights = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)
    rest = (F.col("total") - used) * F.col("weight")
    target = F.when(F.col("capped"), F.col("limit").cast("double")).otherwise(
        rest.cast("double") / open_weights.cast("double")
    )
    return capped.select(*KEY, "place", "source_size", "weight", "total", target.alias("target")).withColumn(
        "quota", F.round("target").cast("long")
    )


@dataclass(frozen=True)
class Mix:
    """Stored parts of one mix. ``sizes``: row, doc_id, source and size; ``sources``: see :func:`targets`."""

    sizes: DataFrame
    sources: DataFrame
    pieces: DataFrame


def _slots(sources: DataFrame, n_slots: int) -> DataFrame:
    """(source, block rank, slot) for every slot of the schedule."""
    step = max(1, round(n_slots * 0.6180339887498949))
    while gcd(step, n_slots) != 1:
        step += 1
    inverse = pow(step, -1, n_slots) if n_slots > 1 else 0
    chunks = sources.where("n_slots > 0").select(
        *KEY, "n_slots", "first_point", F.explode(F.sequence(F.lit(0), F.col("n_slots") - 1, F.lit(CHUNK))).alias("lo")
    )
    chunks = chunks.repartition(*KEY, "lo")
    last = F.least(F.col("lo") + CHUNK, F.col("n_slots")) - 1
    ranks = chunks.select(*KEY, "first_point", F.explode(F.sequence("lo", last)).alias("nth"))
    slots = ranks.select(*KEY, ((F.col("first_point") + F.col("nth")) * inverse % n_slots).alias("slot"))
    # Ranks within a source in two steps, as for documents: slots are spread evenly over ranges of the schedule.
    width = max(1, n_slots // CHUNK)
    ranged = slots.withColumn("range", F.floor(F.col("slot") / width))
    counts = ranged.groupBy(*KEY, "range").agg(F.count(F.lit(1)).alias("in_range"))
    before = F.sum("in_range").over(Window.partitionBy(*KEY).orderBy("range")) - F.col("in_range")
    local = F.row_number().over(Window.partitionBy(*KEY, "range").orderBy("slot")) - 1
    return (
        ranged.join(counts.select(*KEY, "range", before.alias("before")), [*KEY, "range"])
        .withColumn("block", F.col("before") + local)
        .select(*KEY, "block", "slot")
    )


def _layout(sizes: DataFrame) -> DataFrame:
    """Every document with words and where it starts in the shuffled stream of its source."""
    token = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    filled = sizes.where("size > 0").withColumn("token", token).withColumn("range", F.substring("token", 1, 3))
    totals = filled.groupBy(*KEY, "range").agg(F.sum("size").alias("in_range"))
    before = F.sum("in_range").over(Window.partitionBy(*KEY).orderBy("range")) - F.col("in_range")
    within = Window.partitionBy(*KEY, "range").orderBy("token", "doc_id", "size", ROW)
    return (
        filled.join(totals.select(*KEY, "range", before.alias("before")), [*KEY, "range"])
        .withColumn("start", F.col("before") + F.sum("size").over(within) - F.col("size"))
        .select(ROW, *KEY, "size", "start")
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> Mix:
    """Mix all rows of ``docs``; ``pieces`` says which words of which row stand in which slot.

    pieces: row, slot, block, from_word and words. A word is a maximal run of bytes other than ASCII white space;
    null has none. Rows without words are in no piece. Repeated rows and ids are documents of their own. The same
    table gives the same mix. An empty table gives an empty mix. Quotas are exact: a source's last
    block ends where its target does.
    """
    counted = with_row(docs).select(
        ROW,
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long").alias("size"),
    )
    sizes = stored(counted.select("*", *_named_source()))
    sources = stored(targets(sizes))
    seen = sources.agg(F.max("total"), F.count(F.lit(1))).first()
    total, n_sources = seen[0] or 0, seen[1]
    block = max(1, -(-total // max(1, min(n_sources * SLOTS_PER_SOURCE, MAX_SLOTS))))
    sources = sources.withColumn("n_slots", F.ceil(F.col("quota") / block).cast("long"))
    sources = sources.withColumn(
        "first_point", F.coalesce(F.sum("n_slots").over(Window.orderBy("place")) - F.col("n_slots"), F.lit(0))
    )
    n_slots = sources.agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0]
    slots = _slots(sources, max(1, n_slots))
    placed = _layout(sizes).join(sources.select(*KEY, "source_size", "quota"), KEY)
    last_pass = F.floor((F.col("quota") - 1 - F.col("start")) / F.col("source_size"))
    passes = placed.where(F.col("start") < F.col("quota")).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), last_pass)).alias("pass")
    )
    lo = F.col("pass") * F.col("source_size") + F.col("start")
    spans = passes.withColumn("lo", lo).withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("quota")))
    first_block, last_block = F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block)
    cut = spans.select(ROW, *KEY, "lo", "hi", F.explode(F.sequence(first_block, last_block)).alias("block"))
    start = F.greatest(F.col("lo"), F.col("block") * block)
    words = F.least(F.col("hi"), (F.col("block") + 1) * block) - start
    pieces = cut.join(slots, [*KEY, "block"]).select(
        ROW, "slot", "block", (start - F.col("lo")).alias("from_word"), words.alias("words")
    )
    return Mix(sizes, sources, pieces)


def taken_words(mixed: Mix) -> DataFrame:
    """(row, doc_id, size, source_size, target, taken) for every row that was mixed."""
    taken = mixed.pieces.groupBy(ROW).agg(F.sum("words").alias("taken"))
    return (
        mixed.sizes.join(mixed.sources.select(*KEY, "source_size", "target"), KEY)
        .join(taken, ROW, "left")
        .select(ROW, "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: one row per document taken, with all columns.

    A document that is taken k times in full and then up to its m-th word has its text k times, then its first m
    words, with line feeds between. Documents of which nothing is taken are left out. ``n_chars``, where there is
    such a column, follows the text. Only the document in which a source's quota ends, one per source, is cut; its
    last copy has its words joined by single spaces.
    """
    taken = taken_words(mix(docs)).where("taken > 0").select(ROW, "taken", "size")
    names = docs.columns
    joined = with_row(docs).join(taken.withColumnsRenamed({"taken": "_llm_taken", "size": "_llm_size"}), ROW)
    copies = F.floor(F.col("_llm_taken") / F.col("_llm_size")).cast("int")
    part = (F.col("_llm_taken") % F.col("_llm_size")).cast("int")
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    whole = F.array_repeat(F.col("text"), copies)
    cut = F.when(part > 0, F.array(F.array_join(F.slice(words, F.lit(1), part), " "))).otherwise(
        F.array().cast("array<string>")
    )
    text = F.array_join(F.concat(whole, cut), "\n")
    out = joined.withColumn("_llm_text", text)
    columns = {"text": F.col("_llm_text"), "n_chars": F.char_length("_llm_text").cast("long")}
    return out.select(*[columns[c].alias(c) if c in columns else F.col(f"`{c}`") for c in names])
