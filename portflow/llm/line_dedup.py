"""Removing boilerplate lines by the number of distinct sites that show them.

Lines are counted first: one that occurs less often than the threshold can't be on enough sites. For the others, every task
builds HyperLogLog sketches of the sites per line hash, and aggregation merges them. Lines whose estimate is
clearly above the threshold are boilerplate, clearly below are not, and those near it get an exact distinct count. All of
it is DataFrame functions; a line that stands in a third of all documents is one row per task before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portflow.llm.common import ROW, stored, text_or_empty, with_row

MIN_SITES = 8
# Only empty lines are nobody's.
MIN_CHARS = 1
SKETCH_BITS = 12
# Relative standard error of such a sketch, and how many of them count as near.
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)
NEAR_ERRORS = 6
BROADCAST_ROWS = 1 << 18
KEY = ["line_1", "line_2"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _site(source: str) -> Column:
    """A text per site; null is a site of its own."""
    return F.when(F.col(source).isNull(), "?").otherwise(F.concat(F.lit("="), F.col(source)))


def line_occurrences(docs: DataFrame, text: str = "text", source: str = "source", min_chars: int = MIN_CHARS) -> DataFrame:
    """(row, pos, site, line hashes) of every line that is long enough, without the white space around it."""
    rows = with_row(docs).select(ROW, _site(source).alias("site"), F.posexplode(_lines(text_or_empty(text))).alias("pos", "line"))
    line = F.regexp_replace(F.col("line"), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    kept = rows.withColumn("line", line).where(F.char_length("line") >= min_chars)
    return kept.select(ROW, "pos", "site", F.xxhash64("line").alias("line_1"), F.xxhash64(F.lit(1), "line").alias("line_2"))


def _narrowed(df: DataFrame, few: DataFrame, key: list[str]) -> DataFrame:
    """``df`` without the rows whose key a stored table lacks; a small table is broadcast."""
    return df.join(F.broadcast(few) if few.count() <= BROADCAST_ROWS else few, key, "left_semi")


def frequent_lines(occurrences: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The occurrences of lines that occur often enough to be on ``min_sites`` sites, stored: the texts are split no more."""
    counts = occurrences.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    frequent = stored(counts.where(F.col("n") >= min_sites).select(*KEY))
    return stored(_narrowed(occurrences, frequent, KEY))


def boilerplate(candidates: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The hashes of the lines on ``min_sites`` distinct sites or more."""
    sketches = candidates.groupBy(*KEY).agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sites"))
    estimated = stored(sketches.select(*KEY, F.hll_sketch_estimate("sites").alias("sites")))
    margin = max(1.0, NEAR_ERRORS * SKETCH_ERROR * min_sites)
    near = stored(estimated.where(F.abs(F.col("sites") - min_sites) <= margin).select(*KEY))
    exact = _narrowed(candidates.select(*KEY, "site"), near, KEY).distinct().groupBy(*KEY).agg(F.count(F.lit(1)).alias("sites"))
    sure = estimated.where(F.col("sites") > min_sites + margin).select(*KEY)
    return stored(sure.unionByName(exact.where(F.col("sites") >= min_sites).select(*KEY)))


def without_boilerplate(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    min_sites: int = MIN_SITES,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """(row, doc_id, n_lines, n_removed, kept) per row: the text without its boilerplate lines.

    Lines end at line feeds. Null counts as the empty text, which is one empty line. Empty lines, and
    those shorter than ``min_chars``, always stay. A line is told by two 64-bit hashes. Rows with
    equal or null ids are documents of their own. An empty table gives no rows.
    """
    candidates = frequent_lines(line_occurrences(docs, text, source, min_chars), min_sites)
    found = boilerplate(candidates, min_sites)
    hits = _narrowed(candidates.select(ROW, "pos", *KEY), found, KEY)
    removed = hits.groupBy(ROW).agg(F.collect_list("pos").alias("removed"))
    rows = with_row(docs).select(ROW, F.col(doc_id).alias("doc_id"), _lines(text_or_empty(text)).alias("lines"))
    # The lists grow with the texts: the join is of one kind at every size.
    joined = rows.join(removed.hint("merge"), ROW, "left")
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.transform(F.array_except(places, "removed"), lambda i: F.get("lines", i))
    kept = F.when(F.col("removed").isNull(), F.col("lines")).otherwise(kept)
    return joined.select(
        ROW,
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.array_join(kept, "\n").alias("kept"),
    )
