"""A training corpus from raw documents: filter, remove copies, mix and pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from portflow.llm import toxicity
from portflow.llm.common import id_hash_mod, read_table, stored, with_row
from portflow.llm.exact_dedup import without_exact_copies
from portflow.llm.mixing import mixed_documents
from portflow.llm.near_dedup import without_near_copies
from portflow.llm.packing import pack


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. Labels of one document in five, by its id, are never learned from."""
    training = with_row(docs).where(id_hash_mod("doc_id", 5) != 0)
    labels = toxicity.labelled_rows(training, read_table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, toxicity.fit(training, labels))


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_exact_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, added_tokens=True)


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_exact_copies),
    ("near_dedup", remove_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Neither the classifier nor the tokenizer can be written in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table documents, each reading what the one before has stored."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
