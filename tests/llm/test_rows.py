"""Row numbers hold when files are split in another way between two scans, as they are when executors come or go."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from portflow.llm import common, queries

SPLITS = "spark.sql.files.minPartitionNum"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, sf_dir):
    """The small tables with the documents in eight files, in a folder whose name needs escaping."""
    path = tmp_path_factory.mktemp("rows") / "it's 100% odd"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.repartition(8, "doc_id").write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.fixture
def shifting(spark, monkeypatch):
    """From now on every stored table is followed by another way to split files."""
    splits = itertools.cycle(["3", "5", "4", "7"])
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    kept = common.store

    def store(df, path):
        table = kept(df, path)
        spark.conf.set(SPLITS, next(splits))
        return table

    def start():
        monkeypatch.setattr(common, "store", store)
        spark.conf.set(SPLITS, "4")

    yield start
    spark.conf.unset(SPLITS)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def rows(frame):
    return sorted(json.dumps(r.asDict(), default=str) for r in frame.collect())


def test_numbers_belong_to_rows(spark, shifting, folder):
    docs = common.read_table(spark, folder, "documents")
    shifting()
    numbered = common.with_row(docs.where("doc_id % 3 = 1")).select("doc_id", common.ROW)
    seen = []
    for splits in ("1", "3", "8"):
        spark.conf.set(SPLITS, splits)
        seen.append({r.doc_id: r[common.ROW] for r in numbered.collect()})
    assert seen[0] == seen[1] == seen[2] and len(set(seen[0].values())) == len(seen[0]) > 60
    # A column of the table may have the name of the hidden one.
    clash = docs.withColumn("_metadata", F.lit(1))
    assert common.with_row(clash).select(common.ROW).distinct().count() == docs.count()


@pytest.mark.parametrize("name", ["op1_", "op5_", "op6_", "op7_", "op9_", "op10_"])
def test_query_does_not_depend_on_splits(spark, shifting, folder, name):
    query = next(q for key, q in queries.QUERIES.items() if key.startswith(name))
    before = rows(query(spark, folder))
    shifting()
    assert rows(query(spark, folder)) == before


def test_mixing_stage_does_not_depend_on_splits(spark, shifting, folder):
    docs = common.read_table(spark, folder, "documents")
    before = rows(corpus_pipeline.mix_sources(spark, docs, folder))
    shifting()
    assert rows(corpus_pipeline.mix_sources(spark, docs, folder)) == before
