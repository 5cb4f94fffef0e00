"""Catalog tables bucketed by key: what groups or joins by the key, or by it and more columns, reads them without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from portflow.sources.layers import quoted


def write_buckets(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write a Parquet table under ``path``, bucketed and sorted by ``keys``, and register it.

    Rows are dealt out by the hash that bucketing uses, so every bucket is one file. The shuffle is paid here, once; all rows of a key
    lie in one bucket, so a key that holds a large part of all rows is better combined first.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)


def bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, database: str) -> DataFrame:
    """:func:`write_buckets` in a database of its own, and the table read back. The table's entry goes, its files stay."""
    spark: SparkSession = df.sparkSession
    name = quoted(database)
    spark.sql(f"CREATE DATABASE {name}")
    try:
        write_buckets(df, f"{name}.rows", path, keys, buckets)
        return spark.table(f"{name}.rows")
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")
