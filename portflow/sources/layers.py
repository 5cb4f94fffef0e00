"""Lake tables: Parquet layers, CSV tables, catalog registration, and writes that report their counts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from portflow.schemas import ANOMALIES_CSV_SCHEMA, ANOMALY_COLUMNS, CONGESTION_COLUMNS, CONGESTION_CSV_SCHEMA

BY_MONTH = ("year", "month")

# Table name -> partition columns.
LAYERS = {
    "bronze_messages": ("batch", *BY_MONTH),
    "silver_positions": BY_MONTH,
    "silver_quality_report": (),
    "silver_proximity": BY_MONTH,
    "silver_stops": BY_MONTH,
    "gold_anomalies": (),
    "gold_congestion": ("report_date",),
}

POSITION_COLUMNS = ("_row_file", "_row_index")

# Most of a table's bytes are hexadecimal hashes. This codec halves them; Spark's default one leaves them as long as they are.
CODEC = "zstd"


def layer_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def batch_name(source: str) -> str:
    """The folder name of a source's rows; different sources have different names."""
    plain = re.sub(r"[^A-Za-z0-9.-]", "-", source)[:80]
    return f"of-{plain}-{hashlib.sha256(source.encode()).hexdigest()[:12]}"


def read_layer(spark: SparkSession, path: str, position: bool = False) -> DataFrame:
    """A Parquet layer; ``position`` adds each row's file and index, which tell identical rows apart."""
    rows = spark.read.parquet(path)
    return with_position(rows) if position else rows


def with_position(rows: DataFrame) -> DataFrame:
    """Add file and index to the rows of a Parquet scan."""
    return rows.select(
        "*", F.col("_metadata.file_path").alias("_row_file"), F.col("_metadata.row_index").alias("_row_index")
    )


def between_months(df: DataFrame, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """Rows of the (year, month) span, as conditions on the partition columns alone so folders are pruned."""
    in_year = F.col("year").between(first[0], last[0])
    after = (F.col("year") > first[0]) | (F.col("month") >= first[1])
    before = (F.col("year") < last[0]) | (F.col("month") <= last[1])
    return df.where(in_year & after & before)


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    counts: Mapping[str, Column] | None = None,
) -> dict[str, int]:
    """Write Parquet and return the row count and any further counts, all taken during the write.

    Overwriting replaces everything under ``path``, so no row of an earlier run survives in a partition that the new rows do not
    reach. To replace one partition of a table and keep the others, write to that partition's own path.
    """
    measured = {"rows": F.count(F.lit(1))}
    measured.update({name: F.count_if(condition) for name, condition in (counts or {}).items()})
    observation = Observation()
    observed = df.observe(observation, *[column.alias(name) for name, column in measured.items()])
    writer = observed.write.mode(mode).option("partitionOverwriteMode", "static").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    counted = dict(observation.get)
    if partition_by and mode == "overwrite" and not counted["rows"]:
        # A partitioned table without rows has no file that tells its columns.
        df.limit(0).write.mode("overwrite").parquet(path)
    return counted


def store(df: DataFrame, path: str, codec: str | None = None) -> DataFrame:
    """Write an intermediate table and read it back, so that its readers do not compute it again."""
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_rows(df: DataFrame, path: str) -> dict[str, int]:
    """Add rows to a log-like table, such as the quality reports; running it twice adds them twice."""
    return write_layer(df, path, mode="append")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def _read_csv_by_position(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (
        spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("escape", '"').csv(path)
    )


def write_congestion_csv(gold: DataFrame, path: str) -> None:
    """The congestion table as CSV, in the column order its readers rely on."""
    write_csv(gold.select(*CONGESTION_COLUMNS[:-1]), path)


def write_anomalies_csv(anomalies: DataFrame, path: str) -> None:
    write_csv(anomalies.select(*ANOMALY_COLUMNS), path)


def read_congestion_csv(spark: SparkSession, path: str) -> DataFrame:
    """The congestion CSV table; columns are taken by position, whatever the header calls them."""
    return _read_csv_by_position(spark, path, CONGESTION_CSV_SCHEMA)


def read_anomalies_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv_by_position(spark, path, ANOMALIES_CSV_SCHEMA)


def quoted(name: str) -> str:
    """A table, column or path as SQL takes it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_layer(spark: SparkSession, table: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """Create a catalog table over a Parquet folder and pick up its partitions."""
    rows = spark.read.parquet(path)
    if spark.catalog.tableExists(table):
        _check_table(spark, table, path, rows)
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in rows.schema.fields)
    partitions = f"PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {partitions} LOCATION {sql_text(path)}")
    if partition_by:
        repair_partitions(spark, table)


def _check_table(spark: SparkSession, table: str, path: str, rows: DataFrame) -> None:
    """Refuse to keep a table of this name that has other columns or lies elsewhere."""
    known = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    place = next((r.data_type for r in known if r.col_name == "Location"), "")
    ours = {(f.name, f.dataType.simpleString()) for f in rows.schema.fields}
    theirs = {(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields}
    if ours != theirs or place.split(":", 1)[-1].lstrip("/") != path.split(":", 1)[-1].strip("/"):
        raise ValueError(f"table {table} exists with other columns or another location")


def repair_partitions(spark: SparkSession, table: str) -> None:
    """Make partitions written since registration visible."""
    spark.sql(f"MSCK REPAIR TABLE {table}")
