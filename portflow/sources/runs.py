"""Tables that are replaced without a gap: each write has a folder of its own and counts once it is published.

A table's folder holds one folder ``run=r<number>-<suffix>`` per write. Publishing is the last step of a write: one small marker
file, with the row counts, appears in the run's folder. Readers take published runs only, the newest one or all of them, so
a job that dies at any point leaves what they read as it was, and a reader that has started keeps its files. Older folders are
removed later, by :func:`retire_runs`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from portflow.sources.layers import LAYERS, layer_path, quoted, sql_text, write_layer

RUN = "run"
MARKER = "_PUBLISHED"

# The layer of which a run replaces one source's part, and the one that every run adds to. Runs replace all others whole.
BY_BATCH = "bronze_messages"
ADDED_TO = ("silver_quality_report",)


def _folder(spark: SparkSession, path: str):
    """The Hadoop file system of a path and the path itself."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _child(spark: SparkSession, path: str, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, name)


def subfolders(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of the folders in ``path`` that begin with ``prefix``, in order; none if there is no such path."""
    system, place = _folder(spark, path)
    if not system.exists(place):
        return []
    names = (f.getPath().getName() for f in system.listStatus(place) if f.isDirectory())
    return sorted(name for name in names if name.startswith(prefix))


def _is_published(spark: SparkSession, path: str, run: str) -> bool:
    system, _ = _folder(spark, path)
    return system.exists(_child(spark, f"{path}/{run}", MARKER))


def published_runs(spark: SparkSession, path: str) -> list[str]:
    """The folders of the published runs, oldest first."""
    return [f"{path}/{run}" for run in subfolders(spark, path, f"{RUN}=") if _is_published(spark, path, run)]


def newest_run(spark: SparkSession, path: str) -> str:
    """The folder of the run that readers see."""
    for run in reversed(subfolders(spark, path, f"{RUN}=")):
        if _is_published(spark, path, run):
            return f"{path}/{run}"
    raise FileNotFoundError(f"{path} has no published run")


def has_run(spark: SparkSession, path: str) -> bool:
    return bool(published_runs(spark, path))


def begin_run(spark: SparkSession, path: str) -> str:
    """A new folder name behind all that exist, published or not."""
    known = subfolders(spark, path, f"{RUN}=")
    number = int(known[-1].split("=r")[1].split("-")[0]) + 1 if known else 0
    return f"{path}/{RUN}=r{number:08d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, run_folder: str, info: Mapping[str, int | str] | None = None) -> None:
    """Make a finished run one that readers see. ``info`` is kept with it."""
    system, _ = _folder(spark, run_folder)
    stream = system.create(_child(spark, run_folder, MARKER), False)
    try:
        stream.write(bytearray(json.dumps(dict(info or {})).encode()))
    finally:
        stream.close()


def run_info(spark: SparkSession, run_folder: str) -> dict[str, int | str]:
    """The counts, and whatever else, a run was published with."""
    system, _ = _folder(spark, run_folder)
    stream = system.open(_child(spark, run_folder, MARKER))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def write_run(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), counts: Mapping[str, Column] | None = None
) -> dict[str, int]:
    """Write a run of the table at ``path`` and publish it; returns the counts taken during the write."""
    spark = df.sparkSession
    target = begin_run(spark, path)
    counted = write_layer(df, target, partition_by, counts=counts)
    publish(spark, target, counted)
    return counted


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest published run."""
    return spark.read.parquet(newest_run(spark, path))


def _read_folders(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    """The rows of several runs below ``path``. Runs without rows have no partitions, so they are left out, unless all are."""
    if not folders:
        raise FileNotFoundError(f"{path} has no published run")
    filled = [folder for folder in folders if run_info(spark, folder).get("rows") != 0]
    return spark.read.option("basePath", path).parquet(*(filled or folders[-1:]))


def read_all_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all published runs, with the run's name in column ``run``: a table that runs add to."""
    return _read_folders(spark, path, published_runs(spark, path))


def read_newest_parts(spark: SparkSession, path: str, part: str) -> DataFrame:
    """The newest published run of every folder ``<part>=...``: a table of which a run replaces one part."""
    return _read_folders(spark, path, [runs[-1] for runs in _runs_of_parts(spark, path, part)]).drop(RUN)


def _runs_of_parts(spark: SparkSession, path: str, part: str) -> list[list[str]]:
    found = (published_runs(spark, f"{path}/{name}") for name in subfolders(spark, path, f"{part}="))
    return [runs for runs in found if runs]


def read_table_runs(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A layer of a lake as its readers see it."""
    path = layer_path(root, table)
    if table == BY_BATCH:
        return read_newest_parts(spark, path, "batch")
    return read_all_runs(spark, path) if table in ADDED_TO else read_newest(spark, path)


def retire_runs(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove the folders behind the ``keep`` newest published runs, and return their names.

    Unpublished folders older than the newest published run go, too: their jobs have died or were overtaken. Call it when no reader
    that started on an older run is left.
    """
    if keep < 1:
        raise ValueError("the newest run stays")
    names = subfolders(spark, path, f"{RUN}=")
    published = [name for name in names if _is_published(spark, path, name)]
    if not published:
        return []
    kept = set(published[-keep:])
    old = [name for name in names if name < published[-1] and name not in kept]
    system, _ = _folder(spark, path)
    for name in old:
        # The marker goes first: a half removed folder is never read.
        system.delete(_child(spark, f"{path}/{name}", MARKER), False)
        system.delete(_child(spark, path, name), True)
    return old


def switch_view(spark: SparkSession, view: str, folders: Sequence[str], base: str | None = None, hidden: Sequence[str] = ()) -> None:
    """Point a catalog view at run folders, in one catalog step; queries that have started go on with the old ones.

    Several folders are parts of the table below ``base``; they are named by its partition columns, so only they are read.
    """
    if base is None:
        (folder,) = folders
        source = f"parquet.{quoted(folder)}"
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {source}")
        return
    parts = []
    for folder in folders:
        keys = [key.split("=", 1) for key in folder[len(base) :].strip("/").split("/")]
        parts.append(" AND ".join(f"{quoted(name)} = {sql_text(value)}" for name, value in keys))
    where = " OR ".join(f"({part})" for part in parts)
    columns = f"* EXCEPT ({', '.join(map(quoted, hidden))})" if hidden else "*"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM parquet.{quoted(base)} WHERE {where}")


def register_lake(spark: SparkSession, root: str, database: str | None = None) -> None:
    """Point one catalog view per table of a lake at its published runs. Call it again after a run to show that one."""
    prefix = f"{quoted(database)}." if database else ""
    for table in LAYERS:
        path = layer_path(root, table)
        view = prefix + quoted(table)
        if table == BY_BATCH:
            folders = [runs[-1] for runs in _runs_of_parts(spark, path, "batch")]
            switch_view(spark, view, folders, path, [RUN])
        elif table in ADDED_TO:
            switch_view(spark, view, published_runs(spark, path), path)
        else:
            switch_view(spark, view, [newest_run(spark, path)])
