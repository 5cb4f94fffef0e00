"""Raw message files: CSV and zipped CSV, all columns as text."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from posixpath import basename

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from portflow.schemas import RAW_COLUMNS, RAW_SCHEMA


# Holds a line that does not have as many fields as the header, as it stands in the file; null for all others.
BROKEN = "broken_line"


def read_raw_csv(
    spark: SparkSession, path: str, lineage: str = "name", multiline: bool = False, quarantine: bool = False
) -> DataFrame:
    """Message files with a header, plus ``source_file``: the file's base name, or its URI (``"path"``).

    ``multiline`` is for files with line breaks inside quotes; such files cannot be split among tasks. Lines with too few or too
    many fields are read as far as they go; with ``quarantine`` they are also kept whole in column ``broken_line``, for
    :func:`without_broken_lines` and :func:`broken_lines`.
    """
    if lineage not in ("name", "path"):
        raise ValueError(f"unknown lineage: {lineage}")
    reader = (
        spark.read.schema(StructType([*RAW_SCHEMA.fields, StructField(BROKEN, StringType())]) if quarantine else RAW_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multiline)
    )
    if quarantine:
        # A line can only be told from a whole one by all of its fields.
        reader = reader.option("columnNameOfCorruptRecord", BROKEN).option("columnPruning", False)
    return reader.csv(path).select("*", F.col(f"_metadata.file_{lineage}").alias("source_file"))


def _is_broken() -> Column:
    """Spark refuses to read nothing but the broken text, so the condition looks at a field, too."""
    return F.col(BROKEN).isNotNull() & (F.char_length(F.coalesce(F.col(RAW_COLUMNS[0]), F.lit(""))) >= 0)


def without_broken_lines(raw: DataFrame) -> DataFrame:
    """The rows of whole lines."""
    return raw.where(~_is_broken()).drop(BROKEN)


def broken_lines(raw: DataFrame) -> DataFrame:
    """(source_file, line, field_count) of the lines that were set apart. Fields are counted by commas outside quotes."""
    bare = F.regexp_replace(BROKEN, '"[^"]*"', "")
    fields = F.char_length(bare) - F.char_length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return raw.where(_is_broken()).select("source_file", F.col(BROKEN).alias("line"), fields.alias("field_count"))


class _Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


class ZippedCsv(DataSource):
    """``spark.read.format("zipped_csv").load(folder)``: CSV members of zip archives.

    Spark's own readers have no zip codec. Every archive is one task, planned from the listing of the folder alone; the task reads
    the archive's directory and its members, one after the other. A deflated stream can only be read from its start; it is
    decompressed and parsed in chunks, so memory does not grow with the file. Spread the rows afterwards (``repartition``)
    when a few large archives feed a large cluster. Option ``quarantine`` adds column ``broken_line``.
    """

    @classmethod
    def name(cls) -> str:
        return "zipped_csv"

    def schema(self) -> str:
        return ", ".join(f"{name} string" for name in _columns(self.options))

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ZippedCsvReader(self.options["path"], _quarantines(self.options))


def _quarantines(options) -> bool:
    return str(options.get("quarantine", "false")).lower() == "true"


def _columns(options) -> tuple[str, ...]:
    return (*RAW_COLUMNS, *([BROKEN] if _quarantines(options) else []), "source_file")


class _ZippedCsvReader(DataSourceReader):
    def __init__(self, path: str, quarantine: bool):
        self.path, self.quarantine = path, quarantine

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(as_uri(self.path))
        info = system.get_file_info(root)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(root, recursive=True))
        archives = sorted(f.path for f in found if f.is_file and f.path.lower().endswith(".zip"))
        if not archives:
            raise ValueError(f"no zip archive under {self.path}")
        return [_Archive(path) for path in archives]

    def read(self, partition: _Archive) -> Iterator:
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(as_uri(self.path))
        source = basename(partition.path)
        with system.open_input_file(partition.path) as stream, zipfile.ZipFile(stream) as opened:
            names = [name for name in opened.namelist() if name.lower().endswith(".csv")]
            if not names:
                raise ValueError(f"{source}: no CSV file in the archive")
            for name in names:
                with opened.open(name) as member:
                    yield from self._rows(member, source)

    def _rows(self, member, source: str) -> Iterator:
        import pyarrow as pa
        from pyarrow import csv as arrow_csv

        uneven: list[str] = []

        def keep_aside(row) -> str:
            uneven.append(row.text)
            return "skip"

        header = next(csv.reader([member.readline().decode("utf-8-sig")]), [])
        if not header:
            raise ValueError(f"{source}: CSV header not found")
        missing = [name for name in RAW_COLUMNS if name not in header]
        if missing:
            raise ValueError(f"{source}: CSV header lacks {', '.join(missing)}")
        reader = _open_chunks(arrow_csv, member, header, keep_aside)
        for chunk in reader or ():
            yield self._batch(pa, [chunk.column(name) for name in RAW_COLUMNS], [None] * chunk.num_rows, source)
            if uneven:
                yield self._uneven(pa, uneven, header, source)
                uneven.clear()
        if uneven:
            yield self._uneven(pa, uneven, header, source)

    def _uneven(self, pa, lines: list[str], header: list[str], source: str):
        """Lines with too few or too many fields: missing ones are null, surplus ones are dropped."""
        rows = [dict(zip(header, fields)) for fields in csv.reader(lines)]
        columns = [pa.array([row.get(name) for row in rows], pa.string()) for name in RAW_COLUMNS]
        return self._batch(pa, columns, lines, source)

    def _batch(self, pa, columns: list, broken: list, source: str):
        extra = [pa.array(broken, pa.string())] if self.quarantine else []
        lineage = pa.array([source] * len(broken), pa.string())
        names = _columns({"quarantine": str(self.quarantine)})
        return pa.RecordBatch.from_arrays([*columns, *extra, lineage], names=list(names))


def _open_chunks(arrow_csv, member, header: list[str], keep_aside):
    """A chunked reader over the rest of the member; ``None`` when only the header was there."""
    buffered = io.BufferedReader(member, 1 << 20)
    if not buffered.peek(1):
        return None
    return arrow_csv.open_csv(
        buffered,
        arrow_csv.ReadOptions(column_names=header, block_size=8 << 20, use_threads=False),
        arrow_csv.ParseOptions(invalid_row_handler=keep_aside),
        arrow_csv.ConvertOptions(
            column_types={name: "string" for name in header}, strings_can_be_null=False, check_utf8=True
        ),
    )


def as_uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:/") else f"file://{path}"


def read_raw_zip(spark: SparkSession, path: str, quarantine: bool = False) -> DataFrame:
    spark.dataSource.register(ZippedCsv)
    return spark.read.format("zipped_csv").option("quarantine", quarantine).load(path)
