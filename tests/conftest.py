import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from portflow.session import build_session  # noqa: E402
from portflow.settings import Settings  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": "/tmp/portflow-warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def settings():
    return Settings(as_of=datetime(2026, 1, 1))


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def raw_rows(spark):
    """Build raw messages from (MMSI, time, lat, lon, speed) tuples, or dicts for more columns."""
    from pyspark.sql import functions as F

    from portflow.schemas import RAW_COLUMNS, RAW_SCHEMA

    def build(rows, source="day.csv"):
        records = []
        for row in rows:
            if not isinstance(row, dict):
                row = dict(zip(("MMSI", "BaseDateTime", "LAT", "LON", "SOG"), row))
            records.append(tuple(row.get(name) for name in RAW_COLUMNS))
        return spark.createDataFrame(records, RAW_SCHEMA).withColumn("source_file", F.lit(source))

    return build
