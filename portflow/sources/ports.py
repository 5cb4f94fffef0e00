"""The ports dimension: one row per port, brought to the driver once its size in bytes is known to be small."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.schemas import PORTS_SCHEMA

# Text and numbers of all ports together, in bytes: what a driver and a plan may carry.
MAX_PORT_BYTES = 64 << 20


@dataclass(frozen=True)
class Port:
    port_id: str
    port_name: str
    latitude: float
    longitude: float
    port_radius_km: float


# The default ports, in the order that decides ties.
DEFAULT_PORTS = (
    Port("los_angeles_long_beach", "Los Angeles / Long Beach", 33.7542, -118.2165, 20.0),
    Port("new_york_new_jersey", "New York / New Jersey", 40.6681, -74.0451, 20.0),
    Port("houston", "Houston", 29.7308, -95.2622, 20.0),
    Port("savannah", "Savannah", 32.0809, -81.0912, 20.0),
    Port("seattle_tacoma", "Seattle / Tacoma", 47.6038, -122.3301, 20.0),
)


def read_ports(spark: SparkSession, path: str) -> DataFrame:
    """The ports file with the coordinate columns named as in the joined tables."""
    rows = spark.read.schema(PORTS_SCHEMA).option("header", True).option("enforceSchema", False).csv(path)
    return rows.select(
        "port_id",
        "port_name",
        F.col("latitude").alias("port_latitude"),
        F.col("longitude").alias("port_longitude"),
        "port_radius_km",
    )


def load_ports(ports: DataFrame, max_bytes: int = MAX_PORT_BYTES) -> tuple[Port, ...]:
    """Bring a ports table to the driver; its size is measured first."""
    size = F.sum(F.octet_length("port_id") + F.octet_length(F.coalesce("port_name", F.lit(""))) + 24)
    total = ports.agg(size).first()[0]
    if not total:
        raise ValueError("the ports table is empty")
    if total > max_bytes:
        raise ValueError(f"the ports take {total} bytes, more than {max_bytes}")
    return tuple(
        Port(r.port_id, r.port_name, r.port_latitude, r.port_longitude, r.port_radius_km) for r in ports.collect()
    )


def ports_frame(spark: SparkSession, ports: Sequence[Port] = DEFAULT_PORTS) -> DataFrame:
    rows = [(p.port_id, p.port_name, p.latitude, p.longitude, p.port_radius_km) for p in ports]
    return spark.createDataFrame(rows, PORTS_SCHEMA)


def port_name(port_id: Column, ports: Sequence[Port]) -> Column:
    """Display name of a port, or its id when the dimension lacks it."""
    names = F.create_map(*[F.lit(text) for port in ports for text in (port.port_id, port.port_name)])
    return F.coalesce(F.try_element_at(names, port_id), port_id)
