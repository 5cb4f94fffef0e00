"""Nearest port of each position without comparing every position with every port in a join."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.functions.geo import haversine_km, squared_chord, unit_vector
from portflow.session import scratch_dir
from portflow.sources.layers import store
from portflow.sources.ports import Port

# Up to this many ports the comparisons are written out as plain expressions and compiled with the scan.
UNROLLED_PORTS = 32

# Broadcast the per-cell port lists up to this many entries in total, about 80 bytes each.
MAX_LISTED_PORTS = 1_000_000


_PORT_TYPE = (
    "array<struct<id: string, name: string, lat: double, lon: double, radius: double,"
    " x: double, y: double, z: double>>"
)


def _port_array(ports: Sequence[Port]) -> Column:
    """The ports as one array literal. It is handed over as JSON text, which the optimizer reads once."""
    rows = []
    for p in ports:
        phi, lam = math.radians(p.latitude), math.radians(p.longitude)
        x, y, z = math.cos(phi) * math.cos(lam), math.cos(phi) * math.sin(lam), math.sin(phi)
        rows.append([p.port_id, p.port_name, p.latitude, p.longitude, p.port_radius_km, x, y, z])
    names = ("id", "name", "lat", "lon", "radius", "x", "y", "z")
    rows = [dict(zip(names, row)) for row in rows]
    return F.from_json(F.lit(json.dumps(rows)), _PORT_TYPE)


_PLACE = ("_x", "_y", "_z")


def _placed(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Add the position's unit vector, which the comparison with every port shares."""
    vector = unit_vector(F.col(lat), F.col(lon))
    return df.select("*", *[part.alias(name) for part, name in zip(vector, _PLACE)])


def _chord(vector: tuple[Column, ...]) -> Column:
    return squared_chord(tuple(F.col(name) for name in _PLACE), vector)


def _candidate(vector: tuple[Column, ...], ordinal: Column, lat: Column, lon: Column, radius: Column) -> Column:
    """A port as seen from the position: candidates compare by squared chord, then by ordinal."""
    return F.struct(
        _chord(vector).alias("chord"),
        ordinal.alias("ordinal"),
        lat.alias("lat"),
        lon.alias("lon"),
        radius.alias("radius"),
    )


def _candidates(ports: Sequence[Port]) -> list[Column]:
    """The candidates of all ports, as written-out expressions."""
    return [
        _candidate(
            unit_vector(p.latitude, p.longitude),
            F.lit(i),
            F.lit(float(p.latitude)),
            F.lit(float(p.longitude)),
            F.lit(float(p.port_radius_km)),
        )
        for i, p in enumerate(ports)
    ]


def _listed_candidate(port: Column, ordinal: Column) -> Column:
    return _candidate((port["x"], port["y"], port["z"]), ordinal, port["lat"], port["lon"], port["radius"])


def _candidate_array(ports: Sequence[Port]) -> Column:
    if len(ports) <= UNROLLED_PORTS:
        return F.array(*_candidates(ports))
    return F.transform(_port_array(ports), _listed_candidate)


def _with_nearest(df: DataFrame, ports: Sequence[Port]) -> DataFrame:
    """Add ``_nearest``: the nearest port's candidate, the lower ordinal on equal distance.

    It is drawn from a one-element array: a filter on a generated column is not rewritten into a filter
    on its expression, which would compare all ports once per use.
    """
    if len(ports) == 1:
        best = _candidates(ports)[0]
    elif len(ports) <= UNROLLED_PORTS:
        best = F.least(*_candidates(ports))
    else:
        df = _with_cell_candidates(df, ports)
        best = F.array_min(F.transform("_ports", lambda port: _listed_candidate(port, port["ordinal"])))
    return df.select("*", F.explode(F.array(best)).alias("_nearest"))


def _cell() -> Column:
    """Number of the one-degree cell a unit vector points to; out-of-range degrees have a vector, too."""
    row = F.least(F.floor(F.degrees(F.asin(F.greatest(F.least(F.col("_z"), F.lit(1.0)), F.lit(-1.0))))), F.lit(89))
    column = F.least(F.floor(F.degrees(F.atan2("_y", "_x"))), F.lit(179))
    return (row + 90) * 360 + column + 180


def _reachable(cells: DataFrame, degrees: int) -> DataFrame:
    """Keep, of each cell's ``_ports``, those that can be nearest to some point of the cell.

    No point of a cell is more than ``degrees`` from its centre. With the centre's nearest port d degrees
    away, a point's nearest port is at most ``d + 2 * degrees`` from the centre.
    """
    reach = 2 * math.radians(degrees) + 1e-9
    chords = F.transform("_ports", lambda port: _chord((port["x"], port["y"], port["z"])))
    nearest = F.array_min(F.col("_chords"))
    limit = F.least(2 * F.asin(F.least(F.sqrt(nearest) / 2, F.lit(1.0))) + reach, F.lit(math.pi))
    measured = _placed(cells, "_lat", "_lon").select("*", F.explode(F.array(chords)).alias("_chords"))
    limited = measured.withColumn("_limit", F.pow(2 * F.sin(limit / 2), F.lit(2.0)) + 1e-12)
    kept = F.filter("_ports", lambda port, i: F.element_at("_chords", i + 1) <= F.col("_limit"))
    return limited.select("_cell", kept.alias("_ports"))


def _cell_ports(spark: SparkSession, ports: Sequence[Port]) -> DataFrame:
    """The ports worth comparing for each of the 64,800 one-degree cells, found by way of ten-degree cells."""
    listed = F.transform(
        _port_array(ports),
        lambda port, i: F.struct(
            i.alias("ordinal"), *[port[name].alias(name) for name in ("x", "y", "z", "lat", "lon", "radius")]
        ),
    )
    cell = F.col("_cell")
    coarse = spark.range(0, 18 * 36, 1, 18).select(
        F.col("id").alias("_cell"),
        (F.floor(F.col("id") / 36) * 10 - 85.0).alias("_lat"),
        (F.col("id") % 36 * 10 - 175.0).alias("_lon"),
        listed.alias("_ports"),
    )
    wide = _reachable(coarse, 10).withColumnRenamed("_cell", "_wide_cell")
    fine = spark.range(0, 180 * 360, 1, 64).withColumnRenamed("id", "_cell")
    row, column = F.floor(cell / 360), cell % 360
    placed = fine.select(
        "_cell",
        (row - 89.5).alias("_lat"),
        (column - 179.5).alias("_lon"),
        (F.floor(row / 10) * 36 + F.floor(column / 10)).alias("_own_wide_cell"),
    )
    return _reachable(placed.join(wide, F.col("_own_wide_cell") == F.col("_wide_cell")), 1)


def _with_cell_candidates(df: DataFrame, ports: Sequence[Port]) -> DataFrame:
    """Add the few ports worth comparing. The cells are broadcast if their port lists are short in total."""
    spark = df.sparkSession
    cells = store(_cell_ports(spark, ports), scratch_dir(spark))
    listed = cells.agg(F.sum(F.size("_ports"))).first()[0]
    sized = F.broadcast(cells) if listed <= MAX_LISTED_PORTS else cells.hint("shuffle_hash")
    return df.withColumn("_own_cell", _cell()).join(sized, F.col("_own_cell") == F.col("_cell"), "left")


def nearest_port(df: DataFrame, ports: Sequence[Port], lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Add the nearest port's columns, its distance and whether the position lies within its radius.

    Ports are compared by their straight-line distance on the unit sphere, a few multiplications each;
    the great-circle distance is computed for the nearest one only. A few ports are all compared, in the
    scan and without a join; of many ports, only those that can be nearest to the position's one-degree
    cell. Rows without a coordinate keep null port columns and are not within any radius.
    """
    if not ports:
        raise ValueError("no ports given")
    found = _with_nearest(_placed(df, lat, lon), ports)
    known = F.col("_nearest.chord").isNotNull()
    port = F.element_at(_port_array(ports), F.col("_nearest.ordinal") + 1)
    km = haversine_km(F.col(lat), F.col(lon), F.col("_nearest.lat"), F.col("_nearest.lon"))
    return found.select(
        *df.columns,
        F.when(known, port["id"]).alias("nearest_port_id"),
        F.when(known, port["name"]).alias("nearest_port_name"),
        F.when(known, F.col("_nearest.lat")).alias("port_latitude"),
        F.when(known, F.col("_nearest.lon")).alias("port_longitude"),
        F.when(known, F.col("_nearest.radius")).alias("port_radius_km"),
        km.alias("distance_to_port_km"),
        F.coalesce(km <= F.col("_nearest.radius"), F.lit(False)).alias("is_within_port_radius"),
    )


def nearest_ports(
    df: DataFrame, ports: Sequence[Port], k: int, lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """The k nearest ports of each position, one row per port with its rank."""
    if not ports:
        raise ValueError("no ports given")
    located = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    ranked = F.slice(F.array_sort(_candidate_array(ports)), 1, k)
    exploded = _placed(located, lat, lon).select("*", F.posexplode(ranked).alias("_rank", "_port"))
    port = F.element_at(_port_array(ports), F.col("_port.ordinal") + 1)
    km = haversine_km(F.col(lat), F.col(lon), F.col("_port.lat"), F.col("_port.lon"))
    return exploded.select(
        *df.columns,
        (F.col("_rank") + 1).alias("port_rank"),
        port["id"].alias("port_id"),
        km.alias("distance_to_port_km"),
        (km <= F.col("_port.radius")).alias("is_within_port_radius"),
    )
