import math
import random

import pytest
from pyspark.sql import functions as F

from portflow.functions.geo import haversine_km
from portflow.operators import places
from portflow.operators.nearest import nearest_port
from portflow.sources.ports import DEFAULT_PORTS, ports_frame

SCHEMA = "port_id string, port_name string, port_latitude double, port_longitude double, port_radius_km double"
EDGES = [(90.0, 0.0), (-90.0, 77.0), (0.0, 180.0), (0.0, -180.0), (51.0, 179.9999), (51.0, -179.9999), (89.99, 10.0), (0.0, 0.0)]


def points(seed, n, clusters=4):
    rng = random.Random(seed)
    middle = [(rng.uniform(-80, 80), rng.uniform(-180, 180)) for _ in range(clusters)]
    out = list(EDGES)
    for _ in range(n):
        if rng.random() < 0.6:
            lat, lon = rng.choice(middle)
            out.append((lat + rng.gauss(0, 0.05), lon + rng.gauss(0, 0.05)))
        else:
            out.append((math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)))
    return out


def tables(spark, n_places=500, n_rows=150):
    rng = random.Random(3)
    where = points(1, n_places)
    where += where[20:40]  # places in one spot
    rows = [("p%05d" % i, "name %d" % i, lat, lon, rng.choice([0.5, 20.0, 150.0, 2_000.0, 15_000.0])) for i, (lat, lon) in enumerate(where)]
    rows += [("gone1", None, None, 1.0, 5.0), ("gone2", None, 1.0, None, 5.0), ("gone3", "n", 1.0, 1.0, None)]
    seen = points(1, 60) + points(2, n_rows)
    positions = [(i, lat, lon) for i, (lat, lon) in enumerate(seen)] + [(-1, None, 1.0), (-2, 1.0, None)]
    return (
        spark.createDataFrame(rows, SCHEMA).repartition(4),
        spark.createDataFrame(positions, "id int, latitude double, longitude double").repartition(4),
    )


def all_pairs(df, ports):
    """Every position with every place, as a check only."""
    km = haversine_km(F.col("latitude"), F.col("longitude"), F.col("port_latitude"), F.col("port_longitude"))
    one = F.lit(1).alias("one")
    return df.select("*", one).join(ports.select("*", one), "one").withColumn("km", km).where("km is not null")


@pytest.fixture(scope="module")
def data(spark):
    ports, positions = tables(spark)
    return ports, positions, [tuple(r) for r in all_pairs(positions, ports).select("id", "port_id", "km", "port_radius_km").collect()]


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_places_equal_all_pairs(data, k):
    ports, positions, pairs = data
    index = places.build_index(ports, k)
    assert len(index.levels) > 2 and index.cells.agg(F.max(F.size("places"))).first()[0] < 400
    found = {}
    for r in places.nearest_places(positions, index, k).collect():
        found.setdefault(r.id, []).append((r.port_rank, round(r.distance_to_port_km, 6)))
    wanted = {}
    for key, _, km, _ in pairs:
        wanted.setdefault(key, []).append(km)
    assert {key: sorted(rows) for key, rows in found.items()} == {
        key: [(i + 1, round(km, 6)) for i, km in enumerate(sorted(rows)[:k])] for key, rows in wanted.items()
    }
    with pytest.raises(ValueError):
        places.nearest_places(positions, index, k + 1)


def test_an_index_for_few_positions_has_few_cells(spark, data):
    ports, positions, _ = data
    few = positions.where("id % 40 = 3 OR id < 0")
    whole, part = places.build_index(ports, 3), places.build_index(ports, 3, near=few)
    assert part.cells.count() <= few.count() < whole.cells.count()
    ours, theirs = (sorted(map(tuple, places.nearest_places(few, index, 3).collect())) for index in (part, whole))
    assert ours == theirs and len(ours) == 3 * few.where("id >= 0").count()
    nowhere = positions.where("id < 0")
    index = places.build_index(ports, near=nowhere)
    assert places.nearest_places(nowhere, index).count() == 0 and places.nearest_place(nowhere, index).count() == 2


def test_an_index_for_few_positions_stores_few_pairs(spark, monkeypatch):
    rng = random.Random(5)
    where = [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(12_000)]
    ports = spark.createDataFrame([("p%05d" % i, "n", lat, lon, 20.0) for i, (lat, lon) in enumerate(where)], SCHEMA).repartition(4)
    few = [(i, lat + 0.001, lon) for i, (lat, lon) in enumerate(where[:200])] + [(200, 90.0, 0.0), (201, 0.0, 180.0), (202, 0.0, -180.0)]
    few = spark.createDataFrame(few, "id int, latitude double, longitude double")
    stored, store = [], places.store
    monkeypatch.setattr(places, "store", lambda rows, *options: stored.append(store(rows, *options)) or stored[-1])
    index = places.build_index(ports, near=few)
    # Pairs of cells and cubes over all depths, and tables of places: the last ones leave out what no open cell has met.
    assert sum(rows.count() for rows in stored if "cube" in rows.columns) < 40 * 203
    kept = [rows.count() for rows in stored if set(places.PLACE) <= set(rows.columns)]
    assert kept[0] == 12_000 and kept[-1] < 6_000
    best = all_pairs(few, ports).groupBy("id").agg(F.min(F.struct(F.round("km", 6), "port_id")).alias("best"))
    found = places.nearest_place(few, index).select("id", F.struct(F.round("distance_to_port_km", 6), "nearest_port_id").alias("best"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, best.collect()))


def test_nearest_place_keeps_every_row(spark, data):
    _, positions, _ = data
    index = places.build_index(ports_frame(spark).withColumnsRenamed({"latitude": "port_latitude", "longitude": "port_longitude"}))
    ours = places.nearest_place(positions, index)
    theirs = nearest_port(positions, DEFAULT_PORTS).select(ours.columns)
    assert sorted(map(str, ours.collect())) == sorted(map(str, theirs.collect())) and ours.count() == positions.count()
    with pytest.raises(ValueError):
        places.build_index(spark.createDataFrame([("x", "y", None, 1.0, 1.0)], SCHEMA))


def test_places_in_one_spot_are_ranked_by_id(spark):
    rows = [("p%03d" % i, "n", 10.0, 20.0, 1.0) for i in range(90)]
    index = places.build_index(spark.createDataFrame(rows, SCHEMA), 3)
    found = places.nearest_places(spark.createDataFrame([(1, 10.0, 20.1)], "id int, latitude double, longitude double"), index, 3)
    assert [r.port_id for r in found.orderBy("port_rank").collect()] == ["p000", "p001", "p002"]


def test_places_within_radius_equal_all_pairs(spark, data):
    ports, positions, pairs = data
    found = sorted((r.id, r.port_id) for r in places.places_within_radius(positions, ports).collect())
    assert found == sorted((key, port) for key, port, km, radius in pairs if radius is not None and km <= radius)
    by_id = {key for key, _ in found}
    assert by_id >= {0, 1, 2, 3, 4, 5, 6}
    assert places.places_within_radius(positions, ports.limit(0)).count() == 0


def test_searches_are_equi_joins(spark, data):
    ports, positions, _ = data
    index = places.build_index(ports, 2)
    for plan in (places.nearest_place(positions, index), places.places_within_radius(positions, ports)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text
    # Nothing but lists of cells is ordered in a search of the k nearest.
    text = places.nearest_places(positions, index, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in text and "\nSort" not in text


def test_within_radius_no_side_passes_the_driver(spark, data, tmp_path):
    ports, positions, pairs = data
    positions.write.parquet(f"{tmp_path}/positions")
    found = places.places_within_radius(spark.read.parquet(f"{tmp_path}/positions"), ports)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Broadcast" not in text
    assert found.count() == sum(radius is not None and km <= radius for _, _, km, radius in pairs)
