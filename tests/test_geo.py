import math
import random

import pytest
from pyspark.sql import functions as F

from portflow.functions.geo import haversine_km
from portflow.operators.nearest import UNROLLED_PORTS, nearest_port, nearest_ports
from portflow.sources.ports import DEFAULT_PORTS, Port, load_ports, ports_frame


def distance(spark, *point):
    return spark.range(1).select(haversine_km(*point)).first()[0]


def expected_km(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h)))


def test_known_distances(spark):
    assert distance(spark, 0, 0, 0, 0) == 0
    assert 3900 <= distance(spark, 34.0522, -118.2437, 40.7128, -74.0060) <= 4000
    assert distance(spark, 12.3, 45.6, -12.3, -134.4) == pytest.approx(math.pi * 6371.0, abs=1e-3)


def test_distance_is_null_without_a_coordinate(spark):
    row = spark.createDataFrame([(None, 1.0)], "lat double, lon double")
    assert row.select(haversine_km(F.col("lat"), F.col("lon"), 0.0, 0.0)).first()[0] is None


def positions(spark, rows):
    return spark.createDataFrame(rows, "id int, latitude double, longitude double")


@pytest.mark.parametrize("ports", [1, 5, UNROLLED_PORTS + 40])
def test_nearest_port_against_brute_force(spark, ports):
    rng = random.Random(ports)
    chosen = [Port(f"p{i}", f"P{i}", rng.uniform(-80, 80), rng.uniform(-180, 180), 900.0) for i in range(ports)]
    rows = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(200)]
    found = {r.id: r for r in nearest_port(positions(spark, rows), chosen).collect()}
    for i, lat, lon in rows:
        km = [expected_km(lat, lon, p.latitude, p.longitude) for p in chosen]
        best = min(range(ports), key=lambda j: km[j])
        assert found[i].nearest_port_id == chosen[best].port_id
        assert found[i].distance_to_port_km == pytest.approx(km[best], abs=1e-6)
        assert found[i].is_within_port_radius == (km[best] <= 900.0)


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_many_ports_in_clusters_and_at_the_edges(spark, monkeypatch, limit):
    from portflow.operators import nearest

    monkeypatch.setattr(nearest, "MAX_LISTED_PORTS", limit)
    rng = random.Random(3)
    spots = [(0.0, 179.99), (0.0, -179.99), (89.9, 10.0), (-89.9, -170.0), (45.0, 45.0), (-90.0, 0.0)]
    spots += [(45.0 + rng.uniform(-0.5, 0.5), 45.0 + rng.uniform(-0.5, 0.5)) for _ in range(60)]
    ports = [Port(f"p{i}", f"P{i}", lat, lon, 50.0) for i, (lat, lon) in enumerate(spots)]
    rows = [(i, lat, lon) for i, (lat, lon) in enumerate(
        [(0.0, 180.0), (0.0, -180.0), (90.0, 0.0), (-90.0, 0.0), (45.0, 46.0), (44.999, 44.999), (91.0, 10.0), (2.0, 300.0)]
        + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(150)]
        + [(45 + rng.uniform(-2, 2), 45 + rng.uniform(-2, 2)) for _ in range(150)]
    )] + [(999, None, 1.0)]
    found = {r.id: r for r in nearest_port(positions(spark, rows), ports).collect()}
    assert len(found) == len(rows) and found[999].nearest_port_id is None
    for i, lat, lon in rows[:-1]:
        km = min(expected_km(lat, lon, p.latitude, p.longitude) for p in ports)
        assert found[i].distance_to_port_km == pytest.approx(km, abs=1e-5), (lat, lon)


def test_equal_distances_keep_the_first_port(spark):
    for twins in ([("a", 10.0), ("b", -10.0)], [("b", -10.0), ("a", 10.0)]):
        ports = [Port(name, name, 0.0, lon, 20.0) for name, lon in twins]
        assert nearest_port(positions(spark, [(1, 0.0, 0.0)]), ports).first().nearest_port_id == twins[0][0]


def test_missing_coordinate_has_no_port(spark):
    row = nearest_port(positions(spark, [(1, None, 5.0), (2, 5.0, None)]), DEFAULT_PORTS).first()
    assert row.nearest_port_id is None and row.distance_to_port_km is None and row.port_radius_km is None
    assert row.is_within_port_radius is False


def test_radius_is_inclusive(spark):
    km = distance(spark, 0, 0, 0, 1)
    for radius, within in ((km, True), (math.nextafter(km, 0), False)):
        port = [Port("p", "P", 0.0, 1.0, radius)]
        assert nearest_port(positions(spark, [(1, 0.0, 0.0)]), port).first().is_within_port_radius is within


def test_ranking_starts_with_the_nearest(spark):
    rows = positions(spark, [(1, 30.0, -95.0), (2, None, 1.0)])
    ranked = nearest_ports(rows, DEFAULT_PORTS, 3).orderBy("port_rank").collect()
    assert [r.port_rank for r in ranked] == [1, 2, 3]
    assert ranked[0].port_id == "houston"
    assert ranked[0].distance_to_port_km <= ranked[1].distance_to_port_km <= ranked[2].distance_to_port_km


def test_nearest_port_needs_neither_shuffle_nor_join(spark):
    plan = nearest_port(spark.range(10).selectExpr("double(id) latitude", "double(id) longitude"), DEFAULT_PORTS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Join" not in text and "Python" not in text


def test_empty_and_oversized_ports(spark):
    ports = ports_frame(spark).withColumnsRenamed({"latitude": "port_latitude", "longitude": "port_longitude"})
    with pytest.raises(ValueError):
        load_ports(ports.limit(0))
    with pytest.raises(ValueError):
        load_ports(ports, max_bytes=100)
    with pytest.raises(ValueError):
        nearest_port(positions(spark, [(1, 0.0, 0.0)]), [])
    assert load_ports(ports) == DEFAULT_PORTS
