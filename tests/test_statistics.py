import hashlib
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from portflow.operators.congestion import (
    congestion_base,
    congestion_index,
    congestion_weights,
    latest_rejection_rate,
    minmax_normalize,
    weighted_index,
)
from portflow.operators.percentiles import exact_percentile
from portflow.operators.sampling import rejected_capture, sample_by_class, sample_exact
from portflow.sources.ports import DEFAULT_PORTS


def percentile_by_hand(values, p):
    ordered = sorted(values)
    rank = (len(ordered) - 1) * p
    low = int(rank)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] * (1 - (rank - low)) + ordered[high] * (rank - low)


@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("bin_width", [0.5, 60.0, 1e6])
def test_percentile_against_sorting(spark, fraction, bin_width):
    rng = random.Random(7)
    groups = {
        "one": [42.0],
        "two": [1.0, 2.0],
        "same": [5.0] * 30,
        "far": [1.0, 1000.0],
        "many": [rng.choice([rng.uniform(0, 500), 120.0]) for _ in range(300)],
        "below": [-30.5, -10.0, 3.0, 70.0],
    }
    rows = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("one", None)], "k string, v double")
    found = {r.k: r.p for r in exact_percentile(rows, ["k"], "v", fraction, bin_width, "p").collect()}
    assert found.keys() == groups.keys()
    for k, vs in groups.items():
        assert found[k] == pytest.approx(percentile_by_hand(vs, fraction), abs=1e-9), k


def test_percentile_agrees_with_the_built_in(spark):
    rows = spark.range(5000).selectExpr("id % 3 as k", "double((id * 7919) % 4999) / 7 as v")
    ours = exact_percentile(rows, ["k"], "v", 0.9, 60.0, "p")
    built_in = rows.groupBy("k").agg(F.percentile("v", 0.9).alias("q"))
    assert all(abs(r.p - r.q) < 1e-9 for r in ours.join(built_in, "k").collect())


def test_normalize(spark):
    rows = spark.createDataFrame([(0, 10, "a"), (50, 10, "a"), (100, 10, "b")], "x int, same int, day string")
    got = {r.x: (r.nx, r.ns) for r in minmax_normalize(rows, {"x": "nx", "same": "ns"}).collect()}
    assert got == {0: (0.0, 0.0), 50: (0.5, 0.0), 100: (1.0, 0.0)}
    by_day = {r.x: r.nx for r in minmax_normalize(rows, {"x": "nx"}, ["day"]).collect()}
    assert by_day == {0: 0.0, 50: 1.0, 100: 0.0}


def test_normalizing_nothing_and_one_row(spark):
    rows = spark.createDataFrame([(3, 4)], "x int, y int")
    assert minmax_normalize(rows.limit(0), {"x": "nx"}).count() == 0
    assert weighted_index(rows, {"x": 0.4, "y": 0.6}, "score").first().score == 0.0


def test_index_weights(spark, settings):
    names = list(congestion_weights(settings))
    rows = spark.createDataFrame([(1.0, 0.5, 0.0, "it"), (0.0, 0.0, 0.0, "low"), (0.0, 1.0, 1.0, "high")], [*names, "id"])
    scored = weighted_index(rows, congestion_weights(settings), "score")
    assert scored.where("id = 'it'").first().score == pytest.approx(0.575)


# Published tables: stopped vessels, mean dwell, stopped positions -> index.
PUBLISHED = {
    "large sample": [
        (279, 211.16, 13400, 0.6649),
        (614, 121.13, 19626, 0.6500),
        (257, 183.93, 9834, 0.4906),
        (272, 126.38, 8856, 0.2635),
        (64, 167.32, 2610, 0.1796),
    ],
    "small sample": [
        (12, 42.02, 281, 0.6405),
        (8, 40.50, 384, 0.5045),
        (1, 47.97, 191, 0.4487),
        (4, 44.40, 173, 0.3765),
        (1, 41.85, 65, 0.0633),
    ],
}


@pytest.mark.parametrize("name", PUBLISHED)
def test_published_scores(spark, settings, name):
    names = [*congestion_weights(settings), "published"]
    rows = spark.createDataFrame(PUBLISHED[name], names)
    scored = weighted_index(rows, congestion_weights(settings), "score")
    assert all(abs(round(r.score, 4) - r.published) <= 1.01e-4 for r in scored.collect())


def test_published_counts_are_consistent():
    assert 1121 + 3 + 2 == 1126 and 498_874 + 1126 == 500_000
    assert 165 + 365 + 166 + 99 + 202 == 997


PROXIMITY = (
    "mmsi string, event_timestamp timestamp_ntz, speed_knots double, nearest_port_id string,"
    " is_within_port_radius boolean"
)
STOPS = "mmsi string, nearest_port_id string, stop_date date, dwell_time_minutes double"
ANOMALIES = "event_timestamp timestamp_ntz, nearest_port_id string, is_within_port_radius boolean"
REPORT = "rejection_rate double, created_at timestamp"


@pytest.fixture
def tables(spark):
    day = datetime(2024, 1, 1, 10)
    proximity = spark.createDataFrame(
        [("a", day, 0.1, "houston", True), ("a", day, 5.0, "houston", True), ("b", day, 5.0, "houston", False)], PROXIMITY
    )
    stops = spark.createDataFrame([("a", "houston", day.date(), 40.0), ("c", "savannah", day.date(), 50.0)], STOPS)
    anomalies = spark.createDataFrame([(day, "nowhere", True), (day, "houston", False)], ANOMALIES)
    report = spark.createDataFrame([(0.5, datetime(2024, 1, 1)), (0.25, datetime(2024, 1, 2))], REPORT)
    return proximity, stops, anomalies, report


def test_full_join_keeps_the_keys_of_every_source(tables, settings):
    base = congestion_base(*tables, settings, DEFAULT_PORTS)
    rows = {r.port_id: r for r in base.collect()}
    assert rows.keys() == {"houston", "savannah", "nowhere"}
    houston = rows["houston"]
    assert (houston.vessels_near_port, houston.stopped_position_count, houston.stopped_vessels) == (1, 1, 1)
    assert (houston.avg_dwell_time_minutes, houston.p90_dwell_time_minutes, houston.anomaly_count) == (40.0, 40.0, 0)
    assert (rows["savannah"].port_name, rows["savannah"].vessels_near_port) == ("Savannah", 0)
    assert (rows["nowhere"].port_name, rows["nowhere"].anomaly_count) == ("nowhere", 1)
    assert {r.data_quality_rejection_rate for r in rows.values()} == {0.25}


def test_left_join_keeps_positions_only(tables, settings):
    proximity, stops, _, report = tables
    base = congestion_base(proximity, stops, None, report, settings, DEFAULT_PORTS, "left")
    row, = base.collect()
    assert (row.port_id, row.anomaly_count) == ("houston", 0)


def test_without_a_report_the_rate_is_null_and_rows_stay(tables, settings):
    proximity, stops, anomalies, report = tables
    base = congestion_base(proximity, stops, anomalies, report.limit(0), settings, DEFAULT_PORTS)
    scored = congestion_index(base, settings).collect()
    assert len(scored) == 3 and all(r.data_quality_rejection_rate is None for r in scored)


def test_latest_report(spark, tables):
    assert spark.range(1).select(latest_rejection_rate(tables[3])).first()[0] == 0.25


def test_scores_within_a_day_ignore_other_days(tables, settings):
    proximity, stops, anomalies, report = tables
    later = stops.withColumn("stop_date", F.lit(date(2024, 1, 9))).withColumn("dwell_time_minutes", F.lit(9999.0))
    one = congestion_index(congestion_base(proximity, stops, anomalies, report, settings, DEFAULT_PORTS), settings, ["report_date"])
    both = congestion_index(
        congestion_base(proximity, stops.unionByName(later), anomalies, report, settings, DEFAULT_PORTS),
        settings,
        ["report_date"],
    ).where("report_date = date'2024-01-01'")
    pick = lambda df: sorted((r.port_id, r.port_congestion_index) for r in df.collect())
    assert pick(one) == pick(both)


def token(values, seed):
    return hashlib.sha256("|".join([*map(str, values), str(seed)]).encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 137, 999, 1000, 5000])
@pytest.mark.parametrize("partitions", [1, 6])
def test_sample_is_the_lowest_tokens(spark, n, partitions):
    rows = spark.range(1000).repartition(partitions)
    got = sorted(r.id for r in sample_exact(rows, n, 42, ["id"]).collect())
    assert got == sorted(sorted(range(1000), key=lambda i: token([i], 42))[:n])


def test_sample_of_identical_rows_has_the_exact_size(spark):
    rows = spark.createDataFrame([("same", 1)] * 400 + [(f"r{i}", i) for i in range(50)], "a string, b int")
    for n in (1, 30, 200, 425, 450, 500):
        assert sample_exact(rows, n, 1, ["a"]).count() == min(n, 450)


def test_sample_differs_by_seed(spark):
    rows = spark.range(1000)
    first, second = ({r.id for r in sample_exact(rows, 100, seed, ["id"]).collect()} for seed in (1, 2))
    assert first != second


def flagged(spark, bad, good):
    rows = [(i, ["x"] if i < bad else []) for i in range(bad + good)]
    return spark.createDataFrame(rows, "id int, quality_reasons array<string>")


@pytest.mark.parametrize("bad, good, expected", [(50, 500, (20, 80)), (5, 500, (5, 95)), (50, 10, (20, 10)), (0, 3, (0, 3))])
def test_sample_by_class(spark, bad, good, expected):
    taken = sample_by_class(flagged(spark, bad, good), 100, 20, 42, ["id"])
    sizes = [taken.where(F.size("quality_reasons") > 0).count(), taken.where(F.size("quality_reasons") == 0).count()]
    assert tuple(sizes) == expected


def test_rejected_capture(spark):
    caught = rejected_capture(flagged(spark, 30, 30), 10, 42, ["id"]).collect()
    assert len(caught) == 10 and all(r.quality_reasons == "x" and r.id < 30 for r in caught)


def test_rows_of_a_null_group_are_normalized_too(spark):
    rows = spark.createDataFrame([(1, 2.0), (1, 4.0), (None, 5.0), (None, 9.0)], "day int, value double")
    found = sorted((r.value, r.scaled) for r in minmax_normalize(rows, {"value": "scaled"}, ["day"]).collect())
    assert found == [(2.0, 0.0), (4.0, 1.0), (5.0, 0.0), (9.0, 1.0)]


def test_sample_by_class_refuses_a_cap_above_its_size(spark):
    with pytest.raises(ValueError):
        sample_by_class(spark.createDataFrame([(1, ["x"])], "id int, quality_reasons array<string>"), 10, 50, 1, ["id"])
