import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from portflow.operators.sessions import (
    episodes,
    episodes_by_session_window,
    position_gaps,
    sessionize,
    vessel_stops,
)
from portflow.sources.ports import DEFAULT_PORTS

START = datetime(2024, 1, 1)
SCHEMA = "key string, ts timestamp_ntz, speed double, id int"


def series(spark, times, key="v", speed=0.5):
    return spark.createDataFrame([(key, t, speed, i) for i, t in enumerate(times)], SCHEMA)


def minutes(*offsets):
    return [START + timedelta(minutes=m) for m in offsets]


def bounds(df):
    return sorted((r.key, r.episode, r.episode_start, r.episode_end, r.message_count) for r in df.collect())


def by_hand(rows, gap):
    """Episodes per key by walking the sorted times."""
    found = []
    for key in sorted({k for k, *_ in rows}):
        times = sorted(t for k, t, *_ in rows if k == key)
        runs = [[times[0]]]
        for t in times[1:]:
            if t - runs[-1][-1] > timedelta(minutes=gap):
                runs.append([])
            runs[-1].append(t)
        found += [(key, i + 1, run[0], run[-1], len(run)) for i, run in enumerate(runs)]
    return found


def test_a_gap_of_exactly_the_limit_does_not_split(spark):
    exact = episodes(series(spark, minutes(0, 60, 120)), ["key"], "ts", 60)
    assert bounds(exact) == [("v", 1, *minutes(0, 120), 3)]
    over = [START, START + timedelta(minutes=60, microseconds=1)]
    assert len(bounds(episodes(series(spark, over), ["key"], "ts", 60))) == 2


def test_episode_average(spark):
    rows = spark.createDataFrame([("v", START, 0.25, 1), ("v", START, 0.5, 2), ("v", START, None, 3)], SCHEMA)
    row = episodes(rows, ["key"], "ts", 60, "speed").first()
    assert (row.message_count, row.avg_speed) == (3, 0.375)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("gap", [7, 60])
def test_episodes_against_a_walk(spark, seed, gap):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(6)}"
        # Times before 1970 and repeated times included.
        offset = timedelta(seconds=rng.choice([0, 1]) * rng.randrange(0, 400_000) + rng.randrange(3))
        rows.append((key, datetime(1969, 12, 31) + offset, rng.random(), i))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    expected = by_hand(rows, gap)
    assert bounds(episodes(df, ["key"], "ts", gap)) == expected
    window = episodes_by_session_window(df, ["key"], "ts", gap).collect()
    assert sorted((r.key, r.episode_start, r.episode_end, r.message_count) for r in window) == sorted(
        (k, a, b, n) for k, _, a, b, n in expected
    )
    numbered = {r.id: r.episode for r in sessionize(df, ["key"], "ts", gap).collect()}
    assert len(numbered) == len(rows)
    span = {(k, e): (a, b) for k, e, a, b, _ in expected}
    for key, ts, _, i in rows:
        first, last = span[(key, numbered[i])]
        assert first <= ts <= last


def test_gap_table(spark):
    times = minutes(0, 0, 30, 59.5, 61, 200)
    rows = {r.ts: r for r in position_gaps(series(spark, times), ["key"], "ts", 60).collect()}
    assert [rows[t].message_count for t in sorted(rows)] == [2, 1, 1, 1, 1]
    assert [rows[t].gap_minutes for t in sorted(rows)] == [None, 30.0, 29.5, 1.5, 139.0]
    assert [rows[t].is_new_episode for t in sorted(rows)] == [True, False, False, False, True]
    assert [rows[t].episode for t in sorted(rows)] == [1, 1, 1, 1, 2]


def test_rows_without_a_key_keep_their_own_episodes(spark):
    rows = spark.createDataFrame([(None, START, 1.0, 1), (None, START + timedelta(hours=3), 1.0, 2)], SCHEMA)
    assert {r.id: r.episode for r in sessionize(rows, ["key"], "ts", 60).collect()} == {1: 1, 2: 2}


def near_port(spark, rows):
    """(mmsi, minute, speed) messages inside Houston's radius."""
    records = [(m, START + timedelta(minutes=t), s, "houston", True) for m, t, s in rows]
    return spark.createDataFrame(
        records,
        "mmsi string, event_timestamp timestamp_ntz, speed_knots double, nearest_port_id string,"
        " is_within_port_radius boolean",
    )


def test_stops_need_speed_below_and_dwell_at_the_limit(spark, settings):
    rows = near_port(spark, [("a", 0, 0.0), ("a", 30, 0.9), ("b", 0, 0.0), ("b", 29, 0.0), ("c", 0, 1.0), ("c", 45, 0.0)])
    row, = vessel_stops(rows, settings, DEFAULT_PORTS).collect()
    assert (row.mmsi, row.dwell_time_minutes, row.message_count, row.nearest_port_name) == ("a", 30.0, 2, "Houston")
    assert row.stop_label == "a_houston_20240101T000000_1"


def test_only_kept_stops_are_numbered(spark, settings):
    rows = near_port(spark, [("a", t, 0.0) for t in (0, 40, 300, 310, 600, 655)])
    labels = [r.stop_label for r in vessel_stops(rows, settings, DEFAULT_PORTS).orderBy("stop_start_timestamp").collect()]
    assert labels == ["a_houston_20240101T000000_1", "a_houston_20240101T100000_2"]


def test_stop_over_midnight_belongs_to_its_first_day(spark, settings):
    rows = near_port(spark, [("a", 1420, 0.0), ("a", 1460, 0.0)])
    row = vessel_stops(rows, settings, DEFAULT_PORTS).first()
    assert (str(row.stop_date), row.year, row.month) == ("2024-01-01", 2024, 1)


def test_candidates_name_vessel_port_and_time(spark, settings):
    rows = near_port(spark, [("", 0, 0.0), ("", 50, 0.0), (None, 0, 0.0), ("a", 0, 0.0), ("a", 50, 0.0)])
    outside = rows.withColumn("is_within_port_radius", F.lit(False))
    assert vessel_stops(rows.unionByName(outside), settings, DEFAULT_PORTS).count() == 1


def test_rows_are_combined_before_they_are_ordered(spark, settings):
    """A vessel with very many messages reaches the ordered window as one row per slot."""
    rows = spark.range(200_000).selectExpr(
        "'hot' as key", "timestampadd(SECOND, int(id % 7200), timestamp_ntz'2024-01-01 00:00:00') as ts"
    )
    found = episodes(rows, ["key"], "ts", 60)
    row, = found.collect()
    assert row.message_count == 200_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("partial_min") or "HashAggregate" in plan
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_wide_settings(spark, settings):
    wide = replace(settings, max_gap_minutes=1440, min_dwell_minutes=720.0)
    rows = near_port(spark, [("a", t, 0.0) for t in (0, 1000, 2440, 5000)])
    row, = vessel_stops(rows, wide, DEFAULT_PORTS).collect()
    assert (row.dwell_time_minutes, row.message_count) == (2440.0, 3)
