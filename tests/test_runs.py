"""Tables of runs, and what is kept up to date batch by batch."""

import os
import random
import signal
import subprocess
import sys
import time
from dataclasses import replace
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from portflow.operators.duplicate_log import DuplicateLog
from portflow.operators.duplicates import FLAG_ALL, KEEP_FIRST
from portflow.operators.sessions import episodes, stops_of_episodes
from portflow.operators.stop_log import StopLog
from portflow.sources import runs
from portflow.sources.ports import DEFAULT_PORTS


def numbers(spark, folder):
    return sorted(r.id for r in runs.read_newest(spark, folder).collect())


def test_a_run_replaces_the_one_before(spark, tmp_path):
    path = str(tmp_path / "it's a `table`")
    assert not runs.has_run(spark, path)
    with pytest.raises(FileNotFoundError):
        runs.read_newest(spark, path)
    assert runs.write_run(spark.range(3), path, counts={"even": F.col("id") % 2 == 0}) == {"rows": 3, "even": 2}
    runs.write_run(spark.range(5, 7), path)
    assert numbers(spark, path) == [5, 6]
    assert runs.read_all_runs(spark, path).groupBy("run").count().count() == 2
    assert runs.run_info(spark, runs.published_runs(spark, path)[0]) == {"rows": 3, "even": 2}


def test_failed_run_never_shows(spark, tmp_path):
    path = str(tmp_path / "t")
    runs.write_run(spark.range(100), path)
    broken = spark.range(0, 1000, 1, 8).withColumn("id", F.when(F.col("id") == 990, F.raise_error(F.lit("x"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(PySparkException):
        runs.write_run(broken, path)
    # A finished write that was not published, as if the driver had died in between.
    spark.range(7).write.parquet(runs.begin_run(spark, path))
    assert numbers(spark, path) == list(range(100))
    runs.write_run(spark.range(2), path)
    assert numbers(spark, path) == [0, 1]
    assert len(runs.retire_runs(spark, path)) >= 2 and numbers(spark, path) == [0, 1]
    assert len(runs.subfolders(spark, path, "run=")) == 1


def test_killed_driver_leaves_the_table(spark, tmp_path):
    """A job of its own is killed in the middle of its write."""
    path = str(tmp_path / "t")
    runs.write_run(spark.range(10), path)
    job = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
from portflow.session import build_session
from portflow.sources.runs import write_run
from pyspark.sql import functions as F
spark = build_session(master="local[2]", **{{"spark.ui.enabled": "false"}})
slow = spark.range(0, 40, 1, 40).withColumn("n", F.expr("reflect('java.lang.Thread', 'sleep', 500L)"))
write_run(slow, {path!r})
"""
    child = subprocess.Popen([sys.executable, "-c", job], stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL, start_new_session=True)
    try:
        deadline = time.time() + 90
        while not list(Path(path).glob("run=*/_temporary/**/*.parquet")) and time.time() < deadline and child.poll() is None:
            time.sleep(0.2)
        assert child.poll() is None
    finally:
        os.killpg(child.pid, signal.SIGKILL)
        child.wait()
    assert len(runs.subfolders(spark, path, "run=")) == 2
    assert numbers(spark, path) == list(range(10))


def test_reader_keeps_its_files(spark, tmp_path):
    path = str(tmp_path / "t")
    runs.write_run(spark.range(4), path)
    before = runs.read_newest(spark, path)
    runs.write_run(spark.range(9), path)
    assert before.count() == 4


def test_views_switch_in_one_step(spark, tmp_path):
    path = str(tmp_path / "it's `here`")
    spark.sql("CREATE DATABASE IF NOT EXISTS switch_check")
    try:
        for n in (3, 8):
            runs.write_run(spark.range(n), path)
            runs.switch_view(spark, "switch_check.t", [runs.newest_run(spark, path)])
            assert spark.table("switch_check.t").count() == n
        # Parts of a table: only the newest run of each is read.
        parts = str(tmp_path / "parts")
        for part, n in (("a", 1), ("b", 2), ("a", 5)):
            runs.write_run(spark.range(n), f"{parts}/batch={part}")
        assert runs.read_newest_parts(spark, parts, "batch").groupBy("batch").count().collect() == [("a", 5), ("b", 2)] or sorted(
            map(tuple, runs.read_newest_parts(spark, parts, "batch").groupBy("batch").count().collect())
        ) == [("a", 5), ("b", 2)]
        newest = [runs.newest_run(spark, f"{parts}/batch={p}") for p in "ab"]
        runs.switch_view(spark, "switch_check.p", newest, parts, ["run"])
        assert spark.table("switch_check.p").columns == ["id", "batch"] and spark.table("switch_check.p").count() == 7
    finally:
        spark.sql("DROP DATABASE switch_check CASCADE")


# --- duplicates ---------------------------------------------------------------------------------

ROWS = "key string, span int, source string, n int"


def expected(batches, policy):
    rows = sorted((r for rows in batches.values() for r in rows), key=lambda r: (r[2], r[3]))
    copies, out = {}, set()
    for row in rows:
        if row[0] is not None:
            copies.setdefault((row[0], row[1]), []).append(row)
    for same in copies.values():
        out |= {(r[2], r[3]) for r in (same[1:] if policy == KEEP_FIRST else same if len(same) > 1 else [])}
    return out


@pytest.mark.parametrize("policy", [KEEP_FIRST, FLAG_ALL])
def test_duplicate_log_equals_one_pass(spark, tmp_path, policy):
    rng = random.Random(6)
    log = DuplicateLog(spark, str(tmp_path / "log"), ["key", "span"], ["source", "n"], policy, within=["span"], prefixes=4)
    batches, number = {}, 0
    # Batch "a" comes back with other rows, and once with none; keys of a span share its folder.
    for name, size in (("b", 12), ("a", 15), ("c", 9), ("a", 8), ("b", 0), ("d", 20)):
        rows = []
        for _ in range(size):
            number += 1
            key = rng.choice([None, *"uvwxyz"])
            rows.append((key, rng.choice([1, 2]), rng.choice(["s1", "s2", name]), number if name != "c" else -number))
        batches[name] = rows
        frame = spark.createDataFrame(rows, ROWS)
        counts = log.add(frame, name)
        assert counts["keys"] == len({r[:2] for r in rows if r[0]})
        assert {tuple(r) for r in log.duplicates().collect()} == expected(batches, policy), name
    everything = spark.createDataFrame([r for rows in batches.values() for r in rows], ROWS)
    flagged = log.flagged(everything).collect()
    assert {(r.source, r.n) for r in flagged if r.is_duplicate} == expected(batches, policy) and len(flagged) == everything.count()


def test_duplicate_log_reads_only_touched_folders(spark, tmp_path):
    log = DuplicateLog(spark, str(tmp_path / "log"), ["key", "span"], ["source", "n"], within=["span"], prefixes=8)
    log.add(spark.createDataFrame([(str(i), i % 3, "s", i) for i in range(60)], ROWS), "first")
    one = log._located(spark.createDataFrame([("5", 2, "t", 1)], ROWS))
    index = log._index(log._batches()).where(log._touched(one))
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    touched = {p.split("kind=index/")[1].rsplit("/", 1)[0] for p in (f.input for f in index.select(F.input_file_name().alias("input")).collect())}
    assert len(touched) == 1 and touched.pop().startswith("at_span=2/prefix=")


def test_duplicate_log_survives_a_cut_off_batch(spark, tmp_path):
    log = DuplicateLog(spark, str(tmp_path / "log"), ["key", "span"], ["source", "n"])
    log.add(spark.createDataFrame([("u", 1, "s", 1), ("u", 1, "s", 2)], ROWS), "one")
    broken = spark.createDataFrame([("u", 1, "a", 3)], ROWS).withColumn("key", F.raise_error(F.lit("x")).cast("string"))
    with pytest.raises(PySparkException):
        log.add(broken, "two")
    assert [tuple(r) for r in log.duplicates().collect()] == [("s", 2)]


# --- stops --------------------------------------------------------------------------------------

SLOW = "mmsi string, nearest_port_id string, event_timestamp timestamp_ntz, speed_knots double"


def slow_messages(seed, n=400):
    rng = random.Random(seed)
    start = datetime(2023, 12, 30)
    rows = []
    for _ in range(n):
        at = start + timedelta(minutes=rng.choice([rng.randint(0, 8_000), 1440 * 2 + rng.randint(-90, 90)]))
        rows.append((rng.choice("abc"), rng.choice(["houston", "savannah"]), at, rng.choice([None, 0.0, 0.5])))
    return rows


def as_set(frame):
    return sorted(str(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in frame.collect())


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_stop_log_equals_one_run(spark, tmp_path, settings, order):
    """Batches by time, in any order, or mixed: episodes over the turn of the year are joined."""
    rows = slow_messages(sum(order[:1]) + 1)
    frame = spark.createDataFrame(rows, SLOW)
    cuts = [datetime(2024, 1, 1), datetime(2024, 1, 2, 12)]
    parts = [[r for r in rows if sum(r[2] >= c for c in cuts) == i] for i in range(3)]
    log = StopLog(spark, str(tmp_path / "log"), settings)
    replaced = 0
    for i in order:
        replaced += log.add(spark.createDataFrame(parts[i], SLOW), f"part {i}")["replaced"]
    keys = ["mmsi", "nearest_port_id"]
    whole = episodes(frame, keys, "event_timestamp", settings.max_gap_minutes, "speed_knots").drop("episode")
    assert as_set(log.episodes().select(whole.columns)) == as_set(whole)
    assert replaced > 0
    assert as_set(log.stops()) == as_set(stops_of_episodes(whole, settings, DEFAULT_PORTS)) != []
    with pytest.raises(ValueError):
        log.add(frame, "part 0")


def test_stop_log_touches_only_keys_of_the_batch(spark, tmp_path, settings):
    log = StopLog(spark, str(tmp_path / "log"), replace(settings, max_gap_minutes=60))
    at = datetime(2024, 1, 31, 23, 50)
    first = [("a", "houston", at, 0.1), ("b", "houston", at, 0.2), ("b", "houston", at - timedelta(days=9), 0.2)]
    log.add(spark.createDataFrame(first, SLOW), "january")
    late = [("a", "houston", at + timedelta(minutes=60), 0.3)]
    # One new episode, which replaces the open one of the same key.
    assert log.add(spark.createDataFrame(late, SLOW), "february") == {"rows": 2, "replaced": 1}
    assert log.add(spark.createDataFrame([], SLOW), "march") == {"rows": 0, "replaced": 0}
    found = {(r.mmsi, r.episode_start, r.message_count): r.avg_speed_knots for r in log.episodes().collect()}
    assert found == {("a", at, 2): 0.2, ("b", at, 1): 0.2, ("b", at - timedelta(days=9), 1): 0.2}
    assert log.batches == ["january", "february", "march"]


@pytest.mark.parametrize("policy", [KEEP_FIRST, FLAG_ALL])
def test_the_log_joins_only_rows_that_may_be_flagged(spark, tmp_path, policy):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = DuplicateLog(spark, str(tmp_path / "log"), ["key"], ["n"], policy, prefixes=2)
        rows = spark.range(600).select(F.when(F.col("id") < 40, F.col("id") % 15).otherwise(F.col("id")).alias("key"), F.col("id").alias("n"))
        for batch in (1, 0, 1):
            log.add(rows.where(F.col("n") % 2 == batch), f"b{batch}")
        flagged = log.flagged(rows)
        found = {r.n for r in flagged.where("is_duplicate").collect()}
        assert found == set(range(15 if policy == KEEP_FIRST else 0, 40)) and flagged.count() == 600
        assert "LeftAnti, BuildRight" in flagged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_flags_are_not_dealt_to_tasks_by_batch(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = DuplicateLog(spark, str(tmp_path / "log"), ["key"], ["n"], prefixes=2)
        for batch in ("one", "two"):
            log.add(spark.range(20).select((F.col("id") % 5).alias("key"), F.concat_ws("-", F.lit(batch), "id").alias("n")), batch)
        found = log.duplicates()
        assert found.count() == 35
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_are_joined_once_where_very_many_are_flagged(spark, tmp_path, monkeypatch):
    log = DuplicateLog(spark, str(tmp_path / "log"), ["key"], ["n"], prefixes=2)
    rows = spark.range(60).select((F.col("id") % 20).alias("key"), F.when(F.col("id") > 0, F.col("id")).alias("n"))
    log.add(rows, "all")
    monkeypatch.setattr("portflow.operators.duplicates.BROADCAST_HASHES", 10)
    flagged = log.flagged(rows)
    assert sorted((r.n or 0, r.is_duplicate) for r in flagged.collect()) == [(n, n >= 20) for n in range(60)]
    text = flagged._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in text and "LeftSemi" not in text
