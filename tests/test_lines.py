"""Broken lines set apart, archives planned from their listing, sketches merged, ports as a table."""

import builtins
import json
import random
import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from portflow.__main__ import main
from portflow.operators import places, sessions, sketches
from portflow.operators.duplicates import duplicate_groups
from portflow.plans.pipeline import Pipeline
from portflow.schemas import RAW_COLUMNS
from portflow.sources import raw
from portflow.sources.buckets import bucketed
from portflow.sources.ports import DEFAULT_PORTS, ports_frame
from portflow.sources.runs import subfolders

HEADER = ",".join(RAW_COLUMNS)


def line(mmsi, time="2024-01-01T00:00:00"):
    return ",".join([mmsi, time, "29.73", "-95.26", "0.1"] + [""] * (len(RAW_COLUMNS) - 5))


LINES = [line("1"), line("2") + ",surplus", "3,short", line("4"), '5,"quoted, text",1', line("6") + ",,"]
BROKEN = {(LINES[1], 18), (LINES[2], 2), (LINES[4], 3), (LINES[5], 19)}


def write_zip(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, lines in members.items():
            archive.writestr(name, "\n".join([HEADER, *lines]) + "\n")


@pytest.mark.parametrize("kind", ["csv", "zip"])
def test_lines_read_are_rows_and_broken_lines(spark, tmp_path, settings, kind):
    folder = tmp_path / "in"
    folder.mkdir()
    if kind == "csv":
        (folder / "day.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
        rows = raw.read_raw_csv(spark, str(folder), quarantine=True)
    else:
        write_zip(folder / "day.zip", {"a.csv": LINES[:3], "b.csv": LINES[3:]})
        rows = raw.read_raw_zip(spark, str(folder), quarantine=True)
    assert {(r.line, r.field_count) for r in raw.broken_lines(rows).collect()} == BROKEN
    assert sorted(r.MMSI for r in raw.without_broken_lines(rows).collect()) == ["1", "4"]
    pipeline = Pipeline(spark, str(tmp_path / "lake"), settings)
    pipeline.bronze(rows, "day")
    assert (pipeline.counts["bronze_messages"]["rows"], pipeline.counts["bronze_broken_lines"]["rows"]) == (2, 4)
    assert {r.line for r in pipeline.broken_lines().collect()} == {text for text, _ in BROKEN}
    assert {r.source_file for r in pipeline.broken_lines().collect()} == {f"day.{kind}"}
    # Without quarantine, lines are read as far as they go.
    plain = raw.read_raw_csv(spark, str(folder)) if kind == "csv" else raw.read_raw_zip(spark, str(folder))
    assert plain.count() == 6 and raw.BROKEN not in plain.columns


def test_archives_are_planned_without_opening_them(tmp_path, monkeypatch):
    for day in "abc":
        (tmp_path / f"{day}.zip").write_bytes(b"not opened")
    (tmp_path / "notes.txt").write_text("x")

    def refuse(*args, **kwargs):
        raise AssertionError("a file was opened")


    monkeypatch.setattr(zipfile, "ZipFile", refuse)
    monkeypatch.setattr(builtins, "open", refuse)
    reader = raw.ZippedCsv({"path": str(tmp_path)}).reader(None)
    assert sorted(p.path.rsplit("/", 1)[1] for p in reader.partitions()) == ["a.zip", "b.zip", "c.zip"]


def test_archive_of_several_members_is_one_task(spark, tmp_path):
    write_zip(tmp_path / "x.zip", {"one.csv": [line("1")], "notes.txt": ["skip"], "dir/two.csv": [line("2"), line("3")]})
    write_zip(tmp_path / "y.zip", {"three.csv": []})
    rows = raw.read_raw_zip(spark, str(tmp_path))
    assert sorted(r.MMSI for r in rows.collect()) == ["1", "2", "3"]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as archive:
        archive.writestr("notes.txt", "x")
    with pytest.raises(Exception, match="no CSV file in the archive"):
        raw.read_raw_zip(spark, str(tmp_path)).count()
    with pytest.raises(Exception, match="no zip archive"):
        raw.read_raw_zip(spark, str(tmp_path / "nothing" if (tmp_path / "nothing").mkdir() is None else "")).count()


def test_merged_sketches_are_near_exact_values(spark):
    rng = random.Random(4)
    start = datetime(2024, 1, 1)
    near = [("v%d" % rng.randint(0, 4_000), "houston", start + timedelta(minutes=rng.randint(0, 14 * 1440 - 1)), rng.random() < 0.9) for _ in range(12_000)]
    dwell = [("houston", (start + timedelta(days=rng.randint(0, 13))).date(), rng.expovariate(0.01)) for _ in range(5_000)]
    proximity = spark.createDataFrame(near, "mmsi string, nearest_port_id string, event_timestamp timestamp_ntz, is_within_port_radius boolean")
    stops = spark.createDataFrame(dwell + [("savannah", start.date(), 5.0)], "nearest_port_id string, stop_date date, dwell_time_minutes double")
    daily = sketches.daily_sketches(proximity, stops)
    assert daily.count() == 15
    week = F.date_trunc("week", "report_date").cast("date")
    found = {(r.span, r.port_id): r for r in sketches.span_metrics(daily, week, 0.9).collect()}
    for monday in (start.date(), (start + timedelta(days=7)).date()):
        row = found[monday, "houston"]
        vessels = len({v for v, _, t, inside in near if inside and t.date() - timedelta(days=t.weekday()) == monday})
        values = sorted(d for _, day, d in dwell if day - timedelta(days=day.weekday()) == monday)
        assert abs(row.vessels_near_port - vessels) <= row.distinct_error * vessels
        assert row.stops == len(values) and row.avg_dwell_minutes == pytest.approx(sum(values) / len(values))
        rank = sum(v <= row.p90_dwell_minutes for v in values) / len(values)
        assert abs(rank - 0.9) <= row.rank_error + 1 / len(values)
    lone = found[start.date(), "savannah"]
    assert (lone.vessels_near_port, lone.positions, lone.stops, lone.p90_dwell_minutes) == (0, 0, 1, 5.0)


def test_bucketed_tables_are_read_without_a_shuffle(spark, tmp_path, settings):
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = [("v%d" % rng.randint(0, 9), rng.choice(["houston", "savannah"]), start + timedelta(minutes=rng.randint(0, 3_000)), 0.2) for _ in range(800)]
    plain = spark.createDataFrame(rows, "mmsi string, nearest_port_id string, event_timestamp timestamp_ntz, speed_knots double")
    plain = plain.withColumn("is_within_port_radius", F.lit(True)).withColumn("message_id", F.col("mmsi"))
    table = bucketed(plain, str(tmp_path / "it's"), sessions.STOP_KEYS, 4, "bucket_check")
    by_id = bucketed(plain, str(tmp_path / "ids"), ["message_id"], 4, "bucket_check")
    for found, wanted in (
        (sessions.vessel_stops(table, settings, DEFAULT_PORTS), sessions.vessel_stops(plain, settings, DEFAULT_PORTS)),
        (duplicate_groups(by_id, ["message_id"], ["mmsi"]), duplicate_groups(plain, ["message_id"], ["mmsi"])),
    ):
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect())) != []


def test_ports_table_gives_the_tables_of_listed_ports(spark, tmp_path, settings):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [line("1", f"2024-01-01T00:{m:02d}:00") for m in (0, 20, 45)] + [line("2", "x"), line("3").replace("29.73", "")]
    (folder / "day.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    tables = places.port_table(
        ports_frame(spark).withColumnsRenamed({"latitude": "port_latitude", "longitude": "port_longitude"})
    )
    seen = []
    for name, ports in (("listed", DEFAULT_PORTS), ("table", tables)):
        pipeline = Pipeline(spark, str(tmp_path / name), settings, ports=ports)
        pipeline.run(raw.read_raw_csv(spark, str(folder)), "day")
        seen.append(
            {t: sorted(map(str, pipeline.table(t).collect())) for t in ("silver_proximity", "silver_stops", "gold_anomalies", "gold_congestion")}
        )
        pipeline.retire()
        assert pipeline.table("silver_stops").count() == 1
    assert seen[0] == seen[1]


def test_command_runs_raw_to_gold(spark, tmp_path, capsys):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [line("1", f"2024-01-01T00:{m:02d}:00") for m in (0, 20, 45)] + ["short,line"]
    (folder / "day.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    arguments = [str(tmp_path / "lake"), str(folder), "--source", "day", "--as-of", "2026-01-01", "--retire"]
    for _ in range(2):
        counts = main(arguments)
    assert counts == json.loads(capsys.readouterr().out.splitlines()[-1])
    assert {name: counts[name]["rows"] for name in ("bronze_messages", "bronze_broken_lines", "silver_stops", "gold_congestion")} == {
        "bronze_messages": 3, "bronze_broken_lines": 1, "silver_stops": 1, "gold_congestion": 1,
    }
    assert len(subfolders(spark, str(tmp_path / "lake" / "silver_stops"), "run=")) == 1
