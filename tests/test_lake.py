import json
import zipfile
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from portflow.operators.anomalies import vessel_anomalies
from portflow.operators.bronze import to_bronze
from portflow.operators.quality import classify
from portflow.plans.pipeline import Pipeline
from portflow.schemas import ANOMALY_COLUMNS, BRONZE_COLUMNS, CONGESTION_COLUMNS, RAW_COLUMNS, SILVER_COLUMNS, STOP_COLUMNS
from portflow.session import scratch_dir
from portflow.sources.layers import (
    CODEC,
    LAYERS,
    between_months,
    read_anomalies_csv,
    read_congestion_csv,
    read_layer,
    register_layer,
    repair_partitions,
    store,
    write_anomalies_csv,
    write_congestion_csv,
    write_layer,
)
from portflow.sources.ports import DEFAULT_PORTS, load_ports, read_ports
from portflow.sources.raw import read_raw_csv, read_raw_zip
from portflow.sources.runs import register_lake

HEADER = ",".join(RAW_COLUMNS)


def line(mmsi, time, lat="29.7308", lon="-95.2622", speed="0.0", name=""):
    return ",".join([mmsi, time, lat, lon, speed, "1.0", "511", name, *[""] * 9])


def write_day(path, lines, header=HEADER):
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return path


def zip_day(path, lines, header=HEADER):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(path.stem + ".csv", "\n".join([header, *lines]) + "\n" if header else "")
    return path


DAY = [
    line("1", "2024-01-01T00:00:00"),
    line("1", "2024-01-01T00:45:00"),
    line("1", "2024-01-01T00:45:00"),
    line("1", "2024-01-01T00:45:00"),
    line("2", "2024-01-01T05:00:00", speed="102.3"),
    line("", "2024-01-01T06:00:00", lat=""),
    line("3", "2024-02-01T06:00:00", lat="33.7", lon="-118.2", speed="0.5"),
    line("3", "2024-02-01T07:00:00", lat="33.7", lon="-118.2", speed="0.5"),
    line("4", "not a time"),
]


def test_csv_source(spark, tmp_path):
    write_day(tmp_path / "day.csv", [line("1", "t", name='"SEA, ""BIG"""'), line("", "t")])
    rows = read_raw_csv(spark, str(tmp_path)).orderBy(F.desc_nulls_last("MMSI")).collect()
    assert rows[0].VesselName == 'SEA, "BIG"' and rows[0].source_file == "day.csv"
    assert rows[1].MMSI is None
    by_path = read_raw_csv(spark, str(tmp_path), lineage="path").first()
    assert by_path.source_file.startswith("file:") and by_path.source_file.endswith("day.csv")
    with pytest.raises(ValueError):
        read_raw_csv(spark, str(tmp_path), lineage="none")


def test_csv_reads_only_the_columns_it_needs(spark, tmp_path):
    write_day(tmp_path / "day.csv", DAY)
    plan = read_raw_csv(spark, str(tmp_path)).groupBy("MMSI").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<MMSI:string>" in plan


def test_zip_source_equals_csv_source(spark, tmp_path):
    days = [f"2024-01-{d:02d}" for d in range(1, 4)]
    folder = tmp_path / "zips"
    folder.mkdir()
    for day in days:
        lines = [line(str(i), f"{day}T00:00:{i % 60:02d}", name='"A, B"') for i in range(500)]
        write_day(tmp_path / f"{day}.csv", lines)
        zip_day(folder / f"{day}.zip", lines)
    zipped = read_raw_zip(spark, str(folder))
    assert zipped.rdd.getNumPartitions() == len(days)
    plain = read_raw_csv(spark, f"{tmp_path}/*.csv").fillna("")
    assert {r.source_file for r in zipped.select("source_file").distinct().collect()} == {f"{d}.zip" for d in days}
    assert zipped.drop("source_file").exceptAll(plain.drop("source_file")).count() == 0
    assert zipped.count() == plain.count() == 1500


def test_zip_source_keeps_uneven_lines(spark, tmp_path):
    zip_day(tmp_path / "day.zip", [line("1", "t"), "2,t,5", line("3", "t") + ",surplus"])
    rows = {r.MMSI: r for r in read_raw_zip(spark, str(tmp_path)).collect()}
    assert rows.keys() == {"1", "2", "3"}
    assert (rows["2"].LAT, rows["2"].LON, rows["2"].source_file) == ("5", None, "day.zip")


def test_zip_source_takes_columns_by_name(spark, tmp_path):
    zip_day(tmp_path / "day.zip", [",".join(reversed(line("7", "t").split(",")))], ",".join(reversed(RAW_COLUMNS)))
    assert read_raw_zip(spark, str(tmp_path)).first().MMSI == "7"


def test_zip_source_with_only_a_header(spark, tmp_path):
    zip_day(tmp_path / "day.zip", [])
    assert read_raw_zip(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("header, message", [(None, "header not found"), ("a,b", "header lacks MMSI")])
def test_zip_source_needs_its_header(spark, tmp_path, header, message):
    zip_day(tmp_path / "day.zip", [] if header is None else ["1,2"], header)
    with pytest.raises(PythonException, match=message):
        read_raw_zip(spark, str(tmp_path)).count()


def test_ports_file(spark, tmp_path):
    path = tmp_path / "ports.csv"
    path.write_text(
        "port_id,port_name,latitude,longitude,port_radius_km\n"
        + "".join(f"{p.port_id},{p.port_name},{p.latitude},{p.longitude},20\n" for p in DEFAULT_PORTS)
    )
    assert load_ports(read_ports(spark, str(path))) == DEFAULT_PORTS


def run_pipeline(spark, tmp_path, settings, **options):
    raw_path = tmp_path / "raw"
    raw_path.mkdir(exist_ok=True)
    write_day(raw_path / "day.csv", DAY)
    pipeline = Pipeline(spark, str(tmp_path / "lake"), settings, **options)
    pipeline.run(read_raw_csv(spark, str(raw_path)), "day.csv")
    return pipeline


def test_pipeline_tables_and_counts(spark, tmp_path, settings):
    pipeline = run_pipeline(spark, tmp_path, settings)
    counts = pipeline.counts
    assert counts["bronze_messages"] == {"rows": 9}
    # Three identical lines: one stays, two are duplicates.
    assert counts["silver_positions"] == {"rows": 9, "valid": 4, "rejected": 5}
    assert counts["silver_proximity"] == {"rows": 4, "within_radius": 4}
    assert counts["silver_stops"] == {"rows": 2, "candidates": 4}
    assert counts["gold_anomalies"]["rows"] == 6
    assert counts["gold_congestion"] == {"rows": 3}
    columns = {
        "bronze_messages": (*BRONZE_COLUMNS, "batch"),
        "silver_positions": SILVER_COLUMNS,
        "silver_stops": STOP_COLUMNS,
        "gold_anomalies": ANOMALY_COLUMNS,
        "gold_congestion": CONGESTION_COLUMNS,
    }
    for table, names in columns.items():
        assert set(pipeline.table(table).columns) == set(names), table
    report = pipeline.table("silver_quality_report").first()
    assert (report.duplicate_records_count, report.unavailable_speed_count, report.total_records) == (2, 1, 9)
    gold = {(str(r.report_date), r.port_id): r for r in pipeline.table("gold_congestion").collect()}
    # A message without a readable time still counts, on no date.
    assert ("None", "houston") in gold
    houston = gold[("2024-01-01", "houston")]
    assert (houston.vessels_near_port, houston.stopped_vessels, houston.anomaly_count) == (1, 1, 3)
    assert (houston.avg_dwell_time_minutes, houston.stopped_position_count) == (45.0, 2)


def test_flag_all_rejects_every_copy(spark, tmp_path, settings):
    pipeline = run_pipeline(spark, tmp_path, settings, duplicate_policy="flag_all")
    assert pipeline.counts["silver_positions"] == {"rows": 9, "valid": 3, "rejected": 6}


def test_rerun_gives_the_same_tables(spark, tmp_path, settings):
    def state(pipeline):
        return {
            name: sorted(map(str, pipeline.table(name).collect()))
            for name in LAYERS
            if name != "silver_quality_report"
        }

    first = state(run_pipeline(spark, tmp_path, settings))
    pipeline = run_pipeline(spark, tmp_path, settings)
    assert state(pipeline) == first
    # The report is a log: one row per run.
    assert pipeline.table("silver_quality_report").count() == 2


def test_overwriting_leaves_nothing_of_the_table_before(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "id int, year int, month int")
    path = str(tmp_path / "t")
    write_layer(rows, path, ("year", "month"))
    write_layer(rows.where("month = 2").withColumn("id", F.lit(9)), path, ("year", "month"))
    assert sorted((r.id, r.month) for r in read_layer(spark, path).collect()) == [(9, 2)]


def test_rerun_with_other_settings_leaves_no_stale_rows(spark, tmp_path, settings):
    first = run_pipeline(spark, tmp_path, settings)
    assert first.table("silver_stops").count() == 2
    again = run_pipeline(spark, tmp_path, replace(settings, min_dwell_minutes=600.0))
    assert again.table("silver_stops").count() == 0
    assert again.table("gold_congestion").agg(F.sum("stopped_vessels")).first()[0] == 0


def test_months_loaded_one_after_the_other_keep_all_rows(spark, tmp_path, settings):
    months = {
        "january": [line(str(i), f"2024-01-0{i + 1}T00:00:00") for i in range(6)] + [line("7", "?"), line("8", "")],
        "february": [line(str(i), f"2024-02-0{i + 1}T00:00:00") for i in range(6)] + [line("9", "never")],
    }
    pipeline = Pipeline(spark, str(tmp_path / "lake"), settings)
    for name, lines in months.items():
        (tmp_path / name).mkdir()
        write_day(tmp_path / name / "day.csv", lines)
    for name, total in (("january", 8), ("february", 15), ("january", 15)):
        pipeline.run(read_raw_csv(spark, str(tmp_path / name)), name)
        assert pipeline.table("bronze_messages").count() == total
        assert pipeline.table("silver_positions").count() == total
    # A smaller delivery of the same source replaces all of its rows.
    write_day(tmp_path / "january" / "day.csv", months["january"][:1])
    pipeline.run(read_raw_csv(spark, str(tmp_path / "january")), "january")
    assert pipeline.table("bronze_messages").count() == 8


def test_month_span_prunes_folders(spark, tmp_path):
    rows = spark.createDataFrame(
        [(i, y, m) for i, (y, m) in enumerate([(2023, 12), (2024, 1), (2024, 6), (2025, 1), (2025, 2)])],
        "id int, year int, month int",
    )
    path = str(tmp_path / "t")
    write_layer(rows, path, ("year", "month"))
    chosen = between_months(read_layer(spark, path), (2024, 1), (2025, 1))
    assert sorted(r.id for r in chosen.collect()) == [1, 2, 3]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "DataFilters: []" in plan


def test_counts_come_with_the_write(spark, tmp_path):
    counts = write_layer(spark.range(10), str(tmp_path / "t"), counts={"even": F.col("id") % 2 == 0})
    assert counts == {"rows": 10, "even": 5}


def test_catalog_tables(spark, tmp_path, settings):
    pipeline = run_pipeline(spark, tmp_path, settings)
    spark.sql("CREATE DATABASE IF NOT EXISTS lake_check")
    try:
        register_lake(spark, pipeline.root, "lake_check")
        assert spark.sql("SELECT count(*) FROM lake_check.silver_positions").first()[0] == 9
        assert spark.sql("SELECT count(*) FROM lake_check.silver_stops WHERE year = 2024 AND month = 2").first()[0] == 1
        bronze = spark.table("lake_check.bronze_messages")
        assert set(bronze.columns) == {*BRONZE_COLUMNS, "batch"} and bronze.count() == 9
        # A second run shows once the views are switched to it.
        run_pipeline(spark, tmp_path, replace(settings, min_dwell_minutes=600.0))
        assert spark.sql("SELECT count(*) FROM lake_check.silver_stops").first()[0] == 2
        register_lake(spark, pipeline.root, "lake_check")
        assert spark.sql("SELECT count(*) FROM lake_check.silver_stops").first()[0] == 0
        assert spark.sql("SELECT count(*) FROM lake_check.silver_quality_report").first()[0] == 2
    finally:
        spark.sql("DROP DATABASE lake_check CASCADE")


def test_layer_table_picks_up_new_partitions(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "id int, year int, month int")
    path = str(tmp_path / "it's `t`")
    write_layer(rows, path, ("year", "month"))
    spark.sql("CREATE DATABASE IF NOT EXISTS layer_check")
    try:
        register_layer(spark, "layer_check.t", path, ("year", "month"))
        write_layer(rows.withColumn("year", F.lit(2031)), path, ("year", "month"), mode="append")
        repair_partitions(spark, "layer_check.t")
        assert spark.sql("SELECT count(*) FROM layer_check.t WHERE year = 2031").first()[0] == 2
    finally:
        spark.sql("DROP DATABASE layer_check CASCADE")


def test_catalog_query_leaves_other_databases_alone(spark, sf_dir):
    """A user's managed table survives, whatever its database is called."""
    from portflow.plans.catalog import catalog_stops_by_port

    spark.sql("CREATE DATABASE IF NOT EXISTS portflow_lake")
    try:
        spark.sql("CREATE TABLE IF NOT EXISTS portflow_lake.kept USING parquet AS SELECT 1 AS one")
        before = {r.namespace for r in spark.sql("SHOW DATABASES").collect()}
        assert catalog_stops_by_port(spark, sf_dir).count() > 0
        assert spark.table("portflow_lake.kept").count() == 1
        assert {r.namespace for r in spark.sql("SHOW DATABASES").collect()} == before
    finally:
        spark.sql("DROP DATABASE portflow_lake CASCADE")


def test_csv_tables_take_columns_by_position(spark, tmp_path, settings):
    pipeline = run_pipeline(spark, tmp_path, settings)
    write_congestion_csv(pipeline.table("gold_congestion"), str(tmp_path / "gold"))
    back = read_congestion_csv(spark, str(tmp_path / "gold"))
    assert back.where("port_id = 'houston' and report_date = '2024-01-01'").first().vessels_near_port == 1
    write_anomalies_csv(pipeline.table("gold_anomalies"), str(tmp_path / "anomalies"))
    found = read_anomalies_csv(spark, str(tmp_path / "anomalies"))
    assert found.count() == 6 and found.where("is_within_port_radius = 'true'").count() > 0


def test_anomalies_one_per_reason(raw_rows, settings):
    raw = raw_rows([("", "2024-01-01T00:00:00", "29.73", "-95.26", "-1"), ("5", "2024-01-01T00:00:00", "", "1", "1")])
    rows = vessel_anomalies(classify(to_bronze(raw, settings), settings, ("raw_payload_hash",)), DEFAULT_PORTS, settings).collect()
    found = {r.anomaly_type: r for r in rows}
    assert {(t, r.severity) for t, r in found.items()} == {
        ("null_vessel_id", "high"), ("impossible_speed", "medium"), ("invalid_coordinate", "high"),
    }
    assert found["impossible_speed"].nearest_port_id == "houston" and found["impossible_speed"].is_within_port_radius
    assert found["invalid_coordinate"].nearest_port_id is None
    assert found["invalid_coordinate"].is_within_port_radius is False
    assert len({r.anomaly_id for r in rows}) == 3


def test_unlisted_reason_has_unknown_severity(spark, settings):
    row = spark.createDataFrame(
        [("m", datetime(2024, 1, 1), "1", 1.0, 1.0, "null_source_file|other|", "rejected")],
        "message_id string, event_timestamp timestamp_ntz, mmsi string, latitude double, longitude double,"
        " rejection_reason string, quality_status string",
    )
    rows = vessel_anomalies(row, DEFAULT_PORTS, settings).collect()
    assert [(r.anomaly_type, r.severity) for r in rows] == [("null_source_file", "unknown"), ("other", "unknown")]


class _Session:
    """A session whose cluster names a shared folder; the setting cannot be changed on a running one."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return "hdfs://shared/checkpoints/" if key == "spark.checkpoint.dir" else default


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_dir(_Session).startswith("hdfs://shared/checkpoints/portflow-")
    assert scratch_dir(_Session) != scratch_dir(_Session)
    assert scratch_dir(spark).startswith("/")


def test_source_has_no_forbidden_calls():
    from pathlib import Path

    package = Path(__file__).resolve().parent.parent / "portflow"
    text = json.dumps([p.read_text() for p in package.rglob("*.py")])
    for call in ("localCheckpoint", "crossJoin", ".rdd", "toPandas", "F.udf(", "collect_set"):
        assert call not in text, call


def test_tables_of_hashes_take_half_their_text(spark, tmp_path):
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("hash"))
    write_layer(rows, str(tmp_path / "layer"))
    assert store(rows, str(tmp_path / "stored"), CODEC).count() == 20_000
    for table in ("layer", "stored"):
        assert sum(f.stat().st_size for f in (tmp_path / table).glob("*.parquet")) < 0.65 * 64 * 20_000


def test_anomalies_are_written_without_a_shuffle(spark, tmp_path, settings):
    plans = {}

    class Watched(Pipeline):
        def _write(self, name, rows, counts=None):
            plans[name] = rows._jdf.queryExecution().executedPlan().toString()
            super()._write(name, rows, counts)

    write_day(tmp_path / "day.csv", DAY)
    pipeline = Watched(spark, str(tmp_path / "lake"), settings)
    pipeline.bronze(read_raw_csv(spark, str(tmp_path / "day.csv")), "day")
    pipeline.silver()
    pipeline.anomalies()
    assert "Exchange" not in plans["gold_anomalies"] and pipeline.counts["gold_anomalies"]["rows"] == 6
