import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from portflow.operators.bronze import padded_date_parts, to_bronze
from portflow.operators.duplicates import (
    FLAG_ALL,
    duplicate_groups,
    find_groups,
    flag_duplicates,
    repeated_hashes,
    with_hash_in,
)
from portflow.operators.quality import (
    classify,
    classify_raw,
    impossible_speed,
    quality_report,
    source_profile,
    speed_unavailable,
    valid_latitude,
    valid_longitude,
    valid_speed,
)
from portflow.functions.cleaning import to_number

# The tests' rows never agree in both.
ORDER = ("source_file", "raw_payload_hash")


def flags(spark, texts, rule):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", rule(to_number(F.col("t"))).alias("v")).orderBy("i").collect()]


def test_latitude(spark):
    assert flags(spark, ["0", "90", "-90", "91", "-91", "", None], valid_latitude) == [True] * 3 + [False] * 4


def test_longitude(spark):
    assert flags(spark, ["0", "180", "-180", "181", "-181", "", None], valid_longitude) == [True] * 3 + [False] * 4


def test_speeds(spark, settings):
    texts = ["102.3", "-1", "12.5", "60", "60.1", "0", "", "nan"]
    assert flags(spark, texts, lambda c: speed_unavailable(c, settings)) == [True] + [False] * 7
    assert flags(spark, texts, lambda c: impossible_speed(c, settings)) == [
        False, True, False, False, True, False, True, True,
    ]
    assert flags(spark, texts, lambda c: valid_speed(c, settings)) == [
        False, False, True, True, False, True, False, False,
    ]


GOOD = ("1", "2024-01-01T00:00:00", "10", "20", "5")


def reasons_of(silver):
    return sorted(r.rejection_reason for r in silver.collect())


def test_reason_order_and_status(raw_rows, settings):
    raw = raw_rows([GOOD, ("", "", "", "200", "")])
    rows = {r.mmsi: r for r in classify(to_bronze(raw, settings), settings, ORDER).collect()}
    assert rows["1"].rejection_reason == "" and rows["1"].quality_status == "valid"
    assert rows[""].rejection_reason == "invalid_coordinate|null_vessel_id|impossible_speed|future_timestamp"
    assert rows[""].quality_status == "rejected"


def test_every_flag_is_a_plain_boolean(raw_rows, settings):
    silver = classify(to_bronze(raw_rows([(None,) * 5]), settings), settings, ORDER)
    row = silver.first().asDict()
    assert all(row[name] in (True, False) for name in row if name.startswith("is_"))


def test_null_lineage_reasons(raw_rows, settings):
    raw = raw_rows([GOOD]).withColumn("source_file", F.lit(" "))
    bronze = to_bronze(raw, settings).withColumn("ingestion_timestamp", F.lit(None).cast("timestamp"))
    assert reasons_of(classify(bronze, settings, ORDER)) == ["null_source_file|null_ingestion_timestamp"]


def test_time_at_the_processing_time_is_not_in_the_future(raw_rows, settings):
    raw = raw_rows([("1", "2026-01-01T00:00:00", "1", "1", "1"), ("2", "2026-01-01T00:00:00.000001", "1", "1", "1")])
    found = {r.mmsi: r.is_future_timestamp for r in classify(to_bronze(raw, settings), settings, ORDER).collect()}
    assert found == {"1": False, "2": True}


def test_message_id_uses_the_source_text(raw_rows, settings):
    raw = raw_rows([{"MMSI": "1", "BaseDateTime": "t", "LAT": "1.50", "Heading": "511"}])
    row = to_bronze(raw, settings).first()
    assert row.message_id == hashlib.sha256(b"1|t|1.50|||").hexdigest()
    assert row.raw_payload_hash == hashlib.sha256(("1|t|1.50||||511" + "|" * 10).encode()).hexdigest()
    assert row.heading == 511.0


def test_date_parts(raw_rows, settings):
    bronze = to_bronze(raw_rows([GOOD]), settings)
    row = bronze.first()
    assert (str(row.event_date), row.year, row.month) == ("2024-01-01", 2024, 1)
    padded = bronze.select(*padded_date_parts("event_timestamp")).first()
    assert tuple(padded) == ("2024", "01", "01")


def copies(spark, rows):
    return spark.createDataFrame(rows, "id string, rank int, wide string")


def test_duplicate_policies(spark):
    rows = copies(spark, [("a", 2, "x"), ("a", 1, "y"), ("a", 3, "z"), ("b", 9, "w"), (None, 1, "n"), (None, 2, "m")])
    first = {r.wide: r.is_duplicate for r in flag_duplicates(rows, ["id"], ["rank"]).collect()}
    assert first == {"x": True, "y": False, "z": True, "w": False, "n": False, "m": False}
    every = {r.wide: r.is_duplicate for r in flag_duplicates(rows, ["id"], policy=FLAG_ALL).collect()}
    assert every == {"x": True, "y": True, "z": True, "w": False, "n": False, "m": False}


def test_exact_copies_are_told_apart_by_position(spark):
    rows = copies(spark, [("a", 1, "x")] * 5 + [("b", 1, "x")]).withColumn("_position", F.monotonically_increasing_id())
    flagged = flag_duplicates(rows, ["id"], ["rank", "_position"])
    assert Counter((r.id, r.is_duplicate) for r in flagged.collect()) == {
        ("a", True): 4, ("a", False): 1, ("b", False): 1,
    }


@pytest.mark.parametrize("partitions", [1, 7])
def test_duplicate_flags_do_not_depend_on_partitioning(spark, partitions):
    rows = copies(spark, [(f"k{i % 40}", (i * 37) % 101, str(i)) for i in range(101)]).repartition(partitions)
    found = {r.wide for r in flag_duplicates(rows, ["id"], ["rank"]).where("not is_duplicate").collect()}
    best = {}
    for i in range(101):
        best[f"k{i % 40}"] = min(best.get(f"k{i % 40}", (999, "")), ((i * 37) % 101, str(i)))
    assert found == {wide for _, wide in best.values()}


def test_a_hot_key_is_broadcast_or_split(spark, tmp_path):
    """A third of the rows share one key, the others are unique or in pairs."""
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % (n // 2)).cast("string")))
    spark.range(n).select(key.alias("key"), F.col("id").alias("rank"), F.repeat(F.lit("x"), 50).alias("wide")).repartition(16).write.parquet(
        str(tmp_path / "rows")
    )
    rows = spark.read.parquet(str(tmp_path / "rows"))
    expected = n - rows.select("key").distinct().count()

    def plan():
        flagged = flag_duplicates(rows, ["key"], ["rank"], groups=find_groups(rows, ["key"], ["rank"]))
        written = flagged.select(F.count_if("is_duplicate").alias("n"), F.count(F.lit("wide")).alias("rows"))
        assert tuple(written.collect()[0]) == (expected, n)
        return written._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan()
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name, None) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        assert "skew=true" in plan()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_narrowing_by_hash_finds_the_same_groups(spark):
    rows = copies(spark, [(f"k{i % 60}", i, "x") for i in range(100)])
    suspects = with_hash_in(rows, ["id"], repeated_hashes(rows, ["id"]))
    assert suspects.count() == 80
    found, exact = (sorted(map(tuple, duplicate_groups(r, ["id"], ["rank"]).collect())) for r in (suspects, rows))
    assert found == exact


def test_duplicate_policy_arguments(spark):
    rows = copies(spark, [("a", 1, "x")])
    with pytest.raises(ValueError):
        flag_duplicates(rows, ["id"], ["rank"], policy="keep_last")
    with pytest.raises(ValueError):
        flag_duplicates(rows, ["id"])


def test_report_adds_up(raw_rows, settings):
    raw = raw_rows([GOOD, GOOD[:4] + ("102.3",), ("", *GOOD[1:]), ("2", "", "95", "20", "-3")])
    row = quality_report(classify(to_bronze(raw, settings), settings, ORDER), settings, "day.csv").first()
    assert (row.total_records, row.valid_records, row.rejected_records) == (4, 1, 3)
    assert row.rejection_rate == 0.75
    assert (row.unavailable_speed_count, row.impossible_speed_count, row.null_vessel_id_count) == (1, 1, 1)
    assert (row.invalid_coordinates_count, row.future_timestamp_count) == (1, 1)


def test_report_of_nothing(raw_rows, settings):
    silver = classify(to_bronze(raw_rows([GOOD]).limit(0), settings), settings, ORDER)
    row = quality_report(silver, settings, "none").first()
    assert (row.total_records, row.rejected_records, row.rejection_rate) == (0, 0, 0.0)


def test_profile_counts_the_marker_as_invalid_speed(raw_rows, settings):
    marker = GOOD[:4] + ("102.3",)
    raw = raw_rows([GOOD, GOOD, GOOD, marker, marker])
    row = source_profile(raw, settings, "day.zip").first()
    assert (row.total_records, row.valid_records, row.rejected_records) == (5, 1, 4)
    assert (row.impossible_speed_count, row.duplicate_records_count) == (2, 3)
    assert (row.anomaly_rows_captured, row.quality_sample_rows) == (4, 5)


def test_profile_agrees_with_the_flagged_rows(spark, sf_dir, settings):
    from portflow.sources.fixture import read_messages

    raw = read_messages(spark, sf_dir)
    row = source_profile(raw, settings, "events").first()
    flagged = classify_raw(raw, settings, ["event_id", "Heading", "copy"])
    rejected = flagged.where(F.size("quality_reasons") > 0).count()
    counts = Counter(
        name for r in flagged.select("quality_reasons").collect() for name in r.quality_reasons
    )
    assert row.rejected_records == rejected and row.total_records == flagged.count()
    assert row.duplicate_records_count == counts["duplicate_message_id"]
    assert row.impossible_speed_count == counts["invalid_speed"]
    assert row.invalid_coordinates_count == counts["invalid_coordinate"]


def test_rows_without_copies_are_not_shuffled_with_the_groups(spark, monkeypatch):
    rows = spark.range(4_000).select(
        F.when(F.col("id") % 100 == 0, F.lit(None)).when(F.col("id") < 100, F.col("id") % 30).otherwise(F.col("id")).cast("string").alias("key"),
        F.col("id").alias("rank"),
    )
    plain = sorted(flag_duplicates(rows, ["key"], ["rank"]).collect(), key=lambda r: r.rank)
    assert sum(r.is_duplicate for r in plain) == 69
    monkeypatch.setattr("portflow.operators.duplicates.MANY_GROUPS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = flag_duplicates(rows, ["key"], ["rank"])
        assert sorted(flagged.collect(), key=lambda r: r.rank) == plain
        text = flagged._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti, BuildRight" in text and "LeftSemi, BuildRight" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_are_joined_once_where_very_many_keys_repeat(spark, monkeypatch):
    rows = spark.range(200).select((F.col("id") % 90).cast("string").alias("key"), F.col("id").alias("rank"))
    monkeypatch.setattr("portflow.operators.duplicates.MANY_GROUPS", 0)
    monkeypatch.setattr("portflow.operators.duplicates.BROADCAST_HASHES", 10)
    groups = find_groups(rows, ["key"], ["rank"])
    flagged = flag_duplicates(rows, ["key"], ["rank"], groups=groups)
    assert sorted((r.rank, r.is_duplicate) for r in flagged.collect()) == [(n, n >= 90) for n in range(200)]
    text = flagged._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in text and "LeftSemi" not in text
