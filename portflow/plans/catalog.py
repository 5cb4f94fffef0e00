"""Named queries over the driver tables: each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.operators import anomalies as anomaly_ops
from portflow.operators import bronze as bronze_ops
from portflow.operators import congestion, duplicates, nearest, quality, sampling, sessions
from portflow.plans import reports
from portflow.plans.pipeline import Pipeline
from portflow.schemas import SILVER_COLUMNS
from portflow.session import scratch_dir
from portflow.settings import Settings
from portflow.sources import fixture, layers, raw as raw_files
from portflow.sources.ports import DEFAULT_PORTS, load_ports, ports_frame, read_ports
from portflow.sources.runs import register_lake

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2026, 1, 1)
DEFAULTS = Settings(as_of=AS_OF)

# The driver's events are hours apart per user, so most stop queries allow gaps of a day.
WIDE = replace(DEFAULTS, max_gap_minutes=1440, min_dwell_minutes=720.0)

# Caps small enough to cut the small test tables.
SAMPLED = replace(DEFAULTS, sample_rows=2_000, profile_sample_rows=1_000, profile_rejected_rows=300)

RAW_FIELDS = ("event_id", "MMSI", "BaseDateTime", "LAT", "LON", "SOG", "COG", "Heading")
SAMPLE_KEYS = ("event_id", "Heading")

# Tells any two messages apart, byte-identical copies too.
POSITION = ("event_id", "copy")
COPY_ORDER = ("source_file", "raw_payload_hash", *POSITION)
RAW_ORDER = ("event_id", "Heading", "copy")


@dataclass
class Lake:
    """All tables derived from one folder.

    They are lazy. A ``stored`` lake writes the tables that several later ones read to scratch storage
    first, as the pipeline does, so that those do not scan the raw data once each.
    """

    spark: SparkSession
    folder: str
    settings: Settings = WIDE
    policy: str = duplicates.KEEP_FIRST
    stored: bool = False

    def keep(self, table: DataFrame) -> DataFrame:
        return layers.store(table, scratch_dir(self.spark)) if self.stored else table

    @cached_property
    def raw(self) -> DataFrame:
        return fixture.read_messages(self.spark, self.folder)

    @cached_property
    def bronze(self) -> DataFrame:
        return bronze_ops.to_bronze(self.raw, self.settings, POSITION)

    @cached_property
    def silver(self) -> DataFrame:
        silver = quality.classify(self.bronze, self.settings, COPY_ORDER, self.policy)
        return self.keep(silver.select(*SILVER_COLUMNS)) if self.stored else silver

    @cached_property
    def report(self) -> DataFrame:
        return quality.quality_report(self.silver, self.settings, "events.parquet")

    @cached_property
    def proximity(self) -> DataFrame:
        return nearest.nearest_port(quality.keep_valid(self.silver), DEFAULT_PORTS)

    @cached_property
    def stops(self) -> DataFrame:
        return self.keep(sessions.vessel_stops(self.proximity, self.settings, DEFAULT_PORTS))

    @cached_property
    def anomalies(self) -> DataFrame:
        return anomaly_ops.vessel_anomalies(self.silver, DEFAULT_PORTS, self.settings)

    def base(self, join: str = "full", with_anomalies: bool = True) -> DataFrame:
        found = self.anomalies if with_anomalies else None
        return self.keep(
            congestion.congestion_base(
                self.proximity, self.stops, found, self.report, self.settings, DEFAULT_PORTS, join
            )
        )

    def congestion(self, join: str = "full", with_anomalies: bool = True, partition=()) -> DataFrame:
        return congestion.congestion_index(self.base(join, with_anomalies), self.settings, partition)


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name, places in digits.items()})


# --- bronze -------------------------------------------------------------------------------------


def bronze_message_ids(spark: SparkSession, folder: str) -> DataFrame:
    return Lake(spark, folder).bronze.select(
        "message_id", "event_timestamp", "mmsi", "latitude", "longitude", "speed_knots", "course", "heading",
        "event_date", "year", "month",
    )


def bronze_payload_hash(spark: SparkSession, folder: str) -> DataFrame:
    return Lake(spark, folder).bronze.select("raw_payload_hash", "source_file")


def bronze_padded_dates(spark: SparkSession, folder: str) -> DataFrame:
    bronze = Lake(spark, folder).bronze.drop("year", "month")
    dated = bronze.select(*bronze_ops.padded_date_parts("event_timestamp"))
    return dated.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("row_count"))


def bronze_volume(spark: SparkSession, folder: str) -> DataFrame:
    return reports.bronze_volume(Lake(spark, folder).bronze)


# --- quality ------------------------------------------------------------------------------------


def quality_flags(spark: SparkSession, folder: str) -> DataFrame:
    return Lake(spark, folder).silver.select(
        "message_id", "heading", "is_valid_coordinate", "is_null_vessel_id", "is_speed_unavailable",
        "is_impossible_speed", "is_valid_speed", "is_future_timestamp", "is_null_source_file",
        "is_null_ingestion_timestamp", "is_duplicate",
    )


def quality_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return Lake(spark, folder).silver.select("message_id", "heading", "rejection_reason", "quality_status")


def _duplicates(policy: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        bronze = Lake(spark, folder).bronze.select("message_id", *COPY_ORDER)
        flagged = duplicates.flag_duplicates(bronze, ["message_id"], COPY_ORDER, policy)
        return flagged.drop("source_file", *POSITION)

    return query


def lineitem_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The duplicate flag on another table: repeated (order, line) pairs, first by the remaining columns."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return duplicates.flag_duplicates(lines, ["l_orderkey", "l_linenumber"], order)


def quality_status_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.status_counts(Lake(spark, folder).silver)


def quality_status_counts_flag_all(spark: SparkSession, folder: str) -> DataFrame:
    return reports.status_counts(Lake(spark, folder, policy=duplicates.FLAG_ALL).silver)


def rejection_reason_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.reason_counts(Lake(spark, folder).silver)


def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(Lake(spark, folder).report.drop("created_at"), rejection_rate=6)


def source_profile(spark: SparkSession, folder: str) -> DataFrame:
    profile = quality.source_profile(Lake(spark, folder).raw, SAMPLED, "events.parquet")
    return rounded(profile.drop("created_at"), rejection_rate=6)


# --- sampling -----------------------------------------------------------------------------------


def sample_exact(spark: SparkSession, folder: str) -> DataFrame:
    raw = Lake(spark, folder).raw.select(*RAW_FIELDS)
    return sampling.sample_exact(raw, SAMPLED.sample_rows, SAMPLED.sample_seed, SAMPLE_KEYS)


def _flagged_raw(spark: SparkSession, folder: str) -> DataFrame:
    flagged = quality.classify_raw(Lake(spark, folder).raw.select(*RAW_FIELDS, "copy"), SAMPLED, RAW_ORDER)
    # The classes are needed twice, once to count them and once to fill the sample.
    return layers.store(flagged.select(*RAW_FIELDS, "copy", "quality_reasons"), scratch_dir(spark))


def sample_by_class(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.sample_by_class(
        _flagged_raw(spark, folder), SAMPLED.profile_sample_rows, SAMPLED.profile_rejected_rows,
        SAMPLED.sample_seed, SAMPLE_KEYS,
    ).drop("copy", "quality_reasons")


def rejected_capture(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.rejected_capture(
        _flagged_raw(spark, folder), SAMPLED.profile_rejected_rows, SAMPLED.sample_seed, SAMPLE_KEYS
    ).drop("copy")


# --- proximity ----------------------------------------------------------------------------------


def nearest_port(spark: SparkSession, folder: str) -> DataFrame:
    chosen = Lake(spark, folder).proximity.select(
        "message_id", "nearest_port_id", "nearest_port_name", "port_latitude", "port_longitude", "port_radius_km",
        "distance_to_port_km", "is_within_port_radius",
    )
    return rounded(chosen, distance_to_port_km=3)


def nearest_port_ranked(spark: SparkSession, folder: str) -> DataFrame:
    positions = quality.keep_valid(Lake(spark, folder).silver).select("message_id", "latitude", "longitude")
    ranked = nearest.nearest_ports(positions, DEFAULT_PORTS, 2)
    return rounded(ranked.drop("latitude", "longitude"), distance_to_port_km=3)


def port_positions(spark: SparkSession, folder: str) -> DataFrame:
    return reports.port_positions(Lake(spark, folder).proximity)


def ports_near(spark: SparkSession, folder: str) -> DataFrame:
    return reports.ports_near(Lake(spark, folder).proximity)


def min_port_distance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.min_port_distance(Lake(spark, folder).proximity), min_distance_km=3)


# --- stops --------------------------------------------------------------------------------------


def stop_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return reports.candidate_totals(Lake(spark, folder).proximity, DEFAULTS)


def temporal_density_top(spark: SparkSession, folder: str) -> DataFrame:
    return reports.temporal_density(Lake(spark, folder).proximity, DEFAULTS)


def stop_gaps(spark: SparkSession, folder: str) -> DataFrame:
    candidates = sessions.stop_candidates(Lake(spark, folder, stored=True).proximity, WIDE)
    gaps = sessions.position_gaps(candidates, sessions.STOP_KEYS, "event_timestamp", WIDE.max_gap_minutes)
    return rounded(gaps, gap_minutes=6)


def stop_episodes(spark: SparkSession, folder: str) -> DataFrame:
    candidates = sessions.stop_candidates(Lake(spark, folder).proximity, WIDE)
    found = sessions.episodes(
        candidates, sessions.STOP_KEYS, "event_timestamp", WIDE.max_gap_minutes, "speed_knots"
    )
    return rounded(found, avg_speed_knots=9)


def stop_messages(spark: SparkSession, folder: str) -> DataFrame:
    candidates = sessions.stop_candidates(Lake(spark, folder).proximity, WIDE).select(
        "message_id", *sessions.STOP_KEYS, "event_timestamp"
    )
    return sessions.sessionize(candidates, sessions.STOP_KEYS, "event_timestamp", WIDE.max_gap_minutes)


def vessel_stops_session_window(spark: SparkSession, folder: str) -> DataFrame:
    candidates = sessions.stop_candidates(Lake(spark, folder).proximity, WIDE)
    return sessions.episodes_by_session_window(
        candidates, sessions.STOP_KEYS, "event_timestamp", WIDE.max_gap_minutes
    )


def _vessel_stops(settings: Settings) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        stops = Lake(spark, folder, settings).stops
        return rounded(stops, dwell_time_minutes=6, avg_speed_knots=9)

    return query


def stops_by_port(spark: SparkSession, folder: str) -> DataFrame:
    by_port = reports.stops_by_port(Lake(spark, folder).stops)
    return rounded(by_port, avg_dwell_minutes=8, max_dwell_minutes=8)


def stop_count(spark: SparkSession, folder: str) -> DataFrame:
    return reports.stop_count(Lake(spark, folder, DEFAULTS).stops)


# --- anomalies ----------------------------------------------------------------------------------


def vessel_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(Lake(spark, folder).anomalies.drop("created_at"), distance_to_port_km=3)


def anomalies_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return reports.anomalies_by_type(Lake(spark, folder).anomalies)


def anomalies_by_severity(spark: SparkSession, folder: str) -> DataFrame:
    return reports.anomalies_by_severity(Lake(spark, folder).anomalies)


def anomalies_by_port(spark: SparkSession, folder: str) -> DataFrame:
    return reports.anomalies_by_port(Lake(spark, folder).anomalies)


# --- congestion ---------------------------------------------------------------------------------


def proximity_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return congestion.proximity_metrics(Lake(spark, folder).proximity, WIDE)


def stop_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = congestion.stop_metrics(Lake(spark, folder, stored=True).stops, WIDE)
    return rounded(metrics, avg_dwell_time_minutes=8, p90_dwell_time_minutes=8)


def stop_p90_approx(spark: SparkSession, folder: str) -> DataFrame:
    metrics = congestion.stop_metrics(Lake(spark, folder, stored=True).stops, WIDE, approx=True)
    return rounded(metrics, avg_dwell_time_minutes=8, p90_dwell_time_minutes=8)


def minmax_normalized(spark: SparkSession, folder: str) -> DataFrame:
    base = Lake(spark, folder, stored=True).base()
    names = {column: f"normalized_{column}" for column in congestion.congestion_weights(WIDE)}
    scaled = congestion.minmax_normalize(base, names).select("report_date", "port_id", *names.values())
    return rounded(scaled, **{name: 6 for name in names.values()})


def shown_congestion(scores: DataFrame) -> DataFrame:
    return rounded(
        scores.drop("created_at"), avg_dwell_time_minutes=8, p90_dwell_time_minutes=8,
        data_quality_rejection_rate=6, port_congestion_index=4,
    )


def port_congestion_daily(spark: SparkSession, folder: str) -> DataFrame:
    return shown_congestion(Lake(spark, folder, stored=True).congestion()).orderBy("report_date", "port_id")


def port_congestion_left(spark: SparkSession, folder: str) -> DataFrame:
    return shown_congestion(Lake(spark, folder, stored=True).congestion("left", with_anomalies=False)).orderBy("report_date", "port_id")


def port_congestion_within_day(spark: SparkSession, folder: str) -> DataFrame:
    return shown_congestion(Lake(spark, folder, stored=True).congestion("left", partition=["report_date"])).orderBy("report_date", "port_id")


def congestion_ranking(spark: SparkSession, folder: str) -> DataFrame:
    ranked = reports.congestion_ranking(Lake(spark, folder, stored=True).congestion(), limit=20)
    return rounded(
        ranked.select("report_date", "port_id", "port_name", "port_congestion_index"), port_congestion_index=4
    )


def nation_supplier_index(spark: SparkSession, folder: str) -> DataFrame:
    """The weighted index on another table: nations scored by their suppliers' number and balances."""
    suppliers = spark.read.parquet(f"{folder}/supplier.parquet")
    nations = spark.read.parquet(f"{folder}/nation.parquet").select("n_nationkey", "n_name")
    measured = suppliers.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("suppliers"), F.max("s_acctbal").alias("top_balance")
    )
    scored = congestion.weighted_index(measured, {"suppliers": 0.6, "top_balance": 0.4}, "supplier_index")
    return rounded(nations.join(scored, "n_nationkey"), supplier_index=6)


# --- files --------------------------------------------------------------------------------------


def roundtrip_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    """Silver rows written by month and read back."""
    path = layers.layer_path(scratch_dir(spark), "silver_positions")
    silver = Lake(spark, folder).silver.select("message_id", "heading", "quality_status", "event_date", "year", "month")
    layers.write_layer(silver, path, layers.BY_MONTH)
    return layers.read_layer(spark, path)


def roundtrip_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Raw messages written as CSV and read back as text."""
    path = layers.layer_path(scratch_dir(spark), "raw_messages")
    raw = bronze_ops.with_raw_columns(Lake(spark, folder).raw)
    layers.write_csv(raw.select(*raw_files.RAW_COLUMNS), path)
    return raw_files.read_raw_csv(spark, path).select(*RAW_FIELDS[1:])


def _zip_parts(spark: SparkSession, csv_folder: str, zip_folder: str) -> None:
    """Pack every CSV part file into a zip archive of its own, one task per file, in chunks."""

    def pack(batches):
        import shutil
        import zipfile

        import pandas as pd
        from pyarrow import fs

        for batch in batches:
            for path in batch["path"]:
                system, source = fs.FileSystem.from_uri(path)
                name = source.rsplit("/", 1)[-1]
                _, target = fs.FileSystem.from_uri(zip_uri)
                system.create_dir(target, recursive=True)
                with (
                    system.open_input_stream(source) as text,
                    system.open_output_stream(f"{target}/{name[:-4]}.zip") as sink,
                    zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive,
                    archive.open(name, "w", force_zip64=True) as member,
                ):
                    shutil.copyfileobj(text, member, 1 << 20)
                yield pd.DataFrame({"packed": [name]})

    zip_uri = raw_files.as_uri(zip_folder)
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(csv_folder).select("path")
    parts.mapInPandas(pack, "packed string").write.format("noop").mode("overwrite").save()


def zip_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Raw messages written as CSV, zipped part by part, and read from the archives."""
    root = scratch_dir(spark)
    raw = bronze_ops.with_raw_columns(Lake(spark, folder).raw)
    layers.write_csv(raw.select(*raw_files.RAW_COLUMNS), layers.layer_path(root, "csv"))
    _zip_parts(spark, layers.layer_path(root, "csv"), layers.layer_path(root, "zip"))
    return raw_files.read_raw_zip(spark, layers.layer_path(root, "zip")).select(*RAW_FIELDS[1:])


def pruned_months(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of a span of months, read from the folders of those months only."""
    path = layers.layer_path(scratch_dir(spark), "bronze_messages")
    layers.write_layer(Lake(spark, folder).bronze.select("message_id", "year", "month"), path, layers.BY_MONTH)
    chosen = layers.between_months(layers.read_layer(spark, path), (2023, 12), (2024, 1))
    return chosen.groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count"))


def table_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    lake = Lake(spark, folder, stored=True)
    return reports.table_row_counts(
        {
            "silver_positions": lake.silver,
            "silver_proximity": lake.proximity,
            "silver_stops": lake.stops,
            "silver_quality_report": lake.report,
        }
    )


# --- the whole job ------------------------------------------------------------------------------


def _run(spark: SparkSession, folder: str, settings: Settings = WIDE) -> Pipeline:
    pipeline = Pipeline(spark, scratch_dir(spark), settings)
    pipeline.run(fixture.read_messages(spark, folder), "events.parquet")
    return pipeline


def pipeline_congestion(spark: SparkSession, folder: str) -> DataFrame:
    return shown_congestion(_run(spark, folder).table("gold_congestion")).orderBy("report_date", "port_id")


def pipeline_stops(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_run(spark, folder).table("silver_stops"), dwell_time_minutes=6, avg_speed_knots=9)


def pipeline_silver_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The counts taken while the silver table was written."""
    counts = _run(spark, folder).counts["silver_positions"]
    row = (counts["rows"], counts["valid"], counts["rejected"])
    return spark.createDataFrame([row], "row_count long, valid long, rejected long")


def rerun_changed_settings(spark: SparkSession, folder: str) -> DataFrame:
    """Stops of a second run with other limits over the first run's lake: nothing of the first one is left."""
    first = _run(spark, folder)
    second = Pipeline(spark, first.root, DEFAULTS)
    second.run(fixture.read_messages(spark, folder), "events.parquet")
    return rounded(second.table("silver_stops"), dwell_time_minutes=6, avg_speed_knots=9)


def months_in_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Two sources, both with messages whose time is unreadable, loaded one after the other, the first one twice."""
    raw = fixture.read_messages(spark, folder)
    raw = raw.withColumn("BaseDateTime", F.when(F.col("event_id") % 13 == 0, "unknown").otherwise(F.col("BaseDateTime")))
    pipeline = Pipeline(spark, scratch_dir(spark), DEFAULTS)
    for source, part in (("even", 0), ("odd", 1), ("even", 0)):
        pipeline.bronze(raw.where(F.col("event_id") % 2 == part), source)
    return pipeline.table("bronze_messages").groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count"))


def nearest_port_from_file(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark)
    layers.write_csv(ports_frame(spark).coalesce(1), path)
    ports = load_ports(read_ports(spark, path))
    valid = quality.keep_valid(Lake(spark, folder).silver)
    chosen = nearest.nearest_port(valid, ports).select(
        "message_id", "nearest_port_id", "nearest_port_name", "port_latitude", "port_longitude", "port_radius_km",
        "distance_to_port_km", "is_within_port_radius",
    )
    return rounded(chosen, distance_to_port_km=3)


def catalog_stops_by_port(spark: SparkSession, folder: str) -> DataFrame:
    """SQL over the lake's registered tables, in a database of its own."""
    database = f"portflow_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    register_lake(spark, _run(spark, folder).root, database)
    stops = spark.sql(
        f"""SELECT nearest_port_name, count(*) AS stops, count(DISTINCT mmsi) AS stopped_vessels,
          round(avg(dwell_time_minutes), 8) AS avg_dwell_minutes, round(max(dwell_time_minutes), 8) AS max_dwell_minutes
        FROM {database}.silver_stops GROUP BY nearest_port_name"""
    )
    # The result is resolved by now; the views of the new database hold no files.
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return stops


def congestion_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark)
    layers.write_congestion_csv(_run(spark, folder).table("gold_congestion"), path)
    back = layers.read_congestion_csv(spark, path).withColumn("report_date", F.col("report_date").cast("date"))
    return rounded(
        back, avg_dwell_time_minutes=8, p90_dwell_time_minutes=8, data_quality_rejection_rate=6, port_congestion_index=4
    ).orderBy("report_date", "port_id")


def anomalies_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark)
    layers.write_anomalies_csv(_run(spark, folder).table("gold_anomalies"), path)
    return reports.anomalies_by_type(layers.read_anomalies_csv(spark, path))


def reports_appended(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark)
    for _ in range(2):
        layers.append_rows(Lake(spark, folder).report, path)
    log = layers.read_layer(spark, path)
    return log.groupBy("source_file").agg(F.sum("total_records").alias("total_records"), F.count(F.lit(1)).alias("reports"))


def csv_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Messages written as CSV and read back with the base name of the file each came from."""
    path = scratch_dir(spark)
    raw = bronze_ops.with_raw_columns(Lake(spark, folder).raw)
    layers.write_csv(raw.select(*raw_files.RAW_COLUMNS), path)
    named = F.col("source_file").rlike(r"^part-[^/]*\.csv$").alias("is_base_name")
    return raw_files.read_raw_csv(spark, path).groupBy(named).agg(F.count(F.lit(1)).alias("row_count"))


def bronze_ingestion(spark: SparkSession, folder: str) -> DataFrame:
    shown = F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("ingestion_timestamp")
    return Lake(spark, folder).bronze.select("message_id", "source_file", shown)


def stop_p90_rank_error(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the sketched percentile lies within one rank of the exact one, per day and port."""
    stops = Lake(spark, folder, stored=True).stops
    metrics = congestion.stop_metrics(stops, WIDE, approx=True).select("report_date", "port_id", "p90_dwell_time_minutes")
    ranked = stops.withColumnsRenamed({"stop_date": "report_date", "nearest_port_id": "port_id"}).join(
        metrics, ["report_date", "port_id"]
    )
    value, sketched = F.col("dwell_time_minutes"), F.col("p90_dwell_time_minutes")
    counted = ranked.groupBy("report_date", "port_id").agg(
        F.count(F.lit(1)).alias("stops"), F.count_if(value < sketched).alias("below"), F.count_if(value <= sketched).alias("upto")
    )
    rank = F.col("stops") * WIDE.dwell_percentile
    near = (F.col("below") <= rank + 1) & (F.col("upto") >= rank - 1)
    return counted.select("report_date", "port_id", "stops", near.alias("is_near_rank"))


QUERIES: dict[str, Query] = {
    "bronze_message_ids": bronze_message_ids,
    "bronze_payload_hash": bronze_payload_hash,
    "bronze_padded_dates": bronze_padded_dates,
    "bronze_volume": bronze_volume,
    "quality_flags": quality_flags,
    "quality_reasons": quality_reasons,
    "duplicates_keep_first": _duplicates(duplicates.KEEP_FIRST),
    "duplicates_flag_all": _duplicates(duplicates.FLAG_ALL),
    "lineitem_duplicates": lineitem_duplicates,
    "quality_status_counts": quality_status_counts,
    "quality_status_counts_flag_all": quality_status_counts_flag_all,
    "rejection_reason_counts": rejection_reason_counts,
    "quality_report": quality_report,
    "source_profile": source_profile,
    "sample_exact": sample_exact,
    "sample_by_class": sample_by_class,
    "rejected_capture": rejected_capture,
    "nearest_port": nearest_port,
    "nearest_port_ranked": nearest_port_ranked,
    "port_positions": port_positions,
    "ports_near": ports_near,
    "min_port_distance": min_port_distance,
    "stop_candidates": stop_candidates,
    "temporal_density_top": temporal_density_top,
    "stop_gaps": stop_gaps,
    "stop_episodes": stop_episodes,
    "stop_messages": stop_messages,
    "vessel_stops_default": _vessel_stops(DEFAULTS),
    "vessel_stops_wide": _vessel_stops(WIDE),
    "vessel_stops_session_window": vessel_stops_session_window,
    "stops_by_port": stops_by_port,
    "stop_count": stop_count,
    "vessel_anomalies": vessel_anomalies,
    "anomalies_by_type": anomalies_by_type,
    "anomalies_by_severity": anomalies_by_severity,
    "anomalies_by_port": anomalies_by_port,
    "proximity_metrics": proximity_metrics,
    "stop_metrics": stop_metrics,
    "stop_p90_approx": stop_p90_approx,
    "minmax_normalized": minmax_normalized,
    "port_congestion_daily": port_congestion_daily,
    "port_congestion_left": port_congestion_left,
    "port_congestion_within_day": port_congestion_within_day,
    "congestion_ranking": congestion_ranking,
    "nation_supplier_index": nation_supplier_index,
    "roundtrip_partitioned": roundtrip_partitioned,
    "roundtrip_csv": roundtrip_csv,
    "zip_scan": zip_scan,
    "pruned_months": pruned_months,
    "table_row_counts": table_row_counts,
    "pipeline_congestion": pipeline_congestion,
    "pipeline_stops": pipeline_stops,
    "pipeline_silver_counts": pipeline_silver_counts,
    "rerun_changed_settings": rerun_changed_settings,
    "months_in_two_runs": months_in_two_runs,
    "nearest_port_from_file": nearest_port_from_file,
    "catalog_stops_by_port": catalog_stops_by_port,
    "congestion_csv": congestion_csv,
    "anomalies_csv": anomalies_csv,
    "reports_appended": reports_appended,
    "csv_lineage": csv_lineage,
    "bronze_ingestion": bronze_ingestion,
    "stop_p90_rank_error": stop_p90_rank_error,
}
