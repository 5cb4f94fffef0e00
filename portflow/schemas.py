"""Column lists and schemas of the source files and the lake tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Source column, table column and table type, in file order.
MESSAGE_COLUMNS = (
    ("MMSI", "mmsi", "string"),
    ("BaseDateTime", "event_timestamp", "timestamp"),
    ("LAT", "latitude", "double"),
    ("LON", "longitude", "double"),
    ("SOG", "speed_knots", "double"),
    ("COG", "course", "double"),
    ("Heading", "heading", "double"),
    ("VesselName", "vessel_name", "string"),
    ("IMO", "imo", "string"),
    ("CallSign", "call_sign", "string"),
    ("VesselType", "vessel_type", "string"),
    ("Status", "navigation_status", "string"),
    ("Length", "length", "double"),
    ("Width", "width", "double"),
    ("Draft", "draft", "double"),
    ("Cargo", "cargo", "string"),
    ("TransceiverClass", "transceiver_class", "string"),
)

RAW_COLUMNS = tuple(raw for raw, _, _ in MESSAGE_COLUMNS)

# The raw fields whose text makes up a message id.
MESSAGE_ID_FIELDS = ("MMSI", "BaseDateTime", "LAT", "LON", "SOG", "COG")

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

# Columns of a table, in its order.
PORTS_SCHEMA = T.StructType(
    [
        T.StructField("port_id", T.StringType()),
        T.StructField("port_name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("port_radius_km", T.DoubleType()),
    ]
)

# Columns of a table, in its order.
BRONZE_COLUMNS = (
    "message_id",
    "source_file",
    "ingestion_timestamp",
    "event_timestamp",
    "mmsi",
    *(name for _, name, _ in MESSAGE_COLUMNS[2:]),
    "raw_payload_hash",
    "event_date",
    "year",
    "month",
)

# Columns of a table, in its order.
QUALITY_COLUMNS = (
    "is_valid_coordinate",
    "is_null_vessel_id",
    "is_speed_unavailable",
    "is_impossible_speed",
    "is_valid_speed",
    "is_future_timestamp",
    "is_duplicate",
    "rejection_reason",
    "quality_status",
)

SILVER_COLUMNS = (*BRONZE_COLUMNS[:-2], *QUALITY_COLUMNS, "year", "month")

# Columns of a table, in its order.
STOP_COLUMNS = (
    "stop_id",
    "stop_label",
    "mmsi",
    "nearest_port_id",
    "nearest_port_name",
    "stop_start_timestamp",
    "stop_end_timestamp",
    "dwell_time_minutes",
    "avg_speed_knots",
    "message_count",
    "stop_date",
    "year",
    "month",
)

# Columns of a table, in its order.
ANOMALY_COLUMNS = (
    "anomaly_id",
    "event_timestamp",
    "mmsi",
    "nearest_port_id",
    "nearest_port_name",
    "distance_to_port_km",
    "is_within_port_radius",
    "port_radius_km",
    "anomaly_type",
    "severity",
    "description",
    "source_message_id",
    "created_at",
)

# Columns of a table, in its order.
CONGESTION_COLUMNS = (
    "report_date",
    "port_id",
    "port_name",
    "vessels_near_port",
    "stopped_vessels",
    "avg_dwell_time_minutes",
    "p90_dwell_time_minutes",
    "stopped_position_count",
    "anomaly_count",
    "data_quality_rejection_rate",
    "port_congestion_index",
    "created_at",
)

# Schemas of the two CSV tables, applied by position: the header names are not consulted.
CONGESTION_CSV_SCHEMA = (
    "report_date string, port_id string, port_name string, vessels_near_port bigint, stopped_vessels bigint,"
    " avg_dwell_time_minutes double, p90_dwell_time_minutes double, stopped_position_count bigint,"
    " anomaly_count bigint, data_quality_rejection_rate double, port_congestion_index double"
)

# Columns of a table, in its order.
ANOMALIES_CSV_SCHEMA = (
    "anomaly_id string, event_timestamp string, mmsi string, nearest_port_id string, nearest_port_name string,"
    " distance_to_port_km double, is_within_port_radius string, port_radius_km double, anomaly_type string,"
    " severity string, description string, source_message_id string, created_at string"
)
