"""The same queries as plain SQL (DuckDB dialect) over the driver tables, written independently."""

from __future__ import annotations

RAW = """
ports AS (SELECT * FROM (VALUES
  (0, 'los_angeles_long_beach', 'Los Angeles / Long Beach', 33.7542::DOUBLE, -118.2165::DOUBLE, 20.0::DOUBLE, 337542, '-118.2165'),
  (1, 'new_york_new_jersey', 'New York / New Jersey', 40.6681, -74.0451, 20.0, 406681, '-74.0451'),
  (2, 'houston', 'Houston', 29.7308, -95.2622, 20.0, 297308, '-95.2622'),
  (3, 'savannah', 'Savannah', 32.0809, -81.0912, 20.0, 320809, '-81.0912'),
  (4, 'seattle_tacoma', 'Seattle / Tacoma', 47.6038, -122.3301, 20.0, 476038, '-122.3301'))
  AS t(ord, port_id, port_name, port_latitude, port_longitude, port_radius_km, lat_e4, lon_s)),
base AS (
  SELECT e.event_id, e.user_id, e.event_type, p.lon_s,
    strftime(CASE WHEN e.event_id % 211 = 0 THEN e.ts + INTERVAL 100 YEAR ELSE e.ts END, '%Y-%m-%dT%H:%M:%S') AS bdt,
    CAST(regexp_extract(e.props, '[0-9]+') AS BIGINT) AS k,
    CAST(round(e.value * 100) AS BIGINT) AS c,
    p.lat_e4 + (CAST(regexp_extract(e.props, '[0-9]+') AS BIGINT) - 50) * 50 AS la
  FROM events e JOIN ports p ON p.ord = e.user_id % 5),
raw1 AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0 THEN '' ELSE CAST(366000000 + user_id AS VARCHAR) END AS MMSI,
    bdt AS BaseDateTime,
    CASE WHEN event_id % 89 = 0 THEN '91.0'
         ELSE concat(CAST(la // 10000 AS VARCHAR), '.', lpad(CAST(la % 10000 AS VARCHAR), 4, '0')) END AS LAT,
    CASE WHEN event_id % 101 = 0 THEN '' ELSE lon_s END AS LON,
    CASE event_type
      WHEN 'error' THEN CASE WHEN event_id % 10 = 0 THEN '102.3' WHEN event_id % 13 = 0 THEN '-1.0' ELSE '0.0' END
      WHEN 'purchase' THEN concat(CAST(c // 1000 AS VARCHAR), '.', lpad(CAST(c % 1000 AS VARCHAR), 3, '0'))
      WHEN 'signup' THEN CASE WHEN event_id % 17 = 0 THEN ''
                              ELSE concat(CAST(c // 100 AS VARCHAR), '.', lpad(CAST(c % 100 AS VARCHAR), 2, '0')) END
      ELSE concat(CAST(c // 10000 AS VARCHAR), '.', lpad(CAST(c % 10000 AS VARCHAR), 4, '0')) END AS SOG,
    CAST((k * 36) // 10 AS VARCHAR) AS COG,
    CAST(event_id % 360 AS VARCHAR) AS Heading
  FROM base),
raw AS (
  SELECT event_id, MMSI, BaseDateTime, LAT, LON, SOG, COG, Heading, 0 AS copy FROM raw1
  UNION ALL
  SELECT event_id, MMSI, BaseDateTime, LAT, LON, SOG, COG, '511', 1 FROM raw1 WHERE event_id % 50 = 0
  UNION ALL
  SELECT event_id, MMSI, BaseDateTime, LAT, LON, SOG, COG, Heading, 2 FROM raw1 WHERE event_id % 70 = 0)
"""

_BRONZE = (
    RAW
    + """,
bronze AS (
  SELECT event_id, copy,
    sha256(concat_ws('|', MMSI, BaseDateTime, LAT, LON, SOG, COG)) AS message_id,
    sha256(concat_ws('|', MMSI, BaseDateTime, LAT, LON, SOG, COG, Heading,
                     '', '', '', '', '', '', '', '', '', '')) AS raw_payload_hash,
    TRY_CAST(BaseDateTime AS TIMESTAMP) AS event_timestamp,
    MMSI AS mmsi,
    TRY_CAST(LAT AS DOUBLE) AS latitude, TRY_CAST(LON AS DOUBLE) AS longitude,
    TRY_CAST(SOG AS DOUBLE) AS speed_knots, TRY_CAST(COG AS DOUBLE) AS course, TRY_CAST(Heading AS DOUBLE) AS heading,
    'events.parquet' AS source_file
  FROM raw)
"""
)


def _silver(duplicate: str) -> str:
    return (
        _BRONZE
        + f""",
flags AS (
  SELECT *,
    coalesce(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180, false) AS is_valid_coordinate,
    trim(coalesce(mmsi, '')) = '' AS is_null_vessel_id,
    coalesce(speed_knots = 102.3, false) AS is_speed_unavailable,
    speed_knots IS NULL OR (speed_knots <> 102.3 AND (speed_knots < 0 OR speed_knots > 60)) AS is_impossible_speed,
    coalesce(speed_knots <> 102.3 AND speed_knots >= 0 AND speed_knots <= 60, false) AS is_valid_speed,
    event_timestamp IS NULL OR event_timestamp > TIMESTAMP '2026-01-01 00:00:00' AS is_future_timestamp,
    trim(coalesce(source_file, '')) = '' AS is_null_source_file,
    false AS is_null_ingestion_timestamp,
    {duplicate} AS is_duplicate
  FROM bronze),
silver0 AS (
  SELECT *, concat_ws('|',
    CASE WHEN NOT is_valid_coordinate THEN 'invalid_coordinate' END,
    CASE WHEN is_null_vessel_id THEN 'null_vessel_id' END,
    CASE WHEN is_speed_unavailable THEN 'speed_not_available' END,
    CASE WHEN is_impossible_speed THEN 'impossible_speed' END,
    CASE WHEN is_future_timestamp THEN 'future_timestamp' END,
    CASE WHEN is_null_source_file THEN 'null_source_file' END,
    CASE WHEN is_null_ingestion_timestamp THEN 'null_ingestion_timestamp' END,
    CASE WHEN is_duplicate THEN 'duplicate_message_id' END) AS rejection_reason
  FROM flags),
silver AS (
  SELECT *, CASE WHEN rejection_reason = '' THEN 'valid' ELSE 'rejected' END AS quality_status FROM silver0)
"""
    )


_KEEP_FIRST = "row_number() OVER (PARTITION BY message_id ORDER BY raw_payload_hash, event_id, copy) > 1"
_FLAG_ALL = "count(*) OVER (PARTITION BY message_id) > 1"
SILVER = _silver(_KEEP_FIRST)

_HAVERSINE = """2 * 6371.0 * atan2(
      sqrt(least(1.0, pow(sin(radians(p.port_latitude - s.latitude) / 2), 2)
        + cos(radians(s.latitude)) * cos(radians(p.port_latitude)) * pow(sin(radians(p.port_longitude - s.longitude) / 2), 2))),
      sqrt(greatest(0.0, 1 - (pow(sin(radians(p.port_latitude - s.latitude) / 2), 2)
        + cos(radians(s.latitude)) * cos(radians(p.port_latitude)) * pow(sin(radians(p.port_longitude - s.longitude) / 2), 2)))))"""

_RANKED = (
    SILVER
    + f""",
ranked AS (
  SELECT s.*, p.port_id, p.port_name, p.port_latitude, p.port_longitude, p.port_radius_km,
    {_HAVERSINE} AS km,
    row_number() OVER (PARTITION BY s.event_id, s.copy ORDER BY {_HAVERSINE}, p.ord) AS port_rank
  FROM silver s, ports p WHERE s.latitude IS NOT NULL AND s.longitude IS NOT NULL)
"""
)

_PROXIMITY = (
    _RANKED
    + """,
proximity AS (
  SELECT message_id, event_timestamp, mmsi, speed_knots, port_id AS nearest_port_id, port_name AS nearest_port_name,
    port_latitude, port_longitude, port_radius_km, km AS distance_to_port_km,
    km <= port_radius_km AS is_within_port_radius
  FROM ranked WHERE port_rank = 1 AND quality_status = 'valid'),
candidates AS (
  SELECT * FROM proximity WHERE is_within_port_radius AND speed_knots < 1)
"""
)


def stops_ctes(gap_minutes: int, dwell_minutes: int, shift_days: int = 0) -> str:
    return (
        _PROXIMITY
        + f""",
moved AS (SELECT * REPLACE (event_timestamp + INTERVAL {shift_days} DAY AS event_timestamp) FROM candidates),
gaps AS (
  SELECT *, lag(event_timestamp) OVER (PARTITION BY mmsi, nearest_port_id ORDER BY event_timestamp) AS previous
  FROM moved),
marked AS (
  SELECT *, CASE WHEN previous IS NULL OR date_diff('microsecond', previous, event_timestamp) / 6e7 > {gap_minutes}
                 THEN 1 ELSE 0 END AS starts
  FROM gaps),
numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY mmsi, nearest_port_id ORDER BY event_timestamp
                              RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS episode
  FROM marked),
episodes AS (
  SELECT mmsi, nearest_port_id, nearest_port_name, episode, min(event_timestamp) AS episode_start,
    max(event_timestamp) AS episode_end, count(*) AS message_count, avg(speed_knots) AS avg_speed_knots
  FROM numbered GROUP BY ALL),
dwelling AS (
  SELECT *, date_diff('microsecond', episode_start, episode_end) / 6e7 AS dwell_time_minutes FROM episodes),
stops AS (
  SELECT *, row_number() OVER (PARTITION BY mmsi, nearest_port_id ORDER BY episode_start) AS sequence,
    CAST(episode_start AS DATE) AS stop_date
  FROM dwelling WHERE dwell_time_minutes >= {dwell_minutes})
"""
    )


_STOPS_DEFAULT = stops_ctes(60, 30)
_STOPS_WIDE = stops_ctes(1440, 720)

_ANOMALY_CTES = """,
located AS (
  SELECT s.message_id, s.event_timestamp, s.mmsi, s.rejection_reason, r.port_id AS nearest_port_id,
    r.port_name AS nearest_port_name, r.km AS distance_to_port_km,
    coalesce(r.km <= r.port_radius_km, false) AS is_within_port_radius, r.port_radius_km
  FROM silver s LEFT JOIN ranked r
    ON r.event_id = s.event_id AND r.copy = s.copy AND r.port_rank = 1
  WHERE s.quality_status = 'rejected'),
anomalies AS (
  SELECT *, sha256(concat_ws('|', message_id, anomaly_type)) AS anomaly_id,
    CASE WHEN anomaly_type IN ('invalid_coordinate', 'future_timestamp', 'null_vessel_id') THEN 'high'
         WHEN anomaly_type IN ('impossible_speed', 'duplicate_message_id') THEN 'medium'
         WHEN anomaly_type = 'speed_not_available' THEN 'low' ELSE 'unknown' END AS severity,
    CASE anomaly_type
      WHEN 'invalid_coordinate' THEN 'Latitude or longitude is missing or off the globe.'
      WHEN 'null_vessel_id' THEN 'The message names no vessel.'
      WHEN 'speed_not_available' THEN 'The speed field holds the marker for a speed that is not available.'
      WHEN 'impossible_speed' THEN 'The speed is missing, negative or above the plausible maximum.'
      WHEN 'future_timestamp' THEN 'The event time is missing or after the processing time.'
      WHEN 'duplicate_message_id' THEN 'Another message carries the same id.'
      ELSE 'Rejected for a reason without a description.' END AS description
  FROM (SELECT *, unnest(string_split(rejection_reason, '|')) AS anomaly_type FROM located))
"""

_ANOMALIES = _RANKED + _ANOMALY_CTES

_METRICS = (
    _STOPS_WIDE
    + _ANOMALY_CTES
    + """,
near_ports AS (
  SELECT CAST(event_timestamp AS DATE) AS report_date, nearest_port_id AS port_id,
    count(DISTINCT mmsi) AS vessels_near_port, count(*) FILTER (speed_knots < 1) AS stopped_position_count
  FROM proximity WHERE is_within_port_radius GROUP BY ALL),
stopped AS (
  SELECT stop_date AS report_date, nearest_port_id AS port_id, count(*) AS stops,
    count(DISTINCT mmsi) AS stopped_vessels, avg(dwell_time_minutes) AS avg_dwell_time_minutes,
    quantile_cont(dwell_time_minutes, 0.9) AS p90_dwell_time_minutes
  FROM stops GROUP BY ALL),
flagged_ports AS (
  SELECT CAST(event_timestamp AS DATE) AS report_date, nearest_port_id AS port_id, count(*) AS anomaly_count
  FROM anomalies WHERE is_within_port_radius GROUP BY ALL),
rate AS (
  SELECT count(*) FILTER (quality_status = 'rejected') / count(*) AS rejection_rate FROM silver)
"""
)


def _merged(join: str, with_anomalies: bool = True) -> str:
    return (
        _METRICS
        + f""",
merged AS (
  SELECT report_date, port_id, coalesce(vessels_near_port, 0) AS vessels_near_port,
    coalesce(stopped_vessels, 0) AS stopped_vessels,
    coalesce(avg_dwell_time_minutes, 0.0) AS avg_dwell_time_minutes,
    coalesce(p90_dwell_time_minutes, 0.0) AS p90_dwell_time_minutes,
    coalesce(stopped_position_count, 0) AS stopped_position_count,
    {"coalesce(anomaly_count, 0)" if with_anomalies else "CAST(0 AS BIGINT)"} AS anomaly_count
  FROM near_ports {join} JOIN stopped USING (report_date, port_id)
  {join} JOIN flagged_ports USING (report_date, port_id)),
named AS (
  SELECT m.*, p.port_name, r.rejection_rate AS data_quality_rejection_rate
  FROM merged m LEFT JOIN ports p USING (port_id), rate r)
"""
    )


def _scaled(column: str, over: str) -> str:
    return (
        f"CASE WHEN max({column}) OVER ({over}) = min({column}) OVER ({over}) THEN 0.0 ELSE "
        f"({column} - min({column}) OVER ({over}))::DOUBLE / (max({column}) OVER ({over}) - min({column}) OVER ({over})) END"
    )


def _congestion(join: str, with_anomalies: bool = True, over: str = "") -> str:
    return (
        _merged(join, with_anomalies)
        + f""",
congestion AS (
  SELECT *, 0.40::DOUBLE * {_scaled('stopped_vessels', over)}
    + 0.35::DOUBLE * {_scaled('avg_dwell_time_minutes', over)}
    + 0.25::DOUBLE * {_scaled('stopped_position_count', over)} AS port_congestion_index
  FROM named)
"""
    )


_CONGESTION_COLUMNS = """report_date, port_id, port_name, vessels_near_port, stopped_vessels,
  round(avg_dwell_time_minutes, 8) AS avg_dwell_time_minutes, round(p90_dwell_time_minutes, 8) AS p90_dwell_time_minutes,
  stopped_position_count, anomaly_count, round(data_quality_rejection_rate, 6) AS data_quality_rejection_rate,
  round(port_congestion_index, 4) AS port_congestion_index"""

STOP_SELECT = """
SELECT sha256(concat_ws('|', mmsi, nearest_port_id, strftime(episode_start, '%Y%m%d%H%M%S'))) AS stop_id,
  concat_ws('_', mmsi, nearest_port_id, strftime(episode_start, '%Y%m%dT%H%M%S'), CAST(sequence AS VARCHAR)) AS stop_label,
  mmsi, nearest_port_id, nearest_port_name, episode_start AS stop_start_timestamp, episode_end AS stop_end_timestamp,
  round(dwell_time_minutes, 6) AS dwell_time_minutes, round(avg_speed_knots, 9) AS avg_speed_knots, message_count,
  stop_date, CAST(year(stop_date) AS INTEGER) AS year, CAST(month(stop_date) AS INTEGER) AS month
FROM stops"""

_RAW_FIELDS = "event_id, MMSI, BaseDateTime, LAT, LON, SOG, COG, Heading"

_PROFILE = (
    RAW
    + """,
checked AS (
  SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY event_id, Heading, copy) > 1 AS is_duplicate
  FROM (SELECT *, sha256(concat_ws('|', MMSI, BaseDateTime, LAT, LON, SOG, COG)) AS message_id FROM raw)),
reasoned AS (
  SELECT *, concat_ws('|',
    CASE WHEN NOT coalesce(TRY_CAST(LAT AS DOUBLE) BETWEEN -90 AND 90 AND TRY_CAST(LON AS DOUBLE) BETWEEN -180 AND 180, false)
         THEN 'invalid_coordinate' END,
    CASE WHEN trim(coalesce(MMSI, '')) = '' THEN 'null_vessel_id' END,
    CASE WHEN NOT coalesce(TRY_CAST(SOG AS DOUBLE) BETWEEN 0 AND 60, false) THEN 'invalid_speed' END,
    CASE WHEN coalesce(TRY_CAST(BaseDateTime AS TIMESTAMP) > TIMESTAMP '2026-01-01', true) THEN 'future_timestamp' END,
    CASE WHEN is_duplicate THEN 'duplicate_message_id' END) AS quality_reasons,
    sha256(concat_ws('|', CAST(event_id AS VARCHAR), Heading, '42')) AS token
  FROM checked),
caught AS (SELECT * FROM reasoned WHERE quality_reasons <> '' ORDER BY token, copy LIMIT 300),
passed AS (
  SELECT * FROM reasoned WHERE quality_reasons = ''
  ORDER BY token LIMIT (SELECT 1000 - count(*) FROM caught))
"""
)


def with_ctes(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


ORACLES: dict[str, str] = {
    "bronze_message_ids": with_ctes(
        _BRONZE,
        """SELECT message_id, event_timestamp, mmsi, latitude, longitude, speed_knots, course, heading,
          CAST(event_timestamp AS DATE) AS event_date, CAST(year(event_timestamp) AS INTEGER) AS year,
          CAST(month(event_timestamp) AS INTEGER) AS month FROM bronze""",
    ),
    "bronze_payload_hash": with_ctes(_BRONZE, "SELECT raw_payload_hash, source_file FROM bronze"),
    "bronze_padded_dates": with_ctes(
        _BRONZE,
        """SELECT strftime(event_timestamp, '%Y') AS year, strftime(event_timestamp, '%m') AS month,
          strftime(event_timestamp, '%d') AS day, count(*) AS row_count FROM bronze GROUP BY ALL""",
    ),
    "bronze_volume": with_ctes(
        _BRONZE,
        """SELECT count(*) AS row_count, min(event_timestamp) AS min_event_timestamp,
          max(event_timestamp) AS max_event_timestamp FROM bronze""",
    ),
    "quality_flags": with_ctes(
        SILVER,
        """SELECT message_id, heading, is_valid_coordinate, is_null_vessel_id, is_speed_unavailable,
          is_impossible_speed, is_valid_speed, is_future_timestamp, is_null_source_file,
          is_null_ingestion_timestamp, is_duplicate FROM silver""",
    ),
    "quality_reasons": with_ctes(SILVER, "SELECT message_id, heading, rejection_reason, quality_status FROM silver"),
    "duplicates_keep_first": with_ctes(
        _BRONZE, f"SELECT message_id, raw_payload_hash, {_KEEP_FIRST} AS is_duplicate FROM bronze"
    ),
    "duplicates_flag_all": with_ctes(
        _BRONZE, f"SELECT message_id, raw_payload_hash, {_FLAG_ALL} AS is_duplicate FROM bronze"
    ),
    "lineitem_duplicates": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
      row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                         ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) > 1 AS is_duplicate
      FROM lineitem""",
    "quality_status_counts": with_ctes(
        SILVER, "SELECT quality_status, count(*) AS row_count FROM silver GROUP BY ALL ORDER BY quality_status"
    ),
    "quality_status_counts_flag_all": with_ctes(
        _silver(_FLAG_ALL),
        "SELECT quality_status, count(*) AS row_count FROM silver GROUP BY ALL ORDER BY quality_status",
    ),
    "rejection_reason_counts": with_ctes(
        SILVER,
        """SELECT rejection_reason, count(*) AS row_count FROM silver WHERE quality_status = 'rejected'
          GROUP BY ALL ORDER BY row_count DESC, rejection_reason""",
    ),
    "quality_report": with_ctes(
        SILVER,
        """SELECT DATE '2026-01-01' AS processing_date, 'events.parquet' AS source_file, count(*) AS total_records,
          count(*) FILTER (quality_status = 'valid') AS valid_records,
          count(*) FILTER (quality_status = 'rejected') AS rejected_records,
          count(*) FILTER (NOT is_valid_coordinate) AS invalid_coordinates_count,
          count(*) FILTER (is_null_vessel_id) AS null_vessel_id_count,
          count(*) FILTER (is_duplicate) AS duplicate_records_count,
          count(*) FILTER (is_impossible_speed) AS impossible_speed_count,
          count(*) FILTER (is_speed_unavailable) AS unavailable_speed_count,
          count(*) FILTER (is_future_timestamp) AS future_timestamp_count,
          count(*) FILTER (is_null_source_file) AS null_source_file_count,
          count(*) FILTER (is_null_ingestion_timestamp) AS null_ingestion_timestamp_count,
          round(count(*) FILTER (quality_status = 'rejected') / count(*), 6) AS rejection_rate FROM silver""",
    ),
    "source_profile": with_ctes(
        _PROFILE,
        """SELECT 'events.parquet' AS source_file, count(*) AS total_records,
          count(*) FILTER (quality_reasons = '') AS valid_records,
          count(*) FILTER (quality_reasons <> '') AS rejected_records,
          count(*) FILTER (quality_reasons LIKE '%invalid_coordinate%') AS invalid_coordinates_count,
          count(*) FILTER (quality_reasons LIKE '%null_vessel_id%') AS null_vessel_id_count,
          count(*) FILTER (is_duplicate) AS duplicate_records_count,
          count(*) FILTER (quality_reasons LIKE '%invalid_speed%') AS impossible_speed_count,
          count(*) FILTER (quality_reasons LIKE '%future_timestamp%') AS future_timestamp_count,
          round(count(*) FILTER (quality_reasons <> '') / count(*), 6) AS rejection_rate,
          (SELECT count(*) FROM caught) + (SELECT count(*) FROM passed) AS quality_sample_rows,
          (SELECT count(*) FROM caught) AS anomaly_rows_captured FROM reasoned""",
    ),
    "sample_exact": with_ctes(
        RAW,
        f"""SELECT {_RAW_FIELDS} FROM raw
          ORDER BY sha256(concat_ws('|', CAST(event_id AS VARCHAR), Heading, '42')) LIMIT 2000""",
    ),
    "sample_by_class": with_ctes(
        _PROFILE, f"SELECT {_RAW_FIELDS} FROM caught UNION ALL SELECT {_RAW_FIELDS} FROM passed"
    ),
    "rejected_capture": with_ctes(_PROFILE, f"SELECT {_RAW_FIELDS}, quality_reasons FROM caught"),
    "nearest_port": with_ctes(
        _PROXIMITY,
        """SELECT message_id, nearest_port_id, nearest_port_name, port_latitude, port_longitude, port_radius_km,
          round(distance_to_port_km, 3) AS distance_to_port_km, is_within_port_radius FROM proximity""",
    ),
    "nearest_port_ranked": with_ctes(
        _RANKED,
        """SELECT message_id, CAST(port_rank AS INTEGER) AS port_rank, port_id, round(km, 3) AS distance_to_port_km,
          km <= port_radius_km AS is_within_port_radius FROM ranked WHERE quality_status = 'valid' AND port_rank <= 2""",
    ),
    "port_positions": with_ctes(
        _PROXIMITY,
        """SELECT nearest_port_name, count(*) AS total_positions,
          count(*) FILTER (is_within_port_radius) AS positions_within_radius, count(DISTINCT mmsi) AS distinct_vessels
          FROM proximity GROUP BY ALL ORDER BY positions_within_radius DESC, nearest_port_name""",
    ),
    "ports_near": with_ctes(
        _PROXIMITY,
        """SELECT nearest_port_name, count(DISTINCT mmsi) AS distinct_vessels, count(*) AS positions
          FROM proximity WHERE is_within_port_radius GROUP BY ALL ORDER BY nearest_port_name""",
    ),
    "min_port_distance": with_ctes(
        _PROXIMITY, "SELECT count(*) AS row_count, round(min(distance_to_port_km), 3) AS min_distance_km FROM proximity"
    ),
    "stop_candidates": with_ctes(
        _PROXIMITY,
        """SELECT count(*) AS candidate_stopped_positions, count(DISTINCT mmsi) AS distinct_vessels FROM candidates""",
    ),
    "temporal_density_top": with_ctes(
        _PROXIMITY,
        """SELECT mmsi, nearest_port_name, count(*) AS stopped_messages, min(event_timestamp) AS first_timestamp,
          max(event_timestamp) AS last_timestamp,
          date_diff('second', min(event_timestamp), max(event_timestamp)) // 60 AS raw_time_span_minutes
          FROM candidates GROUP BY ALL
          ORDER BY stopped_messages DESC, raw_time_span_minutes DESC, mmsi, nearest_port_name LIMIT 20""",
    ),
    "stop_gaps": with_ctes(
        _STOPS_WIDE,
        """SELECT mmsi, nearest_port_id, event_timestamp, message_count, previous_timestamp,
          round(date_diff('microsecond', previous_timestamp, event_timestamp) / 6e7, 6) AS gap_minutes,
          is_new_episode, episode
          FROM (SELECT mmsi, nearest_port_id, event_timestamp, count(*) AS message_count,
                  min(previous) AS previous_timestamp, max(starts) = 1 AS is_new_episode,
                  CAST(max(episode) AS BIGINT) AS episode
                FROM numbered GROUP BY mmsi, nearest_port_id, event_timestamp)""",
    ),
    "stop_episodes": with_ctes(
        _STOPS_WIDE,
        """SELECT mmsi, nearest_port_id, CAST(episode AS BIGINT) AS episode, episode_start, episode_end, message_count,
          round(avg_speed_knots, 9) AS avg_speed_knots FROM episodes""",
    ),
    "stop_messages": with_ctes(
        _STOPS_WIDE,
        "SELECT message_id, mmsi, nearest_port_id, event_timestamp, CAST(episode AS BIGINT) AS episode FROM numbered",
    ),
    "vessel_stops_default": with_ctes(_STOPS_DEFAULT, STOP_SELECT),
    "vessel_stops_wide": with_ctes(_STOPS_WIDE, STOP_SELECT),
    "vessel_stops_session_window": with_ctes(
        _STOPS_WIDE, "SELECT mmsi, nearest_port_id, episode_start, episode_end, message_count FROM episodes"
    ),
    "stops_by_port": with_ctes(
        _STOPS_WIDE,
        """SELECT nearest_port_name, count(*) AS stops, count(DISTINCT mmsi) AS stopped_vessels,
          round(avg(dwell_time_minutes), 8) AS avg_dwell_minutes, round(max(dwell_time_minutes), 8) AS max_dwell_minutes
          FROM stops GROUP BY ALL ORDER BY stops DESC, nearest_port_name""",
    ),
    "stop_count": with_ctes(_STOPS_DEFAULT, "SELECT count(*) AS stop_count FROM stops"),
    "vessel_anomalies": with_ctes(
        _ANOMALIES,
        """SELECT anomaly_id, event_timestamp, mmsi, nearest_port_id, nearest_port_name,
          round(distance_to_port_km, 3) AS distance_to_port_km, is_within_port_radius, port_radius_km, anomaly_type,
          severity, description, message_id AS source_message_id FROM anomalies""",
    ),
    "anomalies_by_type": with_ctes(
        _ANOMALIES,
        """SELECT anomaly_type, severity, count(*) AS anomaly_count FROM anomalies GROUP BY ALL
          ORDER BY anomaly_count DESC, anomaly_type""",
    ),
    "anomalies_by_severity": with_ctes(
        _ANOMALIES, "SELECT severity, count(*) AS anomaly_count FROM anomalies GROUP BY ALL ORDER BY severity"
    ),
    "anomalies_by_port": with_ctes(
        _ANOMALIES,
        """SELECT nearest_port_name, count(*) AS anomaly_count FROM anomalies WHERE is_within_port_radius
          GROUP BY ALL ORDER BY anomaly_count DESC, nearest_port_name""",
    ),
    "proximity_metrics": with_ctes(
        _METRICS, "SELECT report_date, port_id, vessels_near_port, stopped_position_count FROM near_ports"
    ),
    "stop_metrics": with_ctes(
        _METRICS,
        """SELECT report_date, port_id, stops, stopped_vessels,
          round(avg_dwell_time_minutes, 8) AS avg_dwell_time_minutes,
          round(p90_dwell_time_minutes, 8) AS p90_dwell_time_minutes FROM stopped""",
    ),
    "minmax_normalized": with_ctes(
        _merged("FULL"),
        f"""SELECT report_date, port_id, round({_scaled('stopped_vessels', '')}, 6) AS normalized_stopped_vessels,
          round({_scaled('avg_dwell_time_minutes', '')}, 6) AS normalized_avg_dwell_time_minutes,
          round({_scaled('stopped_position_count', '')}, 6) AS normalized_stopped_position_count FROM named""",
    ),
    "port_congestion_daily": with_ctes(
        _congestion("FULL"), f"SELECT {_CONGESTION_COLUMNS} FROM congestion ORDER BY report_date, port_id"
    ),
    "port_congestion_left": with_ctes(
        _congestion("LEFT", with_anomalies=False),
        f"SELECT {_CONGESTION_COLUMNS} FROM congestion ORDER BY report_date, port_id",
    ),
    "port_congestion_within_day": with_ctes(
        _congestion("LEFT", over="PARTITION BY report_date"),
        f"SELECT {_CONGESTION_COLUMNS} FROM congestion ORDER BY report_date, port_id",
    ),
    "congestion_ranking": with_ctes(
        _congestion("FULL"),
        """SELECT report_date, port_id, port_name, round(port_congestion_index, 4) AS port_congestion_index
          FROM congestion ORDER BY congestion.port_congestion_index DESC, report_date, port_id LIMIT 20""",
    ),
    "nation_supplier_index": """WITH measured AS (
        SELECT s_nationkey AS n_nationkey, count(*) AS suppliers, max(s_acctbal) AS top_balance FROM supplier GROUP BY ALL)
      SELECT n_nationkey, n_name, suppliers, top_balance, round(
        0.6 * coalesce((suppliers - min(suppliers) OVER ())::DOUBLE / nullif(max(suppliers) OVER () - min(suppliers) OVER (), 0), 0)
        + 0.4 * coalesce((top_balance - min(top_balance) OVER ()) / nullif(max(top_balance) OVER () - min(top_balance) OVER (), 0), 0),
        6) AS supplier_index
      FROM measured JOIN nation USING (n_nationkey)""",
    "roundtrip_partitioned": with_ctes(
        SILVER,
        """SELECT message_id, heading, quality_status, CAST(event_timestamp AS DATE) AS event_date,
          CAST(year(event_timestamp) AS INTEGER) AS year, CAST(month(event_timestamp) AS INTEGER) AS month FROM silver""",
    ),
    "roundtrip_csv": with_ctes(
        RAW,
        """SELECT nullif(MMSI, '') AS MMSI, BaseDateTime, LAT, nullif(LON, '') AS LON, nullif(SOG, '') AS SOG, COG, Heading
          FROM raw""",
    ),
    "zip_scan": with_ctes(RAW, "SELECT MMSI, BaseDateTime, LAT, LON, SOG, COG, Heading FROM raw"),
    "pruned_months": with_ctes(
        _BRONZE,
        """SELECT CAST(year(event_timestamp) AS INTEGER) AS year, CAST(month(event_timestamp) AS INTEGER) AS month,
          count(*) AS row_count FROM bronze
          WHERE event_timestamp >= TIMESTAMP '2023-12-01' AND event_timestamp < TIMESTAMP '2024-02-01' GROUP BY ALL""",
    ),
    "table_row_counts": with_ctes(
        _STOPS_WIDE,
        """SELECT 'silver_positions' AS table_name, count(*) AS row_count FROM silver
          UNION ALL SELECT 'silver_proximity', count(*) FROM proximity
          UNION ALL SELECT 'silver_stops', count(*) FROM stops
          UNION ALL SELECT 'silver_quality_report', 1""",
    ),
}

# The whole job, and sources and sinks of the lake: the results are those of the queries above.
ORACLES |= {
    "pipeline_congestion": ORACLES["port_congestion_daily"],
    "pipeline_stops": ORACLES["vessel_stops_wide"],
    "pipeline_silver_counts": with_ctes(
        SILVER,
        """SELECT count(*) AS row_count, count(*) FILTER (quality_status = 'valid') AS valid,
          count(*) FILTER (quality_status = 'rejected') AS rejected FROM silver""",
    ),
    "rerun_changed_settings": ORACLES["vessel_stops_default"],
    "months_in_two_runs": with_ctes(
        RAW,
        """SELECT CAST(year(seen) AS INTEGER) AS year, CAST(month(seen) AS INTEGER) AS month, count(*) AS row_count
          FROM (SELECT CASE WHEN event_id % 13 = 0 THEN NULL ELSE TRY_CAST(BaseDateTime AS TIMESTAMP) END AS seen FROM raw)
          GROUP BY ALL""",
    ),
    "nearest_port_from_file": ORACLES["nearest_port"],
    "catalog_stops_by_port": ORACLES["stops_by_port"],
    "congestion_csv": ORACLES["port_congestion_daily"],
    "anomalies_csv": ORACLES["anomalies_by_type"],
    "reports_appended": with_ctes(
        SILVER,
        """SELECT 'events.parquet' AS source_file, count(*) * 2 AS total_records, 2::BIGINT AS reports FROM silver""",
    ),
    "csv_lineage": with_ctes(RAW, "SELECT true AS is_base_name, count(*) AS row_count FROM raw"),
    "bronze_ingestion": with_ctes(
        _BRONZE, "SELECT message_id, source_file, '2026-01-01 00:00:00' AS ingestion_timestamp FROM bronze"
    ),
    "stop_p90_rank_error": with_ctes(
        _STOPS_WIDE,
        """SELECT stop_date AS report_date, nearest_port_id AS port_id, count(*) AS stops, true AS is_near_rank
          FROM stops GROUP BY ALL""",
    ),
}
