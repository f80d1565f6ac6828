"""DuckDB SQL for the registered queries, as one chain of views with a final SELECT each."""

from __future__ import annotations

from fieldgauge.checks.fixtures import NOW, REFERENCE_SQL, TELEMETRY_SQL
from fieldgauge.sources.schemas import (
    ALERT_COLUMNS,
    CURRENT_COLUMNS,
    EVENT_SCHEMA,
    KPI_COLUMNS,
    KPI_DUTY_CYCLES,
    QUARANTINE_COLUMNS,
    REFERENCE_SCHEMA,
    SILVER_COLUMNS,
)

TS_NOW = f"TIMESTAMP '{NOW}'"


def rounded(x: str) -> str:
    """Half up on the decimal text of a double, as Spark rounds."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"


def averaged(x: str, factor: int = 1) -> str:
    """Average in whole billionths, rounded half up to hundredths by integer division."""
    total, n = f"sum(CAST(round({x} * 1000000000) AS HUGEINT)) * {factor}", f"count({x})"
    return f"CAST((2 * {total} + {n} * 10000000) // (20000000 * {n}) AS DOUBLE) / 100"


def listed(columns, prefix: str = "") -> str:
    return ", ".join(f'{prefix}"{c}"' for c in columns)


def _range(name: str, value: str, lo: str, hi: str) -> str:
    return (
        f"CASE WHEN {lo} IS NULL OR {hi} IS NULL THEN 'UNKNOWN' WHEN {value} < {lo} THEN 'LOW' "
        f"WHEN {value} > {hi} THEN 'HIGH' ELSE 'NORMAL' END AS {name}"
    )


_STATUSES = ",\n".join(
    [
        _range("ph_status", "ph", "ph_min", "ph_max"),
        _range("ec_status", "ec_ms_cm", "ec_min_ms_cm", "ec_max_ms_cm"),
        _range("water_temp_status", "water_temp_c", "water_temp_min_c", "water_temp_max_c"),
        _range("water_level_status", "water_level_cm", "water_level_min_cm", "water_level_max_cm"),
        _range("humidity_status", "humidity_pct", "humidity_min_pct", "humidity_max_pct"),
        "CASE WHEN do_min_mg_l IS NULL THEN 'UNKNOWN' WHEN dissolved_oxygen_mg_l < do_min_mg_l THEN 'LOW' "
        "ELSE 'NORMAL' END AS do_status",
    ]
)
_STATUS_NAMES = ["ph_status", "ec_status", "water_temp_status", "water_level_status", "humidity_status", "do_status"]
_ANOMALIES = " + ".join(f"CAST({s} IN ('LOW', 'HIGH') AS INTEGER)" for s in _STATUS_NAMES)

_AVERAGED = {
    "avg_ph": "ph", "avg_ec_ms_cm": "ec_ms_cm", "avg_water_temp_c": "water_temp_c",
    "avg_water_level_cm": "water_level_cm", "avg_do_mg_l": "dissolved_oxygen_mg_l",
    "avg_ambient_temp_c": "ambient_temp_c", "avg_humidity_pct": "humidity_pct", "avg_co2_ppm": "co2_ppm",
}


def _conditions(current: str, extra: str = "") -> str:
    """Six filters put together, one per metric."""
    parts = []
    for prefix, status, value, lo, hi in [
        ("PH_", "ph_status", "ph", "ph_min", "ph_max"),
        ("EC_", "ec_status", "ec_ms_cm", "ec_min_ms_cm", "ec_max_ms_cm"),
        ("WATER_TEMP_", "water_temp_status", "water_temp_c", "water_temp_min_c", "water_temp_max_c"),
        ("WATER_LEVEL_", "water_level_status", "water_level_cm", "water_level_min_cm", "water_level_max_cm"),
        ("HUMIDITY_", "humidity_status", "humidity_pct", "humidity_min_pct", "humidity_max_pct"),
        ("DISSOLVED_OXYGEN_", "do_status", "dissolved_oxygen_mg_l", "do_min_mg_l", "CAST(NULL AS DOUBLE)"),
    ]:
        parts.append(
            f"SELECT {extra}farm_id, zone_id, crop_type, location, state, '{prefix}' || {status} AS alert_type, "
            f"{value} AS current_value, {lo} AS min_threshold, {hi} AS max_threshold, {status} AS metric_status, "
            f"severity, last_reading_at AS detected_at FROM {current} WHERE {status} IN ('LOW', 'HIGH')"
        )
    return "\nUNION ALL\n".join(parts)


_LATEST = "ORDER BY event_timestamp DESC NULLS LAST, eventhub_enqueued_time DESC NULLS LAST, eventhub_offset DESC NULLS LAST"

_CTES = {
    "t": TELEMETRY_SQL,
    "m": REFERENCE_SQL,
    "flagged": """
        SELECT *,
          event_id IS NOT NULL AND farm_id IS NOT NULL AND zone_id IS NOT NULL AND device_id IS NOT NULL
            AND seq_num IS NOT NULL AND "timestamp" IS NOT NULL AND ph IS NOT NULL AND ec_ms_cm IS NOT NULL
            AND water_level_cm IS NOT NULL AND water_temp_c IS NOT NULL AND dissolved_oxygen_mg_l IS NOT NULL
            AS required_fields_valid,
          ph BETWEEN 0 AND 14 AS ph_valid,
          ec_ms_cm BETWEEN 0 AND 10 AS ec_valid,
          water_temp_c BETWEEN 0 AND 50 AS water_temp_valid,
          water_level_cm BETWEEN 0 AND 100 AS water_level_valid,
          dissolved_oxygen_mg_l BETWEEN 0 AND 20 AS do_valid,
          humidity_pct BETWEEN 0 AND 100 AS humidity_valid
        FROM t""",
    "v": """
        SELECT *,
          required_fields_valid AND ph_valid AND ec_valid AND water_temp_valid AND water_level_valid AND do_valid
            AND humidity_valid AS is_valid_record,
          CASE WHEN NOT required_fields_valid THEN 'MISSING_REQUIRED_FIELD' WHEN NOT ph_valid THEN 'INVALID_PH'
            WHEN NOT ec_valid THEN 'INVALID_EC' WHEN NOT water_temp_valid THEN 'INVALID_WATER_TEMPERATURE'
            WHEN NOT water_level_valid THEN 'INVALID_WATER_LEVEL'
            WHEN NOT do_valid THEN 'INVALID_DISSOLVED_OXYGEN' WHEN NOT humidity_valid THEN 'INVALID_HUMIDITY'
            END AS validation_error
        FROM flagged""",
    "d": """
        SELECT * FROM v WHERE is_valid_record
        QUALIFY row_number() OVER (
          PARTITION BY event_id ORDER BY eventhub_enqueued_time, eventhub_partition, eventhub_offset) = 1""",
    "lagged": """
        SELECT *, event_time AS event_timestamp,
          lag(seq_num) OVER (PARTITION BY farm_id, zone_id, device_id ORDER BY seq_num, event_id) AS previous_seq_num
        FROM d""",
    "s": """
        SELECT *,
          CAST(CASE WHEN previous_seq_num IS NULL THEN 0
            WHEN seq_num > previous_seq_num + 1 THEN seq_num - previous_seq_num - 1 ELSE 0 END AS BIGINT)
            AS missing_packet_count,
          previous_seq_num IS NOT NULL AND seq_num > previous_seq_num + 1 AS has_sequence_gap
        FROM lagged""",
    "e": """
        SELECT s.*, m.* EXCLUDE (farm_id, zone_id), m.crop_type IS NOT NULL AS master_data_matched
        FROM s LEFT JOIN m ON s.farm_id = m.farm_id AND s.zone_id = m.zone_id""",
    "statuses": f"SELECT *, {_STATUSES} FROM e",
    "counted": f"SELECT *, CAST({_ANOMALIES} AS INTEGER) AS anomaly_count FROM statuses",
    "g": """
        SELECT *, anomaly_count > 0 AS is_anomaly,
          CASE WHEN NOT master_data_matched THEN 'UNKNOWN' WHEN anomaly_count >= 3 THEN 'HIGH'
            WHEN anomaly_count = 2 THEN 'MEDIUM' WHEN anomaly_count = 1 THEN 'LOW' ELSE 'NONE' END AS severity,
          CASE WHEN NOT master_data_matched THEN 'UNKNOWN' WHEN anomaly_count >= 3 THEN 'CRITICAL'
            WHEN anomaly_count >= 1 THEN 'ATTENTION' ELSE 'HEALTHY' END AS overall_status
        FROM counted""",
    "silver": f"""
        SELECT {listed(SILVER_COLUMNS)} FROM (SELECT *, {TS_NOW} AS silver_processed_at FROM g)
        WHERE master_data_matched""",
    "invalid": f"""
        SELECT {listed(QUARANTINE_COLUMNS)} FROM (
          SELECT *, {TS_NOW} AS rejected_at, 'SILVER' AS rejection_layer FROM v WHERE NOT is_valid_record)
        UNION ALL
        SELECT {listed(QUARANTINE_COLUMNS)} FROM (
          SELECT * EXCLUDE (validation_error), 'MASTER_DATA_NOT_FOUND' AS validation_error,
            {TS_NOW} AS rejected_at, 'SILVER' AS rejection_layer FROM g WHERE NOT master_data_matched)""",
    "cur": f"""
        SELECT {listed(CURRENT_COLUMNS)} FROM (
          SELECT *, event_timestamp AS last_reading_at, {TS_NOW} AS gold_updated_at FROM silver
          QUALIFY row_number() OVER (PARTITION BY farm_id, zone_id {_LATEST}) = 1)""",
    "cond": _conditions("cur"),
    "alerts": f"""
        SELECT {listed(ALERT_COLUMNS)} FROM (
          SELECT *, sha256(alert_key || '|' || CAST(detected_at AS VARCHAR)) AS alert_id,
            detected_at AS first_detected_at, detected_at AS last_detected_at, 'ACTIVE' AS alert_status,
            CAST(NULL AS TIMESTAMP) AS resolved_at, {TS_NOW} AS gold_updated_at
          FROM (SELECT *, farm_id || '|' || zone_id || '|' || alert_type AS alert_key FROM cond))""",
    "localised": """
        SELECT *, (event_timestamp AT TIME ZONE 'UTC') AT TIME ZONE timezone AS local_event_timestamp FROM silver""",
    "kpi_base": f"""
        SELECT CAST(local_event_timestamp AS DATE) AS kpi_date, farm_id, zone_id, crop_type, location, state, timezone,
          count(*) AS reading_count,
          CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS anomaly_reading_count,
          CAST(sum(missing_packet_count) AS BIGINT) AS missing_packet_count,
          {", ".join(f"{averaged(v)} AS {k}" for k, v in _AVERAGED.items())},
          {", ".join(f"{averaged(f'CAST({v} AS INTEGER)', 100)} AS {k}" for k, v in KPI_DUTY_CYCLES.items())},
          min(local_event_timestamp) AS first_reading_at, max(local_event_timestamp) AS last_reading_at
        FROM localised GROUP BY ALL""",
    "kpi_rate": f"""
        SELECT *, {rounded('CAST(anomaly_reading_count AS DOUBLE) / reading_count * 100')} AS anomaly_rate_pct,
          {rounded('CAST(missing_packet_count AS DOUBLE) / (reading_count + missing_packet_count) * 100')}
            AS packet_gap_rate_pct
        FROM kpi_base""",
    "kpi": f"""
        SELECT {listed(KPI_COLUMNS)} FROM (
          SELECT *, {rounded('greatest(0.0, 100.0 - anomaly_rate_pct)')} AS health_score, {TS_NOW} AS gold_updated_at
          FROM kpi_rate)""",
}

CHAIN = "WITH " + ",\n".join(f"{name} AS ({text}\n)" for name, text in _CTES.items())


def chained(final: str, **more: str) -> str:
    extra = "".join(f",\n{name} AS ({text}\n)" for name, text in more.items())
    return f"{CHAIN}{extra}\n{final}"


def _increments() -> str:
    """Tables after three slices: gaps as seen when a row was published, the NULL day once per slice that adds to it."""
    ctes = dict(_CTES)
    ctes["t"] = f"""
        SELECT * REPLACE (CASE WHEN eventhub_offset % 401 <> 0 THEN event_time END AS event_time),
          CASE WHEN seq_num % 97 = 0 THEN 2 WHEN eventhub_enqueued_time < TIMESTAMP '2024-01-11' THEN 0
            WHEN eventhub_enqueued_time < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS slice
        FROM ({TELEMETRY_SQL})"""
    ctes["d"] = """
        SELECT * FROM v WHERE is_valid_record
        QUALIFY row_number() OVER (
          PARTITION BY event_id ORDER BY slice, eventhub_enqueued_time, eventhub_partition, eventhub_offset) = 1"""
    ctes["lagged"] = "UNION ALL".join(
        f"""
        SELECT * FROM (SELECT *, event_time AS event_timestamp,
          lag(seq_num) OVER (PARTITION BY farm_id, zone_id, device_id ORDER BY seq_num, event_id) AS previous_seq_num
        FROM d WHERE slice <= {k}) WHERE slice = {k}
        """
        for k in range(3)
    )
    ctes["silver"] = ctes["silver"].replace("SELECT ", "SELECT slice, ", 1)
    ctes["localised"] = """
        SELECT -1 AS step, *, (event_timestamp AT TIME ZONE 'UTC') AT TIME ZONE timezone AS local_event_timestamp
        FROM silver WHERE event_timestamp IS NOT NULL
        UNION ALL
        SELECT step, s.*, CAST(NULL AS TIMESTAMP)
        FROM silver s JOIN (
          SELECT DISTINCT slice AS step, farm_id, zone_id FROM silver WHERE event_timestamp IS NULL) u
        ON s.farm_id = u.farm_id AND s.zone_id = u.zone_id AND s.slice <= u.step
        WHERE event_timestamp IS NULL"""
    ctes["kpi_base"] = ctes["kpi_base"].replace("SELECT ", "SELECT step, ", 1)
    chain = "WITH " + ",\n".join(f"{name} AS ({text}\n)" for name, text in ctes.items())
    tables = {"silver": SILVER_COLUMNS, "cur": CURRENT_COLUMNS, "kpi": KPI_COLUMNS}
    labels = {"silver": "silver", "cur": "current", "kpi": "kpi"}
    selects = [
        f"SELECT '{labels[t]}' AS table_name, "
        + listed(c for c in columns if c not in ("silver_processed_at", "gold_updated_at")) + f" FROM {t}"
        for t, columns in tables.items()
    ]
    return chain + "\n" + " UNION ALL BY NAME ".join(selects)


def _episodes(step: int = 1) -> str:
    """Runs of consecutive batches per alert key, one in ``step`` days: each run is one episode."""
    return chained(
        f"SELECT {listed(ALERT_COLUMNS)} FROM episode",
        span=f"""
          SELECT CAST(min(event_timestamp) AS DATE) AS first_day,
            CAST(CAST(max(event_timestamp) AS DATE) - CAST(min(event_timestamp) AS DATE) AS BIGINT) // {step} + 1 AS batches
          FROM silver""",
        batch="""
          SELECT unnest(range(1, batches + 1)) AS b, first_day FROM span""",
        state=f"""
          SELECT b, CAST(first_day AS TIMESTAMP) + b * INTERVAL '{step}' DAY AS batch_now, silver.*,
            event_timestamp AS last_reading_at
          FROM batch JOIN silver ON event_timestamp < CAST(first_day AS TIMESTAMP) + b * INTERVAL '{step}' DAY
          QUALIFY row_number() OVER (PARTITION BY b, farm_id, zone_id {_LATEST}) = 1""",
        seen=f"""
          SELECT *, farm_id || '|' || zone_id || '|' || alert_type AS alert_key FROM (
            {_conditions('state', 'b, batch_now, ')})""",
        grouped="""
          SELECT *, b - row_number() OVER (PARTITION BY alert_key ORDER BY b) AS island FROM seen""",
        ends="""
          SELECT alert_key, island, min(b) AS first_b, max(b) AS last_b FROM grouped GROUP BY ALL""",
        episode=f"""
          SELECT f.farm_id, f.zone_id, f.crop_type, f.location, f.state, f.alert_type,
            l.current_value, l.min_threshold, l.max_threshold, l.metric_status, l.severity, f.alert_key,
            sha256(f.alert_key || '|' || CAST(f.detected_at AS VARCHAR)) AS alert_id,
            f.detected_at AS first_detected_at, l.detected_at AS last_detected_at,
            CASE WHEN last_b = batches THEN 'ACTIVE' ELSE 'RESOLVED' END AS alert_status,
            CASE WHEN last_b < batches THEN l.batch_now + INTERVAL '{step}' DAY END AS resolved_at,
            CASE WHEN last_b < batches THEN l.batch_now + INTERVAL '{step}' DAY ELSE l.batch_now END AS gold_updated_at
          FROM ends JOIN span ON true
          JOIN grouped f ON f.alert_key = ends.alert_key AND f.b = first_b
          JOIN grouped l ON l.alert_key = ends.alert_key AND l.b = last_b""",
    )


_DEVICE = "farm_id, zone_id, device_id"
_STATUS_LIST = ", ".join(f"('{s}', {s})" for s in _STATUS_NAMES)
_LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, " \
        "l_returnflag, l_linestatus, l_shipdate"
_CUT = "TIMESTAMP '1996-01-01'"

_REPORT = """
SELECT check_name, failures, failures = 0 AS passed FROM (
  SELECT * FROM found UNION ALL SELECT 'OVERALL', CAST(sum(failures) AS BIGINT) FROM found)"""

ORACLES = {
    # sources and sinks
    "reference_csv": chained(f"SELECT {listed(REFERENCE_SCHEMA.names)} FROM m"),
    "table_scan": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "overwrite_table": chained(f"SELECT {listed(REFERENCE_SCHEMA.names)} FROM m"),
    "create_if_absent": chained(f"SELECT {listed(REFERENCE_SCHEMA.names)} FROM m"),
    "publish_snapshot": chained(
        f"SELECT {listed(REFERENCE_SCHEMA.names)} FROM m"
    ),
    # parsing and projections
    "bronze_rows": chained(
        f"SELECT {listed(EVENT_SCHEMA.names)}, eventhub_partition, eventhub_offset, eventhub_enqueued_time, "
        f"{TS_NOW} AS bronze_ingestion_time FROM t"
    ),
    "parse_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "event_time": chained("SELECT event_id, eventhub_offset, event_time AS event_timestamp FROM t"),
    # validation
    "validate_records": chained(
        "SELECT event_id, eventhub_offset, required_fields_valid, ph_valid, ec_valid, water_temp_valid, "
        "water_level_valid, do_valid, humidity_valid, is_valid_record, validation_error FROM v"
    ),
    "validate_strict": chained(
        "SELECT CASE WHEN validation_error IS NOT NULL THEN validation_error "
        "WHEN humidity_pct IS NULL THEN 'INVALID_HUMIDITY' END AS validation_error, count(*) AS count "
        "FROM v GROUP BY 1"
    ),
    "split_valid": chained(
        "SELECT CASE WHEN is_valid_record THEN 'valid' WHEN NOT is_valid_record THEN 'invalid' ELSE 'undecided' END "
        "AS half, count(*) AS count FROM v GROUP BY 1"
    ),
    "invalid_listing": chained(
        "SELECT event_id, farm_id, zone_id, device_id, validation_error, raw_payload FROM v WHERE NOT is_valid_record"
    ),
    # keys
    "dedup_first_events": chained("SELECT event_id, eventhub_partition, eventhub_offset, ph FROM d"),
    "dedup_first_lineitem": f"""
        SELECT {_LINE} FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey
          ORDER BY l_shipdate, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
          l_linestatus) = 1""",
    "duplicate_events": chained("SELECT event_id, count(*) AS count FROM v WHERE is_valid_record GROUP BY 1 HAVING count(*) > 1"),
    "duplicate_keys_lineitem":
        "SELECT l_orderkey, l_partkey, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "latest_per_key_orders": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    # sequence
    "sequence": chained(
        f"SELECT event_id, {_DEVICE}, seq_num, previous_seq_num, missing_packet_count, has_sequence_gap FROM s"
    ),
    "sequence_orders": """
        SELECT o_custkey, o_orderkey, previous_seq_num,
          CASE WHEN o_orderkey > previous_seq_num + 1 THEN o_orderkey - previous_seq_num - 1 ELSE 0 END
            AS missing_packet_count,
          coalesce(o_orderkey > previous_seq_num + 1, false) AS has_sequence_gap
        FROM (SELECT *, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS previous_seq_num
          FROM orders)""",
    "sequence_lineitem": """
        SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_shipdate,
          previous_seq_num,
          CASE WHEN l_orderkey > previous_seq_num + 1 THEN l_orderkey - previous_seq_num - 1 ELSE 0 END
            AS missing_packet_count,
          coalesce(l_orderkey > previous_seq_num + 1, false) AS has_sequence_gap
        FROM (SELECT *, lag(l_orderkey) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber,
          l_partkey, l_extendedprice, l_quantity, l_shipdate)
          AS previous_seq_num FROM lineitem)""",
    "sequence_totals": chained(
        "SELECT count(*) FILTER (WHERE has_sequence_gap) AS gap_count, "
        "CAST(sum(missing_packet_count) AS BIGINT) AS total_missing_packets FROM s"
    ),
    "gap_listing": chained(
        f"SELECT {_DEVICE}, previous_seq_num, seq_num, missing_packet_count, event_timestamp FROM s "
        "WHERE has_sequence_gap ORDER BY farm_id, zone_id, device_id, seq_num"
    ),
    # joins
    "enrich_telemetry": chained(f"SELECT event_id, {listed(REFERENCE_SCHEMA.names)}, master_data_matched FROM e"),
    "enrich_lineitem": f"""
        SELECT {_LINE}, p_name, p_brand, p_type, p_size, p_retailprice, p_type IS NOT NULL AS master_data_matched
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "enrich_orders": """
        SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_mktsegment, c_mktsegment IS NOT NULL
          AS master_data_matched FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "unmatched": chained(
        "SELECT event_id, farm_id, zone_id, device_id, event_timestamp FROM e WHERE NOT master_data_matched"
    ),
    "freshness": chained(
        """SELECT cur.farm_id, cur.zone_id, last_reading_at, silver_latest_timestamp,
             last_reading_at = silver_latest_timestamp AS timestamp_match
           FROM cur LEFT JOIN (SELECT farm_id, zone_id, max(event_timestamp) AS silver_latest_timestamp
             FROM silver GROUP BY ALL) x ON cur.farm_id = x.farm_id AND cur.zone_id = x.zone_id"""
    ),
    # grading
    "graded": chained(
        f"SELECT event_id, {', '.join(_STATUS_NAMES)}, anomaly_count, is_anomaly, severity, overall_status, "
        "master_data_matched FROM g"
    ),
    "silver": chained(f"SELECT {listed(SILVER_COLUMNS)} FROM silver"),
    "quarantine": chained(f"SELECT {listed(QUARANTINE_COLUMNS)} FROM invalid"),
    "ph_abnormal": chained("SELECT event_id, ph, ph_status FROM g WHERE ph_status <> 'NORMAL'"),
    "anomalies": chained(f"SELECT {listed(SILVER_COLUMNS)} FROM silver WHERE is_anomaly"),
    # gold
    "current_state": chained(f"SELECT {listed(CURRENT_COLUMNS)} FROM cur"),
    "current_listing": chained(f"SELECT {listed(CURRENT_COLUMNS)} FROM cur"),
    "anomaly_states": chained(f"SELECT {listed(CURRENT_COLUMNS)} FROM cur WHERE is_anomaly"),
    "alert_conditions": chained("SELECT * FROM cond ORDER BY farm_id, zone_id, alert_type"),
    "alert_identity": chained("SELECT * FROM alerts"),
    "active_alerts": chained("SELECT * FROM alerts WHERE alert_status = 'ACTIVE'"),
    "alert_merges": _episodes(step=10),
    "alert_episodes": _episodes(),
    "kpi": chained("SELECT * FROM kpi"),
    "kpi_listing": chained("SELECT * FROM kpi"),
    "local_days": chained(
        "SELECT event_id, local_event_timestamp, CAST(local_event_timestamp AS DATE) AS kpi_date FROM localised"
    ),
    # merges
    "merge_insert_only": f"""
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderdate < {_CUT}
        UNION ALL
        SELECT o_orderkey, o_custkey, o_totalprice + 1, o_orderdate FROM orders WHERE o_orderdate >= {_CUT}""",
    "merge_insert_composite": """
        SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag <> 'N'
        UNION ALL
        SELECT l_orderkey, l_linenumber, l_quantity + 100 FROM lineitem s WHERE NOT EXISTS (
          SELECT 1 FROM lineitem t WHERE t.l_returnflag <> 'N' AND t.l_orderkey = s.l_orderkey
            AND t.l_linenumber = s.l_linenumber)""",
    "merge_upsert": """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-01'
        UNION ALL
        SELECT o_orderkey, o_custkey, o_totalprice + 1, o_orderdate FROM orders
        WHERE o_orderdate >= TIMESTAMP '1995-01-01'""",
    # reports
    "row_counts": chained(
        "SELECT 'bronze_iot_telemetry' AS table_name, count(*) AS row_count FROM t "
        "UNION ALL SELECT 'bronze_farm_crop_master', count(*) FROM m "
        "UNION ALL SELECT 'silver_iot_enriched', count(*) FROM silver "
        "UNION ALL SELECT 'silver_invalid_records', count(*) FROM invalid "
        "UNION ALL SELECT 'gold_current_status', count(*) FROM cur "
        "UNION ALL SELECT 'gold_alerts', count(*) FROM alerts "
        "UNION ALL SELECT 'gold_daily_kpi', count(*) FROM kpi"
    ),
    "frequency_partition": chained("SELECT eventhub_partition, count(*) AS count FROM t GROUP BY 1"),
    "frequency_crop": chained("SELECT crop_type, count(*) AS count FROM e GROUP BY 1"),
    "frequency_overall_status": chained("SELECT overall_status, count(*) AS count FROM g GROUP BY 1"),
    "frequency_severity": chained("SELECT severity, count(*) AS count FROM g GROUP BY 1"),
    "frequency_error": chained("SELECT validation_error, count(*) AS count FROM invalid GROUP BY 1"),
    "frequency_alerts": chained("SELECT alert_status, severity, count(*) AS count FROM alerts GROUP BY ALL"),
    "frequency_orders": "SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders GROUP BY ALL",
    "frequency_lineitem": "SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY ALL",
    "status_frequency": chained(
        f"SELECT metric, status, count(*) AS count FROM g, LATERAL (VALUES {_STATUS_LIST}) x(metric, status) GROUP BY ALL"
    ),
    "extrema_health": chained(
        "SELECT min(health_score) AS min_health_score, max(health_score) AS max_health_score FROM kpi"
    ),
    "extrema_orders": "SELECT min(o_totalprice) AS min_o_totalprice, max(o_totalprice) AS max_o_totalprice FROM orders",
    "latest_ts_per_key": chained(
        "SELECT farm_id, zone_id, max(event_timestamp) AS silver_latest_timestamp FROM silver GROUP BY ALL"
    ),
    "newest_silver": chained(
        f"SELECT event_id, {_DEVICE}, crop_type, event_timestamp, ph, severity, overall_status FROM silver "
        "ORDER BY event_timestamp DESC, event_id LIMIT 50"
    ),
    # audits
    "null_counts": chained(
        "SELECT column_name, count(*) FILTER (WHERE missing) AS null_count, "
        "count(*) FILTER (WHERE missing) = 0 AS passed FROM silver, LATERAL (VALUES "
        + ", ".join(f"('{c}', {c} IS NULL)" for c in (
            "event_id", "farm_id", "zone_id", "device_id", "event_timestamp", "crop_type", "ph", "ec_ms_cm"))
        + ") x(column_name, missing) GROUP BY 1"
    ),
    "null_rows_bronze": chained(
        "SELECT event_id, eventhub_offset, ph, humidity_pct FROM t WHERE ph IS NULL OR humidity_pct IS NULL"
    ),
    "out_of_range": chained(
        "SELECT kpi_date, farm_id, zone_id, health_score, anomaly_rate_pct, "
        "health_score IS NULL OR health_score < 0 OR health_score > 100 AS bad_health_score, "
        "anomaly_rate_pct < 0 OR anomaly_rate_pct > 100 AS bad_anomaly_rate FROM kpi"
    ),
    "validation_report": chained(
        _REPORT,
        found="""
          SELECT 'Silver duplicate event IDs' AS check_name, count(*) AS failures FROM (
            SELECT event_id FROM silver GROUP BY 1 HAVING count(*) > 1)
          UNION ALL SELECT 'Gold current duplicate keys', count(*) FROM (
            SELECT farm_id, zone_id FROM cur GROUP BY ALL HAVING count(*) > 1)
          UNION ALL SELECT 'Gold active alert duplicates', count(*) FROM (
            SELECT alert_key FROM alerts WHERE alert_status = 'ACTIVE' GROUP BY 1 HAVING count(*) > 1)
          UNION ALL SELECT 'Gold daily duplicate keys', count(*) FROM (
            SELECT kpi_date, farm_id, zone_id FROM kpi GROUP BY ALL HAVING count(*) > 1)
          UNION ALL SELECT 'Invalid health scores', count(*) FROM kpi
            WHERE health_score IS NULL OR health_score < 0 OR health_score > 100
          UNION ALL SELECT 'Invalid anomaly rates', count(*) FROM kpi
            WHERE anomaly_rate_pct < 0 OR anomaly_rate_pct > 100
          UNION ALL SELECT 'Gold freshness', count(*) FROM cur JOIN (
            SELECT farm_id, zone_id, max(event_timestamp) AS newest FROM silver GROUP BY ALL) x
            ON cur.farm_id = x.farm_id AND cur.zone_id = x.zone_id AND last_reading_at <> newest""",
    ),
    "validation_report_faults": chained(
        _REPORT,
        found="""
          SELECT 'Silver duplicate event IDs' AS check_name, count(*) AS failures FROM silver WHERE seq_num % 50 = 0
          UNION ALL SELECT 'Gold current duplicate keys', count(*) FROM cur WHERE farm_id IN ('FARM-1', 'FARM-2')
          UNION ALL SELECT 'Gold active alert duplicates', count(*) FROM alerts WHERE severity = 'LOW'
          UNION ALL SELECT 'Gold daily duplicate keys', count(*) FROM kpi WHERE farm_id = 'FARM-3'
          UNION ALL SELECT 'Invalid health scores',
            coalesce(CAST(sum(1 + CAST(farm_id = 'FARM-3' AS INTEGER)) AS BIGINT), 0) FROM kpi WHERE reading_count % 3 <> 1
          UNION ALL SELECT 'Invalid anomaly rates',
            coalesce(CAST(sum(1 + CAST(farm_id = 'FARM-3' AS INTEGER)) AS BIGINT), 0) FROM kpi WHERE reading_count % 5 = 0
          UNION ALL SELECT 'Gold freshness',
            coalesce(CAST(sum(1 + CAST(farm_id IN ('FARM-1', 'FARM-2') AS INTEGER)) AS BIGINT), 0) FROM cur WHERE zone_id = 'BAY-1'""",
    ),
    "null_counts_faults": chained(
        "SELECT column_name, null_count, null_count = 0 AS passed FROM ("
        "SELECT 'crop_type' AS column_name, count(*) AS null_count FROM silver WHERE seq_num % 7 = 0 "
        "UNION ALL SELECT 'ph', count(*) FROM silver WHERE seq_num % 11 = 0 "
        "UNION ALL SELECT unnest(['event_id', 'farm_id', 'zone_id', 'device_id', 'event_timestamp', 'ec_ms_cm']), 0)"
    ),
    "doubled_dimension": "SELECT count(*) AS keys, true AS refused FROM part WHERE p_size = 1",
    "tables_exist": """
        SELECT unnest(['master', 'bronze', 'silver', 'invalid', 'current', 'alerts', 'kpi']) AS table_name,
          false AS before, true AS after""",
    "sample_silver": "SELECT CAST(20 AS BIGINT) AS sampled, CAST(20 AS BIGINT) AS found",
    "stream_backlog": chained("SELECT count(*) AS rows_read, true AS more_than_kept FROM t"),
    "increments_over_tables": _increments(),
    # streaming
    "stream_ingest": chained(
        f"SELECT {listed(EVENT_SCHEMA.names)}, eventhub_partition, eventhub_offset, eventhub_enqueued_time, "
        f"{TS_NOW} AS bronze_ingestion_time FROM t"
    ),
    "stream_restart": chained(
        """SELECT 'first' AS run, count(*) FILTER (WHERE eventhub_enqueued_time < TIMESTAMP '2024-01-16') AS rows_read,
             count(*) FILTER (WHERE eventhub_enqueued_time < TIMESTAMP '2024-01-16') AS rows_in_table FROM t
           UNION ALL
           SELECT 'second', count(*) FILTER (WHERE eventhub_enqueued_time >= TIMESTAMP '2024-01-16'), count(*) FROM t
           UNION ALL
           SELECT 'third', 0, count(*) FROM t"""
    ),
    "silver_in_slices": chained(f"SELECT {listed(SILVER_COLUMNS)} FROM silver"),
    "stages_over_tables": chained(
        """SELECT 'silver_iot_enriched' AS table_name, count(*) AS row_count FROM silver
           UNION ALL SELECT 'silver_invalid_records', count(*) FROM invalid
           UNION ALL SELECT 'gold_current_status', count(*) FROM cur
           UNION ALL SELECT 'gold_alerts', count(*) FROM alerts
           UNION ALL SELECT 'gold_daily_kpi', count(*) FROM kpi"""
    ),
}
