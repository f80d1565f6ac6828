"""Schemas at the edges and the column order of every published table."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
BOOLEAN, BINARY, INSTANT = T.BooleanType(), T.BinaryType(), T.TimestampType()


def _schema(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Table layouts. Names, types and order are the public contract of each table.

REFERENCE_SCHEMA = _schema({
    "farm_id": STRING, "zone_id": STRING,
    "location": STRING, "state": STRING, "timezone": STRING, "crop_type": STRING,
    "ph_min": DOUBLE, "ph_max": DOUBLE,
    "ec_min_ms_cm": DOUBLE, "ec_max_ms_cm": DOUBLE,
    "water_temp_min_c": DOUBLE, "water_temp_max_c": DOUBLE,
    "humidity_min_pct": DOUBLE, "humidity_max_pct": DOUBLE,
    "do_min_mg_l": DOUBLE,
    "water_level_min_cm": DOUBLE, "water_level_max_cm": DOUBLE,
    "active_flag": BOOLEAN,
})

EVENT_SCHEMA = _schema({
    "event_id": STRING, "event_type": STRING, "schema_version": STRING,
    "farm_id": STRING, "zone_id": STRING, "device_id": STRING, "seq_num": LONG, "timestamp": STRING,
    "ph": DOUBLE, "ec_ms_cm": DOUBLE, "tds_ppm": DOUBLE,
    "water_level_cm": DOUBLE, "water_temp_c": DOUBLE, "dissolved_oxygen_mg_l": DOUBLE,
    "ambient_temp_c": DOUBLE, "humidity_pct": DOUBLE, "co2_ppm": DOUBLE,
    "battery_voltage": DOUBLE,
    "device_status": STRING, "controller_mode": STRING,
    "is_ph_reducer_on": BOOLEAN, "is_ph_increaser_on": BOOLEAN, "is_water_refill_on": BOOLEAN,
    "is_nutrient_pump_on": BOOLEAN, "is_humidifier_on": BOOLEAN, "is_exhaust_fan_on": BOOLEAN,
    "is_aerator_on": BOOLEAN,
})

# What an event source delivers; the names are those of Spark's Kafka source.
ENVELOPE_SCHEMA = _schema({"value": BINARY, "partition": INT, "offset": LONG, "timestamp": INSTANT})

LINEAGE_COLUMNS = ("eventhub_partition", "eventhub_offset", "eventhub_enqueued_time")

BRONZE_SCHEMA = T.StructType([
    *EVENT_SCHEMA.fields,
    *_schema({
        "eventhub_partition": INT, "eventhub_offset": LONG, "eventhub_enqueued_time": INSTANT,
        "raw_payload": STRING, "bronze_ingestion_time": INSTANT,
    }).fields,
])

THRESHOLD_COLUMNS = (
    "ph_min", "ph_max", "ec_min_ms_cm", "ec_max_ms_cm", "water_temp_min_c", "water_temp_max_c",
    "humidity_min_pct", "humidity_max_pct", "do_min_mg_l", "water_level_min_cm", "water_level_max_cm",
)

ACTUATOR_COLUMNS = (
    "is_ph_reducer_on", "is_ph_increaser_on", "is_water_refill_on", "is_nutrient_pump_on",
    "is_humidifier_on", "is_exhaust_fan_on", "is_aerator_on",
)

SILVER_COLUMNS = (
    "event_id", "event_type", "schema_version",
    "farm_id", "zone_id", "device_id", "seq_num",
    "event_timestamp",
    "location", "state", "timezone", "crop_type",
    "ph", "ec_ms_cm", "tds_ppm", "water_level_cm", "water_temp_c", "dissolved_oxygen_mg_l",
    "ambient_temp_c", "humidity_pct", "co2_ppm", "battery_voltage",
    "device_status", "controller_mode",
    *ACTUATOR_COLUMNS,
    *THRESHOLD_COLUMNS,
    "previous_seq_num", "missing_packet_count", "has_sequence_gap",
    "ph_status", "ec_status", "water_temp_status", "water_level_status", "humidity_status", "do_status",
    "is_anomaly", "anomaly_count", "severity", "overall_status",
    *LINEAGE_COLUMNS, "bronze_ingestion_time", "silver_processed_at",
)

QUARANTINE_COLUMNS = (
    "event_id", "farm_id", "zone_id", "device_id", "seq_num", "timestamp",
    "ph", "ec_ms_cm", "water_level_cm", "water_temp_c", "dissolved_oxygen_mg_l", "humidity_pct",
    *LINEAGE_COLUMNS, "bronze_ingestion_time",
    "raw_payload", "validation_error", "rejected_at", "rejection_layer",
)

# event_timestamp is published as last_reading_at, gold_updated_at is stamped.
CURRENT_COLUMNS = (
    "farm_id", "zone_id", "crop_type", "location", "state",
    "device_id",
    "ph", "ec_ms_cm", "tds_ppm", "water_temp_c", "water_level_cm", "dissolved_oxygen_mg_l",
    "ambient_temp_c", "humidity_pct", "co2_ppm",
    *THRESHOLD_COLUMNS,
    "ph_status", "ec_status", "water_temp_status", "water_level_status", "humidity_status", "do_status",
    "is_anomaly", "anomaly_count", "severity", "overall_status",
    "controller_mode",
    *ACTUATOR_COLUMNS,
    "battery_voltage", "has_sequence_gap", "missing_packet_count",
    "last_reading_at", "gold_updated_at",
)

ALERT_DIMENSIONS = ("farm_id", "zone_id", "crop_type", "location", "state")

ALERT_COLUMNS = (
    *ALERT_DIMENSIONS,
    "alert_type", "current_value", "min_threshold", "max_threshold", "metric_status", "severity",
    "alert_key", "alert_id", "first_detected_at", "last_detected_at",
    "alert_status", "resolved_at", "gold_updated_at",
)

KPI_GROUP_COLUMNS = ("kpi_date", "farm_id", "zone_id", "crop_type", "location", "state", "timezone")

# published name -> averaged reading
KPI_AVERAGES = {
    "avg_ph": "ph",
    "avg_ec_ms_cm": "ec_ms_cm",
    "avg_water_temp_c": "water_temp_c",
    "avg_water_level_cm": "water_level_cm",
    "avg_do_mg_l": "dissolved_oxygen_mg_l",
    "avg_ambient_temp_c": "ambient_temp_c",
    "avg_humidity_pct": "humidity_pct",
    "avg_co2_ppm": "co2_ppm",
}

# published name -> actuator flag
KPI_DUTY_CYCLES = {
    "ph_reducer_runtime_pct": "is_ph_reducer_on",
    "ph_increaser_runtime_pct": "is_ph_increaser_on",
    "water_refill_runtime_pct": "is_water_refill_on",
    "nutrient_pump_runtime_pct": "is_nutrient_pump_on",
    "humidifier_runtime_pct": "is_humidifier_on",
    "exhaust_fan_runtime_pct": "is_exhaust_fan_on",
    "aerator_runtime_pct": "is_aerator_on",
}

KPI_COLUMNS = (
    *KPI_GROUP_COLUMNS,
    "reading_count", "anomaly_reading_count", "missing_packet_count",
    *KPI_AVERAGES, *KPI_DUTY_CYCLES,
    "first_reading_at", "last_reading_at",
    "anomaly_rate_pct", "health_score", "packet_gap_rate_pct",
    "gold_updated_at",
)

# Columns whose NULLs the validation reports in the silver table.
SILVER_NOT_NULL = (
    "event_id", "farm_id", "zone_id", "device_id", "event_timestamp", "crop_type", "ph", "ec_ms_cm",
)
