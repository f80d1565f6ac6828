"""Hand-made telemetry for the tests."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.sources.schemas import BRONZE_SCHEMA, EVENT_SCHEMA, REFERENCE_SCHEMA

START = datetime(2024, 3, 1)

GOOD = {
    "event_type": "sensor_reading", "schema_version": "5.0",
    "farm_id": "F1", "zone_id": "Z1", "device_id": "D1",
    "ph": 6.5, "ec_ms_cm": 1.5, "tds_ppm": 700.0, "water_level_cm": 19.0, "water_temp_c": 21.0,
    "dissolved_oxygen_mg_l": 7.5, "ambient_temp_c": 22.0, "humidity_pct": 65.0, "co2_ppm": 420.0,
    "battery_voltage": 3.9, "device_status": "ONLINE", "controller_mode": "AUTO",
    "is_ph_reducer_on": False, "is_ph_increaser_on": False, "is_water_refill_on": True,
    "is_nutrient_pump_on": False, "is_humidifier_on": False, "is_exhaust_fan_on": True, "is_aerator_on": True,
}

ZONE = {
    "farm_id": "F1", "zone_id": "Z1", "location": "Northport", "state": "Lakeland", "timezone": "America/Winnipeg",
    "crop_type": "Kale", "ph_min": 5.9, "ph_max": 6.9, "ec_min_ms_cm": 1.3, "ec_max_ms_cm": 1.9,
    "water_temp_min_c": 17.5, "water_temp_max_c": 23.5, "humidity_min_pct": 56.0, "humidity_max_pct": 74.0,
    "do_min_mg_l": 5.8, "water_level_min_cm": 16.0, "water_level_max_cm": 22.5, "active_flag": True,
}


def record(n: int, **changes) -> dict:
    """Raw row number n: event En, sequence n, n minutes after the start; changes on top."""
    at = START + timedelta(minutes=n)
    row = {**GOOD, "event_id": f"E{n}", "seq_num": n, "timestamp": at.isoformat() + "+00:00"}
    lineage = {"eventhub_partition": 0, "eventhub_offset": n, "eventhub_enqueued_time": at,
               "bronze_ingestion_time": at + timedelta(minutes=1)}
    row.update({k: v for k, v in changes.items() if k in EVENT_SCHEMA.names})
    lineage.update({k: v for k, v in changes.items() if k in lineage})
    return {**row, **lineage, "raw_payload": json.dumps(row)}


def bronze(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(c) for c in BRONZE_SCHEMA.names) for r in rows], BRONZE_SCHEMA)


def master(spark: SparkSession, *zones: dict) -> DataFrame:
    rows = [{**ZONE, **z} for z in (zones or ({},))]
    return spark.createDataFrame([tuple(r[c] for c in REFERENCE_SCHEMA.names) for r in rows], REFERENCE_SCHEMA)


def at(text: str):
    return F.lit(text).cast("timestamp")
