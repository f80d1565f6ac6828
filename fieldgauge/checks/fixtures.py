"""Telemetry and reference data derived from the driver's ``events`` table.

Every event becomes a telemetry record, and some records are delivered twice. The column texts are
valid in Spark SQL and in DuckDB, so both sides start from the same rows; numbers are built from
integers and divided once, so both get the same bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.sources.schemas import BRONZE_SCHEMA, EVENT_SCHEMA, REFERENCE_SCHEMA

NOW = "2024-02-01 00:00:00"

# Crops of the fixture, with their bounds in tenths: pH, conductivity, water temperature, humidity.
CROPS = (
    ("Kale", (59, 69), (13, 19), (175, 235), (560, 740)),
    ("Mint", (56, 62), (11, 17), (185, 245), (510, 720)),
    ("Chard", (61, 71), (17, 24), (165, 225), (540, 760)),
    ("Celery", (57, 63), (19, 23), (180, 250), (570, 730)),
    ("Okra", (51, 57), (16, 21), (190, 255), (590, 810)),
    ("Fennel", (60, 66), (21, 39), (170, 240), (530, 770)),
)


def _by_crop(values) -> str:
    """One value per crop, by its number ``ci``."""
    cases = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE ci {cases} END"


def _middle(bounds: int) -> str:
    """Hundredths half-way between a crop's bounds."""
    return _by_crop(5 * (crop[bounds][0] + crop[bounds][1]) for crop in CROPS)


def _spread(factor: int, modulus: int, up: int, down: int) -> str:
    return f"CASE n * {factor} % {modulus} WHEN 0 THEN {up} WHEN 1 THEN {down} ELSE 0 END"


def _scaled(number: str, divisor: int) -> str:
    return f"CAST({number} AS DOUBLE) / {divisor}"


# Hundredths that depend on the delivery. Inputs: n (event number), ci (crop), copy (0 or 1).
DELIVERED = {
    "ph_100": f"CASE WHEN copy = 1 THEN 500 WHEN n % 223 = 0 THEN NULL WHEN n % 211 = 0 THEN 1520 "
              f"ELSE {_middle(1)} + {_spread(7919, 20, 100, -100)} END",
    "ec_100": f"CASE WHEN n % 227 = 0 THEN -100 ELSE {_middle(2)} + {_spread(7907, 21, 120, -110)} END",
}

# Inputs: n, fi, zi, ci (event, farm, zone and crop numbers), copy, ph_100, ec_100, body (JSON text).
TELEMETRY = {
    "event_id": "CAST(n AS VARCHAR(20))",
    "event_type": "'sensor_reading'",
    "schema_version": "'5.0'",
    "farm_id": "concat('FARM-', fi)",
    "zone_id": "concat('BAY-', zi)",
    "device_id": "concat('NODE-', n % 5)",
    "seq_num": "n",
    "ph": _scaled("ph_100", 100),
    "ec_ms_cm": _scaled("ec_100", 100),
    "tds_ppm": _scaled("(n * 31 % 10000)", 10),
    "water_level_cm": f"CASE WHEN n % 233 = 0 THEN {_scaled('120', 1)} "
                      f"ELSE {_scaled(f'(190 + {_spread(7883, 23, 50, -60)})', 10)} END",
    "water_temp_c": f"CASE WHEN n % 229 = 0 THEN {_scaled('55', 1)} "
                    f"ELSE {_scaled(f'(210 + {_spread(7901, 22, 70, -50)})', 10)} END",
    "dissolved_oxygen_mg_l": f"CASE WHEN n % 239 = 0 THEN {_scaled('25', 1)} "
                             f"ELSE {_scaled(f'(75 - {_spread(7879, 24, 30, 0)})', 10)} END",
    "ambient_temp_c": _scaled("(200 + n * 37 % 100)", 10),
    "humidity_pct": f"CASE WHEN n % 241 = 0 THEN NULL WHEN n % 251 = 0 THEN {_scaled('101', 1)} "
                    f"ELSE {_scaled(f'(650 + {_spread(7877, 25, 200, -200)})', 10)} END",
    "co2_ppm": _scaled("(4000 + n * 41 % 1000)", 10),
    "battery_voltage": _scaled("(3200 + n * 43 % 1000)", 1000),
    "device_status": "'ONLINE'",
    "controller_mode": "'AUTO'",
    "is_aerator_on": "n % 3 = 0",
    "is_ph_reducer_on": "n % 4 = 0",
    "is_ph_increaser_on": "n % 5 = 0",
    "is_water_refill_on": "n % 6 = 0",
    "is_nutrient_pump_on": "n % 7 = 0",
    "is_humidifier_on": "n % 8 = 0",
    "is_exhaust_fan_on": "n % 9 = 0",
    "eventhub_partition": "CAST(n % 4 AS INT)",
    "eventhub_offset": "2 * n + copy",
    "raw_payload": "body",
}


def _bound(bounds: int, side: int) -> str:
    return _scaled(f"({_by_crop(crop[bounds][side] for crop in CROPS)})", 10)


_NAMES = _by_crop(f"'{crop[0]}'" for crop in CROPS)

# Inputs: fi, zi, ci.
REFERENCE = {
    "farm_id": "concat('FARM-', fi)",
    "zone_id": "concat('BAY-', zi)",
    "location": "concat('CITY-', fi)",
    "state": "concat('STATE-', fi % 5)",
    "timezone": "CASE fi % 4 WHEN 0 THEN 'America/Chicago' WHEN 1 THEN 'America/Los_Angeles' "
                "WHEN 2 THEN 'America/New_York' ELSE 'America/Phoenix' END",
    "crop_type": _NAMES,
    "ph_min": _bound(1, 0),
    "ph_max": f"CASE WHEN fi = 12 THEN NULL ELSE {_bound(1, 1)} END",
    "ec_min_ms_cm": _bound(2, 0),
    "ec_max_ms_cm": _bound(2, 1),
    "water_temp_min_c": _bound(3, 0),
    "water_temp_max_c": _bound(3, 1),
    "humidity_min_pct": _bound(4, 0),
    "humidity_max_pct": _bound(4, 1),
    "do_min_mg_l": f"CASE WHEN fi = 13 THEN NULL ELSE {_scaled('58', 10)} END",
    "water_level_min_cm": _scaled("160", 10),
    "water_level_max_cm": _scaled("225", 10),
    "active_flag": "fi % 7 <> 3",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table; its zoneless timestamps are read as UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw telemetry in the bronze layout, from one scan of ``events``."""
    events = load(spark, sf_dir, "events").selectExpr(
        "event_id AS n", "ts", "props AS body", "user_id % 15 AS fi", "user_id % 2 AS zi"
    )
    fields = ", ".join(f"'{name}', {text}" for name, text in DELIVERED.items())
    copies = "sequence(0, CASE WHEN n % 20 = 0 THEN 1 ELSE 0 END)"
    delivered = events.selectExpr("*", "(2 * fi + zi) % 6 AS ci").selectExpr(
        "*", f"inline(transform({copies}, copy -> named_struct('copy', copy, {fields})))"
    )
    times = {
        "timestamp": "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00')",
        "eventhub_enqueued_time": "ts + copy * INTERVAL '1' MINUTE",
        "bronze_ingestion_time": "ts + INTERVAL '5' MINUTE",
    }
    columns = {**TELEMETRY, **times}
    named = delivered.selectExpr(*[f"{columns[c]} AS {c}" for c in BRONZE_SCHEMA.names])
    return named.withColumns({c: F.col(c).cast(BRONZE_SCHEMA[c].dataType) for c in ("event_id", "eventhub_offset")})


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference rows of every zone seen in ``events`` but one."""
    zones = load(spark, sf_dir, "events").selectExpr("user_id % 15 AS fi", "user_id % 2 AS zi").distinct()
    numbered = zones.filter("NOT (fi = 14 AND zi = 0)").selectExpr("*", "(2 * fi + zi) % 6 AS ci")
    return numbered.selectExpr(*[f"{REFERENCE[c]} AS {c}" for c in REFERENCE_SCHEMA.names])


def envelope(telemetry_rows: DataFrame) -> DataFrame:
    """The same records as a source delivers them: JSON body, position and time."""
    body = F.to_json(F.struct(*EVENT_SCHEMA.names))
    return telemetry_rows.select(
        F.encode(body, "UTF-8").alias("value"),
        F.col("eventhub_partition").alias("partition"),
        F.col("eventhub_offset").alias("offset"),
        F.col("eventhub_enqueued_time").alias("timestamp"),
    )


#: Row groups of delivered files: a reader can share one file among its tasks only by whole groups.
DELIVERED_GROUP_BYTES = 256 * 2**10


def deliver(rows: DataFrame, path: str) -> None:
    """Add rows to a source folder, in files that many tasks can read."""
    rows.write.mode("append").option("parquet.block.size", DELIVERED_GROUP_BYTES).parquet(path)


def _sql_columns(columns: dict[str, str]) -> str:
    return ",\n  ".join(f"{text} AS {name}" for name, text in columns.items())


TELEMETRY_SQL = f"""
SELECT
  {_sql_columns(TELEMETRY)},
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
  ts AS event_time,
  ts + copy * INTERVAL '1' MINUTE AS eventhub_enqueued_time,
  ts + INTERVAL '5' MINUTE AS bronze_ingestion_time
FROM (
 SELECT *, {_sql_columns(DELIVERED)} FROM (
  SELECT event_id AS n, ts, props AS body, user_id % 15 AS fi, user_id % 2 AS zi,
    (2 * (user_id % 15) + user_id % 2) % 6 AS ci,
    unnest(CASE WHEN event_id % 20 = 0 THEN [0, 1] ELSE [0] END) AS copy
  FROM events
 )
)"""

REFERENCE_SQL = f"""
SELECT
  {_sql_columns(REFERENCE)}
FROM (
  SELECT DISTINCT user_id % 15 AS fi, user_id % 2 AS zi, (2 * (user_id % 15) + user_id % 2) % 6 AS ci FROM events
)
WHERE NOT (fi = 14 AND zi = 0)"""
