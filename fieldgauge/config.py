"""Metrics, limits and keys that parameterise the operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Metric:
    """A graded reading: its value column and the threshold columns it is compared with."""

    name: str
    value: str
    lo: str
    hi: str | None
    alert_prefix: str

    @property
    def status(self) -> str:
        return f"{self.name}_status"


@dataclass(frozen=True)
class Limit:
    """Physical bounds (inclusive) outside which a reading is rejected."""

    name: str
    value: str
    lo: float
    hi: float
    error: str

    @property
    def flag(self) -> str:
        return f"{self.name}_valid"


# Graded metrics, in the order their status columns are published.
METRICS = (
    Metric("ph", "ph", "ph_min", "ph_max", "PH"),
    Metric("ec", "ec_ms_cm", "ec_min_ms_cm", "ec_max_ms_cm", "EC"),
    Metric("water_temp", "water_temp_c", "water_temp_min_c", "water_temp_max_c", "WATER_TEMP"),
    Metric("water_level", "water_level_cm", "water_level_min_cm", "water_level_max_cm", "WATER_LEVEL"),
    Metric("humidity", "humidity_pct", "humidity_min_pct", "humidity_max_pct", "HUMIDITY"),
    Metric("do", "dissolved_oxygen_mg_l", "do_min_mg_l", None, "DISSOLVED_OXYGEN"),
)

# Physical limits, in the order in which the first broken one names the error.
LIMITS = (
    Limit("ph", "ph", 0.0, 14.0, "INVALID_PH"),
    Limit("ec", "ec_ms_cm", 0.0, 10.0, "INVALID_EC"),
    Limit("water_temp", "water_temp_c", 0.0, 50.0, "INVALID_WATER_TEMPERATURE"),
    Limit("water_level", "water_level_cm", 0.0, 100.0, "INVALID_WATER_LEVEL"),
    Limit("do", "dissolved_oxygen_mg_l", 0.0, 20.0, "INVALID_DISSOLVED_OXYGEN"),
    Limit("humidity", "humidity_pct", 0.0, 100.0, "INVALID_HUMIDITY"),
)

# Columns without which a record is rejected.
REQUIRED = (
    "event_id", "farm_id", "zone_id", "device_id", "seq_num", "timestamp",
    "ph", "ec_ms_cm", "water_level_cm", "water_temp_c", "dissolved_oxygen_mg_l",
)

# Codes written to published tables.
MISSING_REQUIRED_FIELD = "MISSING_REQUIRED_FIELD"
MASTER_DATA_NOT_FOUND = "MASTER_DATA_NOT_FOUND"
SILVER_LAYER = "SILVER"
ACTIVE = "ACTIVE"
RESOLVED = "RESOLVED"

EVENT_KEY = ("event_id",)
ZONE_KEYS = ("farm_id", "zone_id")
DEVICE_KEYS = ("farm_id", "zone_id", "device_id")
OFFSET_KEYS = ("eventhub_partition", "eventhub_offset")
KPI_KEYS = ("kpi_date", "farm_id", "zone_id")
ALERT_KEY = "alert_key"

STATUS_COLUMNS = tuple(m.status for m in METRICS)
