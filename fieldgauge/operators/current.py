"""Latest state per zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.operators.grouping import latest_per_key
from fieldgauge.sources.schemas import CURRENT_COLUMNS


def current_status(silver: DataFrame, now: Column) -> DataFrame:
    """The newest reading of any device in the zone, in the published layout."""
    latest = latest_per_key(silver)
    return latest.withColumns({"last_reading_at": F.col("event_timestamp"), "gold_updated_at": now}).select(
        *CURRENT_COLUMNS
    )
