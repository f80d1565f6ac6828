"""Rejected records in one layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.config import MASTER_DATA_NOT_FOUND, SILVER_LAYER
from fieldgauge.operators.enrich import unmatched
from fieldgauge.operators.quality import ERROR
from fieldgauge.sources.schemas import QUARANTINE_COLUMNS


def _rejected(df: DataFrame, now: Column) -> DataFrame:
    stamped = df.withColumns({"rejected_at": now, "rejection_layer": F.lit(SILVER_LAYER)})
    return stamped.select(*QUARANTINE_COLUMNS)


def quarantine(invalid: DataFrame, graded: DataFrame, now: Column) -> DataFrame:
    """Records that broke a rule, and records whose zone is not in the reference data."""
    unknown_zone = unmatched(graded).withColumn(ERROR, F.lit(MASTER_DATA_NOT_FOUND))
    return _rejected(invalid, now).unionByName(_rejected(unknown_zone, now), allowMissingColumns=True)
