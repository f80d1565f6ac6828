"""Reports: counts, extrema, listings and top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.config import ACTIVE, STATUS_COLUMNS, ZONE_KEYS
from fieldgauge.functions import expressions as X
from fieldgauge.operators.enrich import unmatched
from fieldgauge.operators.sequence import gaps

__all__ = [
    "active_alerts", "alert_listing", "anomalies", "anomaly_states", "current_listing", "extrema", "frequency",
    "gaps", "invalid_listing", "kpi_listing", "latest_ts_per_key", "listing", "newest", "ph_abnormal", "row_counts", "sample",
    "status_frequency", "unmatched_listing",
]


def frequency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value, most frequent first."""
    counted = df.groupBy(*columns).agg(F.count("*").alias("count"))
    return counted.orderBy(F.desc("count"), *columns)


def status_frequency(df: DataFrame, columns: Sequence[str] = STATUS_COLUMNS) -> DataFrame:
    """Rows per value of each status column, from one scan and one shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("status")) for c in columns])
    return (
        df.select(F.inline(pairs))
        .groupBy("metric", "status")
        .agg(F.count("*").alias("count"))
        .orderBy("metric", F.desc("count"), "status")
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
              for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def extrema(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"))


def latest_ts_per_key(df: DataFrame, keys: Sequence[str], ts: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(ts).alias(name))


def newest(df: DataFrame, k: int, order: Sequence[str | Column]) -> DataFrame:
    """Top k rows in the given order; add a unique last column to make the choice definite."""
    return df.orderBy(*order).limit(k)


def sample(df: DataFrame, n: int = 20) -> DataFrame:
    """Any n rows."""
    return df.limit(n)


def listing(
    df: DataFrame, where: Column | str | None = None, order: Sequence[str | Column] = (), columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows that satisfy a condition, in an order; by default in the frame's own layout."""
    kept = df if where is None else df.filter(where)
    ordered = kept.orderBy(*order) if order else kept
    return ordered if columns is None else ordered.select(*columns)


def invalid_listing(invalid: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return listing(invalid, columns=columns)


def unmatched_listing(enriched: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return listing(unmatched(enriched), columns=columns)


def anomalies(graded: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Abnormal readings, newest first."""
    return listing(graded, "is_anomaly", [F.desc("event_timestamp"), "event_id"], columns)


def ph_abnormal(graded: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Readings whose pH is not NORMAL, UNKNOWN included."""
    return listing(graded, "ph_status != 'NORMAL'", columns=columns)


def current_listing(current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return listing(current, order=ZONE_KEYS, columns=columns)


def anomaly_states(current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Zones whose current state is abnormal."""
    return listing(current, "is_anomaly", columns=columns)


def alert_listing(conditions: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return listing(conditions, order=[*ZONE_KEYS, "alert_type"], columns=columns)


def active_alerts(alerts: DataFrame, by_rank: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """Open episodes by severity and recency. ``by_rank`` sorts severity by weight, not as text."""
    severity = X.severity_rank() if by_rank else F.col("severity")
    order = [severity.desc(), F.desc("last_detected_at"), "alert_id"]
    return listing(alerts, F.col("alert_status") == ACTIVE, order, columns)


def kpi_listing(kpi: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return listing(kpi, order=[F.desc("kpi_date"), *ZONE_KEYS], columns=columns)
