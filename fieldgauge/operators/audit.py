"""Checks over the published tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.config import ACTIVE, ALERT_KEY, EVENT_KEY, KPI_KEYS, ZONE_KEYS
from fieldgauge.operators.grouping import duplicate_keys
from fieldgauge.operators.listing import latest_ts_per_key
from fieldgauge.sources.schemas import SILVER_NOT_NULL


def bad_health_score(column: str = "health_score") -> Column:
    """Outside 0..100 or missing."""
    score = F.col(column)
    return score.isNull() | (score < 0) | (score > 100)


def bad_anomaly_rate(column: str = "anomaly_rate_pct") -> Column:
    """Outside 0..100; a missing rate passes."""
    rate = F.col(column)
    return (rate < 0) | (rate > 100)


def null_counts(df: DataFrame, columns: Sequence[str] = SILVER_NOT_NULL) -> DataFrame:
    """One row per column with its number of NULLs, all from one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])
    return counted.select(F.inline(rows)).withColumn("passed", F.col("null_count") == 0)


def null_rows(df: DataFrame, columns: Sequence[str] = SILVER_NOT_NULL) -> DataFrame:
    """Rows in which one of the columns is NULL."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def active_duplicates(alerts: DataFrame) -> DataFrame:
    return duplicate_keys(alerts.filter(F.col("alert_status") == ACTIVE), [ALERT_KEY])


def freshness(current: DataFrame, silver: DataFrame) -> DataFrame:
    """Published time of each zone next to the newest one in silver."""
    latest = latest_ts_per_key(silver, ZONE_KEYS, "event_timestamp", "silver_latest_timestamp")
    return (
        current.select(*ZONE_KEYS, "last_reading_at")
        .join(latest, list(ZONE_KEYS), "left")
        .withColumn("timestamp_match", F.col("last_reading_at") == F.col("silver_latest_timestamp"))
    )


def stale(fresh: DataFrame) -> DataFrame:
    """Zones whose published time differs; one that cannot be compared passes."""
    return fresh.filter(~F.col("timestamp_match"))


# Names of the checks as published.
SILVER_DUPLICATES = "Silver duplicate event IDs"
CURRENT_DUPLICATES = "Gold current duplicate keys"
ALERT_DUPLICATES = "Gold active alert duplicates"
DAILY_DUPLICATES = "Gold daily duplicate keys"
HEALTH_SCORES = "Invalid health scores"
ANOMALY_RATES = "Invalid anomaly rates"
FRESHNESS = "Gold freshness"


def _failures(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row per check, by its published name, all from one aggregate."""
    rows = F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.coalesce(count, F.lit(0)).cast("long").alias("failures"))
        for name, count in checks.items()
    ])
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def validation_report(silver: DataFrame, current: DataFrame, alerts: DataFrame, kpi: DataFrame) -> DataFrame:
    """Seven checks with their failures, and an eighth row for all of them together.

    Each table but silver is read once; silver is read for its ids and for its newest times. Keys are
    grouped first, so a check on a group and one on its rows share the pass.
    """
    zones = current.groupBy(*ZONE_KEYS).agg(F.count("*").alias("rows"), F.collect_list("last_reading_at").alias("times"))
    latest = latest_ts_per_key(silver, ZONE_KEYS, "event_timestamp", "newest")
    compared = zones.join(latest, list(ZONE_KEYS), "left")
    late = F.size(F.filter("times", lambda t: t != F.col("newest")))
    days = kpi.groupBy(*KPI_KEYS).agg(
        F.count("*").alias("rows"), F.count_if(bad_health_score()).alias("health"), F.count_if(bad_anomaly_rate()).alias("rate")
    )
    checks = [
        _failures(duplicate_keys(silver, EVENT_KEY), {SILVER_DUPLICATES: F.count("*")}),
        _failures(
            compared, {CURRENT_DUPLICATES: F.count_if(F.col("rows") > 1), FRESHNESS: F.sum(F.greatest(late, F.lit(0)))}
        ),
        _failures(active_duplicates(alerts), {ALERT_DUPLICATES: F.count("*")}),
        _failures(
            days,
            {DAILY_DUPLICATES: F.count_if(F.col("rows") > 1), HEALTH_SCORES: F.sum("health"), ANOMALY_RATES: F.sum("rate")},
        ),
    ]
    each = reduce(DataFrame.unionByName, checks)
    # Seven rows: the grand total of a rollup gives the overall line without running the checks twice.
    both = each.rollup("check_name").agg(F.sum("failures").alias("failures"))
    named_rows = both.withColumn("check_name", F.coalesce("check_name", F.lit("OVERALL")))
    return named_rows.withColumn("passed", F.col("failures") == 0)
