"""KPIs per zone and local day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.functions import expressions as X
from fieldgauge.sources.schemas import KPI_AVERAGES, KPI_COLUMNS, KPI_DUTY_CYCLES, KPI_GROUP_COLUMNS

LOCAL_TIME = "local_event_timestamp"


def local_day(silver: DataFrame) -> DataFrame:
    """Add the wall time at the zone and its date."""
    return silver.withColumn(LOCAL_TIME, X.local_time("event_timestamp", "timezone")).withColumn(
        "kpi_date", F.to_date(LOCAL_TIME)
    )


def _averaged() -> dict[str, tuple[str, int]]:
    """Published average to what it averages and by what factor."""
    flags = {name: (f"CAST({flag} AS INT)", 100) for name, flag in KPI_DUTY_CYCLES.items()}
    return {name: (value, 1) for name, value in KPI_AVERAGES.items()} | flags


def kpi_partials(silver: DataFrame) -> DataFrame:
    """What the KPIs of a day are made of: counts, exact sums and extrema, which add up over any split of its rows.

    All aggregates combine on the map side, so the shuffle carries one row per task and group. A
    reading whose time could not be parsed falls into the day NULL.
    """
    sums = [X.exact_sum(value).alias(f"{name}_sum") for name, (value, _) in _averaged().items()]
    counts = [X.exact_count(value).alias(f"{name}_n") for name, (value, _) in _averaged().items()]
    return local_day(silver).groupBy(*KPI_GROUP_COLUMNS).agg(
        F.expr("count(*) AS reading_count"),
        F.expr("sum(CAST(is_anomaly AS INT)) AS anomaly_reading_count"),
        F.expr("try_sum(missing_packet_count) AS missing_packet_count"),
        *sums, *counts,
        F.min(LOCAL_TIME).alias("first_reading_at"),
        F.max(LOCAL_TIME).alias("last_reading_at"),
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """Partials of several splits as one row per day and zone."""
    added = ["reading_count", "anomaly_reading_count", *[f"{n}_n" for n in _averaged()]]
    tried = ["missing_packet_count", *[f"{n}_sum" for n in _averaged()]]
    types = dict(partials.dtypes)
    return partials.groupBy(*KPI_GROUP_COLUMNS).agg(
        *[F.sum(c).alias(c) for c in added],
        *[F.try_sum(c).cast(types[c]).alias(c) for c in tried],
        F.min("first_reading_at").alias("first_reading_at"),
        F.max("last_reading_at").alias("last_reading_at"),
    ).select(*partials.columns)


def kpi_of_partials(partials: DataFrame, now: Column, drop_null_date: bool = False) -> DataFrame:
    """Published KPIs: averages rounded once, rates and scores."""
    if drop_null_date:
        partials = partials.filter("kpi_date IS NOT NULL")
    sent = "try_add(reading_count, missing_packet_count)"
    averages = {name: X.exact_quotient(f"{name}_sum", f"{name}_n", factor) for name, (_, factor) in _averaged().items()}
    return (
        partials.withColumns({**averages, "anomaly_rate_pct": X.percent("anomaly_reading_count", "reading_count")})
        .withColumns(
            {
                "health_score": F.expr("round(greatest(0D, 100D - anomaly_rate_pct), 2)"),
                "packet_gap_rate_pct": X.percent("missing_packet_count", sent),
                "gold_updated_at": now,
            }
        )
        .select(*KPI_COLUMNS)
    )


def daily_kpi(silver: DataFrame, now: Column, drop_null_date: bool = False) -> DataFrame:
    """Volume, averages, duty cycles and rates per local day and zone.

    The day NULL, of readings whose time could not be parsed, never matches in a merge;
    ``drop_null_date`` leaves that group out.
    """
    return kpi_of_partials(kpi_partials(silver), now, drop_null_date)
