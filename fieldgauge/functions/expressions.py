"""Scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldgauge.config import MISSING_REQUIRED_FIELD, Limit, Metric


def all_present(columns: Iterable[str]) -> Column:
    """True when none of the columns is NULL."""
    return F.expr(" AND ".join(f"{c} IS NOT NULL" for c in columns))


def within(limit: Limit) -> Column:
    """Closed physical range; NULL for a NULL reading, false for NaN."""
    return F.expr(f"{limit.value} BETWEEN {limit.lo}D AND {limit.hi}D")


def first_error(required_flag: str, limits: Sequence[Limit]) -> Column:
    """Code of the first broken rule: missing fields first, then the limits in their order."""
    rules = [(required_flag, MISSING_REQUIRED_FIELD), *[(limit.flag, limit.error) for limit in limits]]
    return F.expr("CASE " + " ".join(f"WHEN NOT {flag} THEN '{code}'" for flag, code in rules) + " END")


def range_status(value: str, lo: str, hi: str) -> Column:
    """LOW / NORMAL / HIGH against two inclusive bounds, UNKNOWN if a bound is missing."""
    return F.expr(
        f"CASE WHEN {lo} IS NULL OR {hi} IS NULL THEN 'UNKNOWN' "
        f"WHEN {value} < {lo} THEN 'LOW' WHEN {value} > {hi} THEN 'HIGH' ELSE 'NORMAL' END"
    )


def minimum_status(value: str, lo: str) -> Column:
    """LOW / NORMAL against a lower bound, UNKNOWN if it is missing."""
    return F.expr(f"CASE WHEN {lo} IS NULL THEN 'UNKNOWN' WHEN {value} < {lo} THEN 'LOW' ELSE 'NORMAL' END")


def metric_status(metric: Metric) -> Column:
    if metric.hi is None:
        return minimum_status(metric.value, metric.lo)
    return range_status(metric.value, metric.lo, metric.hi)


def count_abnormal(statuses: Iterable[str]) -> Column:
    """How many of the status columns are LOW or HIGH."""
    return F.expr(" + ".join(f"CASE WHEN {s} IN ('LOW', 'HIGH') THEN 1 ELSE 0 END" for s in statuses))


def severity(matched: str, anomalies: str) -> Column:
    return F.expr(
        f"CASE WHEN NOT {matched} THEN 'UNKNOWN' WHEN {anomalies} >= 3 THEN 'HIGH' "
        f"WHEN {anomalies} = 2 THEN 'MEDIUM' WHEN {anomalies} = 1 THEN 'LOW' ELSE 'NONE' END"
    )


def overall_status(matched: str, anomalies: str) -> Column:
    return F.expr(
        f"CASE WHEN NOT {matched} THEN 'UNKNOWN' WHEN {anomalies} >= 3 THEN 'CRITICAL' "
        f"WHEN {anomalies} >= 1 THEN 'ATTENTION' ELSE 'HEALTHY' END"
    )


def severity_rank(column: str = "severity") -> Column:
    """Sort key that puts the worst severity highest; text order would not."""
    ordered = F.array(*[F.lit(s) for s in ("UNKNOWN", "NONE", "LOW", "MEDIUM", "HIGH")])
    return F.array_position(ordered, F.col(column))


def parse_event_time(text: str) -> Column:
    """ISO-8601 text with offset to an instant; text that is no timestamp gives NULL."""
    return F.try_to_timestamp(F.col(text))


def local_time(instant: str, zone: str) -> Column:
    """UTC instant to wall time in the zone named by a column."""
    return F.from_utc_timestamp(F.col(instant), F.col(zone))


def local_date(instant: str, zone: str) -> Column:
    return F.to_date(local_time(instant, zone))


def exact_sum(value: str) -> Column:
    """Sum of decimals of nine digits, the same whatever the order in which partial sums meet.

    A value that is no number, or is beyond 19 digits before the point, is left out, as NULL is.
    """
    return F.expr(f"try_sum(try_cast({value} AS DECIMAL(28, 9)))")


def exact_count(value: str) -> Column:
    """How many values ``exact_sum`` adds."""
    return F.expr(f"count(try_cast({value} AS DECIMAL(28, 9)))")


def exact_quotient(total: str, count: str, factor: int = 1, digits: int = 2) -> Column:
    """``total / count * factor`` to 14 digits, rounded half up; NULL of no values."""
    quotient = f"try_divide(try_cast({total} AS DECIMAL(33, 9)), CAST({count} AS DECIMAL(20, 0)))"
    return F.expr(f"CAST(round({quotient} * {factor}, {digits}) AS DOUBLE)")


def percent(part: str, whole: str) -> Column:
    return F.expr(f"round({part} / {whole} * 100, 2)")


def alert_key(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *columns)


def alert_id(key: str, detected_at: str) -> Column:
    """SHA-256 of the key and the detection time as UTC text."""
    return F.sha2(F.concat_ws("|", F.col(key), F.col(detected_at).cast("string")), 256)
