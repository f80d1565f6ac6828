"""Alert conditions, their identity and the life of an episode."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldgauge.config import ACTIVE, ALERT_KEY, METRICS, RESOLVED, ZONE_KEYS, Metric
from fieldgauge.functions import expressions as X
from fieldgauge.operators.merge import merge_episodes
from fieldgauge.sources.schemas import ALERT_COLUMNS, ALERT_DIMENSIONS

# What an episode takes over from a new sighting of the same condition.
REFRESHED = (
    "current_value", "min_threshold", "max_threshold", "metric_status", "severity",
    "last_detected_at", "gold_updated_at",
)


def _condition(metric: Metric) -> str:
    # A metric without upper bound can only be low.
    status = metric.status if metric.hi else f"CASE WHEN {metric.status} = 'LOW' THEN {metric.status} END"
    return (
        f"named_struct('alert_type', concat('{metric.alert_prefix}_', {metric.status}), "
        f"'current_value', {metric.value}, 'min_threshold', {metric.lo}, "
        f"'max_threshold', {metric.hi or 'CAST(NULL AS DOUBLE)'}, 'metric_status', {status})"
    )


def current_alert_conditions(
    current: DataFrame, metrics: Sequence[Metric] = METRICS, carry: Sequence[str] = ()
) -> DataFrame:
    """One row per abnormal metric of each current state, from a single scan; ``carry`` names further columns to keep."""
    every = ", ".join(_condition(m) for m in metrics)
    abnormal = f"inline(filter(array({every}), c -> c.metric_status IN ('LOW', 'HIGH')))"
    return current.select(
        *ALERT_DIMENSIONS, "severity", F.col("last_reading_at").alias("detected_at"), *carry, F.expr(abnormal)
    ).select(
        *ALERT_DIMENSIONS,
        "alert_type", "current_value", "min_threshold", "max_threshold", "metric_status", "severity", "detected_at",
        *carry,
    )


def alert_identity(conditions: DataFrame, now: Column, carry: Sequence[str] = ()) -> DataFrame:
    """Give each condition its key and id and open it as an episode."""
    return (
        conditions.withColumn(ALERT_KEY, X.alert_key([*ZONE_KEYS, "alert_type"]))
        .withColumns(
            {
                "alert_id": X.alert_id(ALERT_KEY, "detected_at"),
                "first_detected_at": F.col("detected_at"),
                "last_detected_at": F.col("detected_at"),
                "alert_status": F.lit(ACTIVE),
                "resolved_at": F.lit(None).cast("timestamp"),
                "gold_updated_at": now,
            }
        )
        .select(*ALERT_COLUMNS, *carry)
    )


def open_alerts(current: DataFrame, now: Column, carry: Sequence[str] = ()) -> DataFrame:
    return alert_identity(current_alert_conditions(current, carry=carry), now, carry)


def refreshed(now: Column) -> dict[str, Column | None]:
    """Columns a new sighting sets; None stands for the sighting's own value."""
    return {**{c: None for c in REFRESHED}, "gold_updated_at": now}


def closed(now: Column) -> dict[str, Column]:
    """Columns the end of an episode sets."""
    return {"alert_status": F.lit(RESOLVED), "resolved_at": now, "gold_updated_at": now}


def alert_lifecycle(target: DataFrame, sightings: DataFrame, now: Column) -> DataFrame:
    """Refresh episodes seen again, open new ones, resolve those no longer seen."""
    is_open = F.col("alert_status") == ACTIVE
    return merge_episodes(target, sightings, ALERT_KEY, is_open, refreshed(now), closed(now))


def episode_history(
    states: DataFrame, first: str, last: str, batches: int, clock: Callable[[Column], Column]
) -> DataFrame:
    """All episodes that ``alert_lifecycle`` leaves after ``batches`` batches, in one plan and without running them.

    Each state of a zone carries the numbers of the first and the last batch that find it current; states
    of one zone do not overlap. ``clock`` gives the time of a batch from its number. An episode is a row
    of states that show the same condition with no batch between them: it begins as its first sighting,
    takes what a sighting refreshes from its last one, and ends with the batch after, if there was one.
    """
    sightings = open_alerts(states, clock(F.col(last)), carry=(first, last))
    by_key = Window.partitionBy(ALERT_KEY).orderBy(first)
    begins = F.coalesce(F.col(first) != F.lag(last).over(by_key) + 1, F.lit(True))
    told = sightings.withColumn("_begins", begins.cast("int")).withColumn("_episode", F.sum("_begins").over(by_key))
    row = F.struct(*ALERT_COLUMNS)
    episodes = told.groupBy(ALERT_KEY, "_episode").agg(
        F.min_by(row, first).alias("_opened"), F.max_by(row, last).alias("_seen"), F.max(last).alias("_until")
    )
    kept = refreshed(clock(F.col("_until")))
    over, ended = F.col("_until") < batches, closed(clock(F.col("_until") + 1))

    def value(name: str) -> Column:
        held = F.col(f"_seen.{name}" if name in kept else f"_opened.{name}")
        return (F.when(over, ended[name]).otherwise(held) if name in ended else held).alias(name)

    return episodes.select(*[value(c) for c in ALERT_COLUMNS])
