"""One row per key, and keys that hold more than one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldgauge.config import EVENT_KEY, ZONE_KEYS

_RANK = "_rank_in_key"

ARRIVAL_ORDER = ("eventhub_enqueued_time", "eventhub_partition", "eventhub_offset")


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark plans ``row_number() = 1`` as a group limit on both sides of the shuffle: a task sends at
    most one row per key, so a key that holds a third of all rows costs no more than any other.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def dedup_first(
    df: DataFrame, keys: Sequence[str] = EVENT_KEY, order: Sequence[str | Column] = ARRIVAL_ORDER
) -> DataFrame:
    """Keep the copy of each event that arrived first. Run it after the validity filter."""
    return first_by(df, keys, order)


def latest_per_key(
    df: DataFrame, keys: Sequence[str] = ZONE_KEYS, order: Sequence[str | Column] | None = None
) -> DataFrame:
    """The newest row of each key: event time, then arrival time, then offset; NULLs are oldest."""
    if order is None:
        order = [F.desc(c) for c in ("event_timestamp", "eventhub_enqueued_time", "eventhub_offset")]
    return first_by(df, keys, order)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count. NULL counts as a key here."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).filter(F.col("count") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], what: str, sample: int = 20) -> None:
    """Raise, naming some of the keys, if one occurs twice. Runs one job on the key columns."""
    found = duplicate_keys(df.select(*keys), keys).limit(sample).collect()
    if found:
        listed = "; ".join(str(tuple(row[k] for k in keys)) for row in found)
        raise ValueError(f"duplicate {', '.join(keys)} in {what}: {listed}")
