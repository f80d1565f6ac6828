"""Lost packets from gaps in per-device sequence numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldgauge.config import DEVICE_KEYS, EVENT_KEY
from fieldgauge.operators.grouping import first_by

PREVIOUS = "previous_seq_num"
MISSING = "missing_packet_count"
HAS_GAP = "has_sequence_gap"

BLOCK_BITS = 20


def previous_seq(
    df: DataFrame,
    keys: Sequence[str] = DEVICE_KEYS,
    seq: str = "seq_num",
    row_id: Sequence[str] = EVENT_KEY,
    history: DataFrame | None = None,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add the number before each row's own within its key, as ``lag`` over the whole key would.

    A plain window puts a whole device into one task, and one device may send a third of all rows.
    So only the numbers travel. They are reduced to one row per distinct number, on the map side
    too; of several rows with one number the one with the smallest ``row_id`` follows the gap, and
    the others follow it. Then they are looked at in blocks of 2**block_bits numbers, which bounds
    every window group. Only the two ends of each block go on to a window over the whole key, which
    carries the number across blocks.

    The result is joined back on ``row_id``, the columns that tell all rows apart. After a
    ``dedup_first`` on the same columns the rows already lie in the right partitions, so the wide
    rows are not shuffled again.

    ``history`` holds rows (same key, number and id columns) that count as predecessors but are not
    returned.
    """
    keys, row_id = list(keys), list(row_id)
    narrow = list(dict.fromkeys([*keys, seq, *row_id]))
    numbers = df.select(*narrow)
    if history is not None:
        numbers = numbers.unionByName(history.select(*narrow))

    in_block = Window.partitionBy(*keys, "_block").orderBy(seq)
    in_key = Window.partitionBy(*keys).orderBy(seq)
    chained = (
        first_by(numbers, [*keys, seq], row_id)
        .withColumn("_block", F.shiftright(F.col(seq).cast("long"), block_bits))
        .withColumns({"_before": F.lag(seq).over(in_block), "_after": F.lead(seq).over(in_block)})
    )
    inner = chained.filter("_before IS NOT NULL").select(*row_id, "_before")
    edges = (
        chained.filter("_before IS NULL OR _after IS NULL")
        .withColumn("_across", F.lag(seq).over(in_key))
        .filter("_before IS NULL")
        .select(*row_id, F.col("_across").alias("_before"))
    )
    leads = inner.unionByName(edges).withColumn("_leads", F.lit(True))
    previous = F.expr(f"CASE WHEN _leads THEN _before ELSE {seq} END")
    return df.join(leads, row_id, "left").withColumn(PREVIOUS, previous).drop("_before", "_leads")


def missing_packets(df: DataFrame, seq: str = "seq_num") -> DataFrame:
    """Add how many numbers are missing before each row, and whether any are."""
    skipped = F.expr(f"CAST(greatest(coalesce(try_subtract(try_subtract({seq}, {PREVIOUS}), 1), 0), 0) AS BIGINT)")
    return df.withColumn(MISSING, skipped).withColumn(HAS_GAP, F.col(MISSING) > 0)


def gap_totals(df: DataFrame) -> DataFrame:
    """One row: number of gaps and of packets lost in them."""
    return df.agg(F.count_if(HAS_GAP).alias("gap_count"), F.try_sum(MISSING).alias("total_missing_packets"))


def gaps(df: DataFrame) -> DataFrame:
    """Rows that follow a gap, ordered by device and number."""
    return (
        df.filter(F.col(HAS_GAP))
        .select(*DEVICE_KEYS, PREVIOUS, "seq_num", MISSING, "event_timestamp")
        .orderBy(*DEVICE_KEYS, "seq_num")
    )
