"""Reference data joined to facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.config import ZONE_KEYS
from fieldgauge.operators.grouping import assert_unique
from fieldgauge.session import cut_lineage

MATCHED = "master_data_matched"
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 2**20


def row_bytes(df: DataFrame) -> Column:
    """About what a row takes: the length of its columns as text, and eight bytes for each."""
    lengths = [F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8 for c in df.columns]
    return sum(lengths, F.lit(0)).cast("long")


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table or staged frame is proved small, in rows and in bytes.

    One aggregate with a row per task; no rows are gathered to be counted.
    """
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a table or staged frame for broadcast if it is proved to be small, else leave the choice to Spark."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def enrich(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str] = ZONE_KEYS,
    check_unique: bool = True,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join facts to a dimension; facts keep their number because the keys must be unique.

    One job over the dimension proves the keys unique and its rows and bytes few. Then it is broadcast;
    otherwise the join shuffles, and its result is staged: as the last step of its job the join can be
    split by adaptive execution where a key is hot, which it could not below a window or an aggregate
    on the same keys.
    """
    if check_unique:
        per_key = dimension.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(row_bytes(dimension)).alias("size"))
        rows, size, largest = per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0)), F.max("n")
        ).first()
        if largest and largest > 1:
            assert_unique(dimension, keys, "the dimension")
        small = rows <= broadcast_rows and size <= BROADCAST_BYTES
    else:
        small = is_small(dimension, broadcast_rows)
    if small:
        return facts.join(F.broadcast(dimension), list(keys), "left")
    return cut_lineage(facts.join(dimension, list(keys), "left"))


def flag_matched(df: DataFrame, witness: str = "crop_type") -> DataFrame:
    """A row is matched if the witness column of the dimension is present."""
    return df.withColumn(MATCHED, F.col(witness).isNotNull())


def unmatched(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(MATCHED))
