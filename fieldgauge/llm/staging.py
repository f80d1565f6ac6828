"""Helpers the operators share: lineage cuts, ranks, bounded broadcasts, column hygiene."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.session import cut_lineage

__all__ = ["cut_lineage", "global_rank", "row_and_text", "small_side", "unpacked", "without"]

#: A side of at most this many rows of a few numbers or short strings is broadcast.
SMALL_ROWS = 100_000
SMALL_BYTES = 16 * 2**20


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns of these names, whatever their case."""
    lowered = {n.lower() for n in names}
    gone = [c for c in df.columns if c.lower() in lowered]
    return df.drop(*gone) if gone else df


def small_side(staged: DataFrame) -> DataFrame:
    """Broadcast a staged frame whose rows and bytes are proven few; leave any other to the planner.

    Both figures come from one aggregate over the staged files: a row per task, no single reducer
    that sees rows.
    """
    width = sum((F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in staged.columns), F.lit(0))
    rows, size = staged.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(staged) if rows <= SMALL_ROWS and size <= SMALL_BYTES else staged


def global_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """0-based rank of each row in a total order, by range partitions and their sizes.

    Only the partition sizes reach the driver. Rows that tie are ranked in any order.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row"))
    )
    sizes = {r["_part"]: r["n"] for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    starts, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(part, 0)
    start = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts or [0]]), F.col("_part") + 1)
    within = F.col("_row").bitwiseAND(2**33 - 1)
    return placed.withColumn(name, start + within).drop("_part", "_row")


def row_and_text(docs: DataFrame, text: str, names: list[str]) -> DataFrame:
    """``_row`` (the columns ``names`` as a struct, whatever they are called) and ``_text``."""
    kept = [F.col(f"`{c}`") for c in names] or [F.lit(None).cast("int").alias("none")]
    return docs.select(F.struct(*kept).alias("_row"), F.col(f"`{text}`").cast("string").alias("_text"))


def unpacked(names: list[str]) -> list[Column]:
    """The columns of ``_row`` again."""
    return [F.col("_row").getField(c).alias(c) for c in names]
