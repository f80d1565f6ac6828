"""Sets of numbers per key as runs of consecutive numbers.

Runs are cut at the borders of chunks of 2**CHUNK_BITS numbers, so that every window and every join below
is bounded by a chunk, however many numbers one key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_BITS = 12


def chunk_of(number: str) -> Column:
    return F.shiftright(F.col(number).cast("long"), CHUNK_BITS)


def as_runs(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """``keys, lo, hi``: a run of one number for each distinct one; NULL numbers are in no run."""
    distinct = df.select(*keys, F.col(number).cast("long").alias("lo")).filter("lo IS NOT NULL").distinct()
    return distinct.withColumn("hi", F.col("lo"))


def merge_runs(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overlapping and adjacent runs of a chunk joined: ``keys, lo, hi``."""
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy("lo", "hi")
    before = in_chunk.rowsBetween(Window.unboundedPreceding, -1)
    reached = runs.withColumn("_chunk", chunk_of("lo")).withColumn("_reached", F.max("hi").over(before))
    starts = F.when(F.col("_reached") >= F.col("lo") - 1, 0).otherwise(1)
    numbered = reached.withColumn("_run", F.sum(starts).over(in_chunk.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_chunk", "_run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(
        *keys, "lo", "hi"
    )


def mark_members(df: DataFrame, runs: DataFrame, keys: Sequence[str], number: str, name: str) -> DataFrame:
    """Add the start of the run that holds the row's number, NULL if none does.

    Runs of one key do not overlap, so at most one meets a row. NULL keys and numbers are in no run.
    """
    held = runs.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col("lo").alias(name), F.col("hi").alias("_hi"))
    held = held.withColumn("_r_chunk", chunk_of(name))
    same = [F.col(k) == F.col(f"_r_{k}") for k in keys]
    within = (chunk_of(number) == F.col("_r_chunk")) & F.col(number).between(F.col(name), F.col("_hi"))
    condition = within
    for part in same:
        condition = condition & part
    return df.join(held, condition, "left").select(*df.columns, name)
