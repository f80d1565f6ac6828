"""Two-pass external shuffle into shards.

The first pass scatters records by seeded hashes into buckets that fit in memory, each of which is
one partition of a Spark shuffle; the second permutes each bucket (Fisher-Yates) and numbers its
records. A shard is the sequence of its buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgauge.llm.staging import cut_lineage, small_side, without

# A bucket is one task's memory: it grows with the input, so that reducers stay some 10^5, up to a bound.
BUCKET_BYTES = (32 * 2**20, 256 * 2**20)
MOST_BUCKETS = 100_000
RECORD_OVERHEAD = 8


def record_size(text: str) -> Column:
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + RECORD_OVERHEAD).cast("long")


def shard_of(key: str, shards: int, seed: int) -> Column:
    """The last shard number ``j`` whose draw of one in ``j + 1`` the key wins.

    Shards are equally likely, and with one more shard a key either stays or moves to the new one.
    """
    wins = [
        F.when(F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.lit(j)), F.lit(j + 1)) == 0, F.lit(j))
        for j in range(shards - 1, 0, -1)
    ]
    return F.coalesce(*wins, F.lit(0))


def _hashable(field: T.StructField) -> Column:
    """The column, or its JSON text if it holds a map, which has no hash."""
    column = F.col(f"`{field.name}`")
    return F.to_json(F.struct(column)) if "map<" in field.dataType.simpleString() else column


def bucket_bytes_for(total: int) -> int:
    least, most = BUCKET_BYTES
    return min(most, max(least, total // MOST_BUCKETS))


def scatter(
    docs: DataFrame, shards: int = 24, seed: int = 17, key: str = "doc_id", text: str = "text",
    bucket_bytes: int | None = None,
) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The records with ``shard`` and ``_bucket``, and ``(shard, first bucket)`` for each shard.

    The bucket is a hash of the whole record. Repeats of one record that would fill an eighth of a
    bucket are numbered in a staged table, and the number takes part in their hash.
    """
    hashed = [_hashable(f) for f in docs.schema.fields]
    placed = docs.withColumn("shard", shard_of(key, shards, seed)).withColumn(
        "_order", F.xxhash64(F.lit(seed), F.lit("order"), *hashed)
    )
    groups = cut_lineage(
        placed.groupBy("shard", "_order").agg(F.sum(record_size(text)).alias("bytes"), F.count("*").alias("rows"))
    )
    weights = {r["shard"]: r["n"] for r in groups.groupBy("shard").agg(F.sum("bytes").alias("n")).collect()}
    limit = bucket_bytes_for(sum(weights.values())) if bucket_bytes is None else bucket_bytes
    counts = [max(1, -(-weights.get(s, 0) // limit)) for s in range(shards)]
    firsts = np.concatenate([[0], np.cumsum(counts)]).astype(int).tolist()
    first = F.element_at(F.array(*[F.lit(x) for x in firsts]), F.col("shard") + 1)
    many = F.element_at(F.array(*[F.lit(x) for x in counts]), F.col("shard") + 1)
    repeats = cut_lineage(groups.filter((F.col("rows") > 1) & (F.col("bytes") * 8 > limit)).select("_order").distinct())
    if not repeats.isEmpty():
        few = small_side(repeats)
        numbered = cut_lineage(
            placed.join(few, "_order", "left_semi").withColumn("_number", F.monotonically_increasing_id())
        )
        dealt = numbered.withColumn("_order", F.xxhash64("_order", "_number")).drop("_number")
        placed = placed.join(few, "_order", "left_anti").select(*placed.columns).unionByName(dealt)
    within = F.pmod(F.xxhash64(F.lit(seed), F.lit("bucket"), "_order"), many).cast("int")
    return placed.withColumn("_bucket", first + within), list(zip(range(shards), firsts))


def _permute(seed: int, offsets) -> callable:
    """Second pass over one partition, which is one bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        bucket = pa.Table.from_batches(held)
        number = bucket.column("_bucket")[0].as_py()
        # Records reach a bucket in any order: a canonical one comes first, so that reruns agree.
        canonical = np.argsort(bucket.column("_order").to_numpy(), kind="stable")
        shuffled = canonical[np.random.default_rng([seed, number]).permutation(len(canonical))]
        slots = pa.array(offsets.value[number] + np.arange(len(shuffled), dtype=np.int64))
        bucket = bucket.drop_columns(["_order", "_bucket"])
        step = max(1, len(shuffled) // max(1, bucket.nbytes // (8 * 2**20)))
        for at in range(0, len(shuffled), step):
            part = bucket.take(pa.array(shuffled[at : at + step])).append_column("slot", slots[at : at + step])
            yield from part.combine_chunks().to_batches()

    return run


def shard_records(
    docs: DataFrame, shards: int = 24, seed: int = 17, key: str = "doc_id", text: str = "text",
    bucket_bytes: int | None = None,
) -> DataFrame:
    """All records with ``shard``, ``slot`` (gapless from 0 in each shard) and ``grown_shard``.

    * The shard depends on the key and the number of shards alone; ``grown_shard`` is the key's shard
      with one shard more. NULL keys share one shard.
    * Buckets are sized by the bytes of their shard, so a shard that holds a third of all records has
      more buckets, not larger ones. Rows equal in every column are dealt over the shard's buckets
      once they would fill an eighth of one.
    * What reaches the driver, and the tasks, is one number per bucket (32 MB of records, and more from
      3 TB on, up to 256 MB, unless ``bucket_bytes`` is given).
    * Columns that hold maps take part as their JSON text.
    * A NULL or empty text is a record like others. Columns named like an added one are replaced.
    """
    kept = without(docs, "shard", "slot", "grown_shard", "_bucket", "_order")
    scattered, firsts = scatter(kept, shards, seed, key, text, bucket_bytes)
    rows = {r["_bucket"]: r["n"] for r in scattered.groupBy("_bucket").agg(F.count("*").alias("n")).collect()}
    buckets = max([b for _, b in firsts] + list(rows)) + 1
    starts, counts = {b for _, b in firsts}, [rows.get(b, 0) for b in range(buckets)]
    offsets, at = np.zeros(buckets, np.int64), 0
    for b, n in enumerate(counts):
        at = 0 if b in starts else at
        offsets[b] = at
        at += n
    shared = docs.sparkSession.sparkContext.broadcast(offsets)
    wide = scattered.withColumn("grown_shard", shard_of(key, shards + 1, seed))
    out = T.StructType([f for f in wide.schema.fields if f.name not in ("_bucket", "_order")])
    out = T.StructType(out.fields + [T.StructField("slot", T.LongType())])
    dealt = wide.repartitionById(buckets, F.col("_bucket"))
    return dealt.mapInArrow(_permute(seed, shared), out)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; files hold whole buckets in their order of slots."""
    sharded.write.partitionBy("shard").parquet(path)
