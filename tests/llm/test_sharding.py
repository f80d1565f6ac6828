import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import sharding


def shard(docs, **options):
    return [r.asDict() for r in sharding.shard_records(docs, **options).collect()]


def gapless(rows):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    return all(sorted(v) == list(range(len(v))) for v in by.values())


def test_shards_slots_and_reruns(documents):
    docs = documents([(i, f"text {i} " * (i % 50), "en", "s") for i in range(2_000)])
    rows = shard(docs, bucket_bytes=2_000)
    assert sorted(r["doc_id"] for r in rows) == list(range(2_000)) and gapless(rows)
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) < 2 * min(counts.values())
    again = shard(docs.repartition(7), bucket_bytes=2_000)
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in rows} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}
    # Shuffled: neighbours by id are rarely neighbours in a shard.
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < 40


def test_growing_moves_rows_into_the_new_shard_only(documents):
    docs = documents([(i, "x", "en", "s") for i in range(1_500)])
    rows = shard(docs)
    assert all(r["grown_shard"] in (r["shard"], 24) for r in rows)
    assert {r["doc_id"]: r["grown_shard"] for r in rows} == {r["doc_id"]: r["shard"] for r in shard(docs, shards=25)}
    assert 20 < sum(r["grown_shard"] == 24 for r in rows) < 120


def test_one_key_with_a_third_of_the_rows_gets_more_buckets(documents):
    docs = documents([(7 if i % 3 == 0 else i, f"copy {i}", "en", "s") for i in range(900)])
    _, firsts = sharding.scatter(docs, bucket_bytes=1_000)
    rows = shard(docs, bucket_bytes=1_000)
    (hot,) = {r["shard"] for r in rows if r["doc_id"] == 7}
    buckets = [b for _, b in firsts]
    assert buckets[hot + 1] - buckets[hot] >= 4 if hot < 23 else True
    assert len(rows) == 900 and gapless(rows)


def test_edges(documents):
    assert shard(documents([])) == []
    odd = [(None, None, None, None), (None, "", None, None), (1, "é" * 200_000, None, None), (2, "x", "en", "s"), (2, "x", "en", "s")]
    rows = shard(documents(odd), bucket_bytes=100)
    assert len(rows) == 5 and gapless(rows)
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    clash = documents(odd).withColumn("SLOT", F.lit("a")).withColumn("shard", F.lit("b"))
    rows = shard(clash)
    assert all(isinstance(r["slot"], int) and isinstance(r["shard"], int) for r in rows) and "SLOT" not in rows[0]


def test_written_shards_hold_the_slots(documents, tmp_path, spark):
    docs = documents([(i, f"t{i}", "en", "s") for i in range(300)])
    sharding.write_shards(sharding.shard_records(docs, shards=3), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 300 and back.select("shard").distinct().count() == 3


@pytest.mark.parametrize("text", ["", "é", None])
def test_size(documents, text):
    (row,) = documents([(1, text, None, None)]).select(sharding.record_size("text").alias("n"), F.crc32(F.coalesce("text", F.lit(""))).alias("c")).collect()
    raw = (text or "").encode()
    assert (row["n"], row["c"]) == (len(raw) + 8, zlib.crc32(raw))


def test_repeats_of_one_record_are_dealt_over_buckets(documents):
    docs = documents([(7, "same " * 20, "en", "s")] * 900 + [(i, "other", "en", "s") for i in range(100, 400)])
    scattered, _ = sharding.scatter(docs, shards=2, bucket_bytes=4_000)
    sizes = {r["_bucket"]: r["n"] for r in scattered.groupBy("_bucket").agg(F.sum(sharding.record_size("text")).alias("n")).collect()}
    assert len(sizes) > 20 and max(sizes.values()) < 3 * 4_000
    rows = shard(docs, shards=2, bucket_bytes=4_000)
    assert len(rows) == 1_200 and gapless(rows) and sum(r["doc_id"] == 7 for r in rows) == 900
    assert len({r["shard"] for r in rows if r["doc_id"] == 7}) == 1


def test_columns_with_maps(spark):
    docs = spark.sql("SELECT id AS doc_id, string(id) AS text, map('k', id) AS m, array(map(1, 'v')) AS a FROM range(50)")
    rows = shard(docs, shards=3)
    assert len(rows) == 50 and gapless(rows) and all(r["m"] == {"k": r["doc_id"]} for r in rows)


def test_buckets_grow_with_the_input():
    assert sharding.bucket_bytes_for(10**9) == 32 * 2**20 and sharding.bucket_bytes_for(10**14) == 256 * 2**20
