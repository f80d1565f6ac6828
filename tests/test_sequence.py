import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldgauge.operators.sequence import gap_totals, missing_packets, previous_seq


def frame(spark, rows):
    return spark.createDataFrame(rows, "farm_id STRING, zone_id STRING, device_id STRING, seq_num LONG, event_id STRING")


def plain(df):
    window = Window.partitionBy("farm_id", "zone_id", "device_id").orderBy("seq_num", "event_id")
    return df.withColumn("previous_seq_num", F.lag("seq_num").over(window))


def as_set(df):
    return sorted((r.event_id, -1 if r.previous_seq_num is None else r.previous_seq_num) for r in df.collect())


@pytest.mark.parametrize("block_bits", [0, 1, 3, 20])
def test_blocks_give_the_plain_window(spark, block_bits):
    rng = random.Random(block_bits)
    rows = []
    for device in range(6):
        numbers = [rng.randint(-50, 200) for _ in range(rng.choice([1, 2, 40, 120]))]
        numbers += [1] * (60 if device == 0 else 0)
        numbers += [5_000_000_000 + device]
        rows += [("F", "Z", f"D{device}", n, f"{device}-{i:04d}") for i, n in enumerate(numbers)]
    df = frame(spark, rows)
    assert as_set(previous_seq(df, block_bits=block_bits)) == as_set(plain(df))


def test_gap_goes_to_the_later_event(spark):
    rows = [("F", "Z", "D", n, f"E{n}") for n in (1, 2, 5, 6, 10)]
    counted = missing_packets(previous_seq(frame(spark, rows)))
    assert {r.seq_num: (r.previous_seq_num, r.missing_packet_count, r.has_sequence_gap) for r in counted.collect()} == {
        1: (None, 0, False), 2: (1, 0, False), 5: (2, 2, True), 6: (5, 0, False), 10: (6, 3, True),
    }
    assert tuple(gap_totals(counted).first()) == (2, 5)


def test_repeated_numbers_count_a_gap_once(spark):
    rows = [("F", "Z", "D", 1, "a"), ("F", "Z", "D", 4, "b"), ("F", "Z", "D", 4, "c"), ("F", "Z", "D", 4, "d")]
    assert gap_totals(missing_packets(previous_seq(frame(spark, rows)))).first()["total_missing_packets"] == 2


def test_extreme_numbers_do_not_abort(spark):
    rows = [("F", "Z", "D", -(2**63), "a"), ("F", "Z", "D", 2**63 - 1, "b"), ("F", "Z", "E", 2**63 - 1, "c")]
    counted = {r.event_id: r.missing_packet_count for r in missing_packets(previous_seq(frame(spark, rows))).collect()}
    assert counted == {"a": 0, "b": 0, "c": 0}


def test_history_counts_but_is_not_returned(spark):
    new = frame(spark, [("F", "Z", "D", 7, "n1"), ("F", "Z", "D", 8, "n2"), ("F", "Z", "E", 3, "n3")])
    old = frame(spark, [("F", "Z", "D", 4, "o1"), ("F", "Z", "D", 9, "o2"), ("F", "Z", "E", 5, "o3")])
    got = {r.event_id: r.previous_seq_num for r in previous_seq(new, history=old).collect()}
    assert got == {"n1": 4, "n2": 7, "n3": None}


def test_wide_rows_keep_the_partitioning_of_the_dedup(spark, tmp_path):
    from tests.data import bronze, record

    from fieldgauge.operators.grouping import dedup_first

    bronze(spark, [record(n) for n in range(50)]).write.parquet(str(tmp_path / "b"))
    raw = spark.read.parquet(str(tmp_path / "b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = previous_seq(dedup_first(raw))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Between the join and the first shuffle below it on the wide side lies the dedup itself.
    below_join = plan[plan.index("SortMergeJoin"):]
    assert "WindowGroupLimit" in below_join[: below_join.index("Exchange hashpartitioning(event_id")]
