import pytest
from tests.data import bronze, record

from fieldgauge.operators.grouping import assert_unique, dedup_first, duplicate_keys, latest_per_key


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_keeps_the_copy_that_arrived_first(spark):
    rows = [
        record(5, event_id="A", eventhub_offset=7, ph=1.0),
        record(5, event_id="A", eventhub_offset=6, ph=2.0),
        record(4, event_id="A", eventhub_offset=9, ph=3.0),
        record(9, event_id="B"),
    ]
    kept = {r.event_id: r.ph for r in dedup_first(bronze(spark, rows)).collect()}
    assert kept == {"A": 3.0, "B": 6.5}


def test_one_row_per_key_leaves_each_map_task(spark, tmp_path):
    rows = bronze(spark, [record(n, event_id="HOT" if n % 3 else f"E{n}") for n in range(300)])
    rows.repartition(4).write.parquet(str(tmp_path / "t"))
    first = dedup_first(spark.read.parquet(str(tmp_path / "t")))
    assert "Partial" in plan_of(first) and "WindowGroupLimit" in plan_of(first)
    assert first.count() == 101


def test_latest_orders_nulls_last(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
             ('F', 'Z', CAST(NULL AS TIMESTAMP), TIMESTAMP '2024-01-03', 1L),
             ('F', 'Z', TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-01', 2L),
             ('F', 'Z', TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-02', 3L),
             ('F', 'Z', TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-02', 4L)
           AS t(farm_id, zone_id, event_timestamp, eventhub_enqueued_time, eventhub_offset)"""
    )
    assert [r.eventhub_offset for r in latest_per_key(df).collect()] == [4]


def test_duplicate_keys_and_the_error_that_lists_them(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2)], "k STRING, v INT")
    assert {(r["k"], r["count"]) for r in duplicate_keys(df, ["k"]).collect()} == {("a", 2), (None, 2)}
    with pytest.raises(ValueError, match="'a'"):
        assert_unique(df.filter("k IS NOT NULL"), ["k"], "the test")
    assert_unique(df.filter("k = 'b'"), ["k"], "the test")
