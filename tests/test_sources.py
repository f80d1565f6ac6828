import json

import pytest
from pyspark.sql import functions as F
from tests.data import GOOD, at, master

from fieldgauge.plans.stages import Lake, existing_tables, insert_unseen, upsert
from fieldgauge.functions import expressions as X
from fieldgauge.session import scratch_path
from fieldgauge.sources import tables as sinks
from fieldgauge.sources.readers import kafka_options, parse_json, read_reference_csv, table, to_bronze
from fieldgauge.sources.schemas import BRONZE_SCHEMA, REFERENCE_SCHEMA


def test_csv_cells_that_do_not_parse_are_null(spark, tmp_path):
    names = REFERENCE_SCHEMA.names
    lines = [",".join(names),
             "F1,Z1,Northport,Lakeland,America/Winnipeg,Mint,5.5,oops,1.0,1.6,18,25,50,70,6.0,16.5,22.0,True",
             "F1,Z2,Northport,Lakeland,America/Winnipeg,,5.5,6.0,1.0,1.6,18,25,50,70,6.0,16.5,22.0,perhaps"]
    (tmp_path / "ref.csv").write_text("\n".join(lines))
    rows = {r.zone_id: r for r in read_reference_csv(spark, str(tmp_path / "ref.csv")).collect()}
    assert (rows["Z1"].ph_max, rows["Z1"].ph_min, rows["Z1"].active_flag) == (None, 5.5, True)
    assert (rows["Z2"].crop_type, rows["Z2"].active_flag) == (None, None)


@pytest.mark.parametrize(
    "body, field, expected",
    [
        ("not json", "event_id", None),
        ('{"event_id": "a"', "ph", None),
        ('[{"event_id": "a"}]', "ph", None),
        (None, "event_id", None),
        ('{"event_id": 7, "extra": 1}', "event_id", "7"),
        ('{"event_id": "a", "seq_num": "x"}', "seq_num", None),
        ('{"event_id": "a", "seq_num": "x"}', "event_id", "a"),
        ('{"event_id": "a", "seq_num": 1.5}', "seq_num", None),
        ('{"event_id": "a", "ph": "6.5"}', "ph", None),
        ('{"event_id": "a", "ph": 6}', "ph", 6.0),
    ],
)
def test_bodies_parse_permissively(spark, body, field, expected):
    df = spark.createDataFrame([(body,)], "body STRING")
    assert parse_json(df, "body").select(f"parsed.{field}").first()[0] == expected


def test_bronze_row_keeps_payload_and_position(spark):
    body = json.dumps({**GOOD, "event_id": "E1", "seq_num": 1, "timestamp": "2024-03-01T00:00:00+00:00"})
    source = spark.createDataFrame([(bytearray(body.encode()), 3, 42)], "value BINARY, partition INT, offset LONG")
    row = to_bronze(source.withColumn("timestamp", at("2024-03-01")), at("2024-03-02"))
    assert row.schema.names == BRONZE_SCHEMA.names
    assert [f.dataType for f in row.schema] == [f.dataType for f in BRONZE_SCHEMA]
    got = row.first()
    assert (got.event_id, got.raw_payload, got.eventhub_partition, got.eventhub_offset) == ("E1", body, 3, 42)


def test_event_time_keeps_microseconds_and_bad_text_is_null(spark):
    texts = [("2024-03-01T00:00:00.123456+00:00",), ("2024-03-01T02:00:00+02:00",), ("garbage",), (None,)]
    df = spark.createDataFrame(texts, "t STRING").select(X.parse_event_time("t").cast("string").alias("t"))
    assert [r.t for r in df.collect()] == ["2024-03-01 00:00:00.123456", "2024-03-01 00:00:00", None, None]


def test_topic_options_start_early_and_tolerate_loss():
    plain = kafka_options("host:9093", "telemetry")
    assert plain["startingOffsets"] == "earliest" and plain["failOnDataLoss"] == "false"
    assert "kafka.security.protocol" not in plain
    login = kafka_options("host:9093", "telemetry", jaas_config="module required;", startingOffsets="latest")
    assert login["kafka.security.protocol"] == "SASL_SSL" and login["startingOffsets"] == "latest"


def test_snapshot_may_replace_the_table_it_reads(spark, lake):
    base = lake.path("t")
    name = lake.current
    sinks.publish_snapshot(spark.range(3).toDF("n"), name, base)
    held = table(spark, name)
    sinks.publish_snapshot(table(spark, name).withColumn("n", F.col("n") + 10), name, base)
    assert sorted(r.n for r in table(spark, name).collect()) == [10, 11, 12]
    assert sorted(r.n for r in held.collect()) in ([0, 1, 2], [10, 11, 12])
    assert not sinks.supports_merge(spark, name)


def test_insert_unseen_twice_adds_nothing(spark, lake):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, v INT")
    insert_unseen(rows, lake.silver, lake.path(lake.silver), ["k"])
    more = spark.createDataFrame([("b", 9), ("c", 3)], "k STRING, v INT")
    for _ in range(2):
        insert_unseen(more, lake.silver, lake.path(lake.silver), ["k"])
    assert sorted(tuple(r) for r in table(spark, lake.silver).collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_upsert_into_a_table_raises_on_doubled_keys(spark, lake):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, v INT")
    upsert(rows, lake.kpi, lake.path(lake.kpi), ["k"])
    upsert(spark.createDataFrame([("b", 3), ("c", 4)], "k STRING, v INT"), lake.kpi, lake.path(lake.kpi), ["k"])
    assert sorted(tuple(r) for r in table(spark, lake.kpi).collect()) == [("a", 1), ("b", 3), ("c", 4)]
    with pytest.raises(ValueError, match="'b'"):
        upsert(spark.createDataFrame([("b", 3), ("b", 4)], "k STRING, v INT"), lake.kpi, lake.path(lake.kpi), ["k"])


def test_tables_exist_or_not(spark, lake):
    assert set(existing_tables(spark, lake).values()) == {False} and len(existing_tables(spark, lake)) == 7
    path = lake.path(lake.master)
    assert sinks.create_if_absent(master(spark), lake.master, path)
    assert not sinks.create_if_absent(master(spark), lake.master, path)
    assert existing_tables(spark, lake)[lake.master]
    sinks.register_table(spark, lake.alerts, path)
    sinks.register_table(spark, lake.alerts, path)
    assert table(spark, lake.alerts).count() == 1


def test_scratch_paths_lie_in_the_configured_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert Lake("root/").path("t") == "root/t"


def test_superseded_snapshots_go_when_asked(spark, lake):
    base, name = lake.path("t"), lake.kpi
    for n in (1, 2, 3):
        sinks.publish_snapshot(spark.range(n), name, base)
    assert sinks.drop_superseded(spark, name, base) == 2
    assert table(spark, name).count() == 3
    assert sinks.drop_superseded(spark, name, base) == 0
