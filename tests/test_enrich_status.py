import pytest
from tests.data import ZONE, at, bronze, master, record

from pyspark.sql import functions as F

from fieldgauge.operators.enrich import enrich, flag_matched, is_small, MATCHED, unmatched
from fieldgauge.operators.status import grade
from fieldgauge.plans.silver import build_silver


def graded(spark, *readings, **zone):
    facts = spark.createDataFrame(
        [("F1", "Z1", *r) for r in readings],
        "farm_id STRING, zone_id STRING, ph DOUBLE, ec_ms_cm DOUBLE, water_temp_c DOUBLE, water_level_cm DOUBLE, "
        "humidity_pct DOUBLE, dissolved_oxygen_mg_l DOUBLE",
    )
    return grade(flag_matched(enrich(facts, master(spark, zone))))


NORMAL = (6.5, 1.5, 21.0, 19.0, 65.0, 7.5)


def test_bounds_are_inclusive_and_oxygen_has_no_upper_bound(spark):
    low_edge = (5.9, 1.3, 17.5, 16.0, 56.0, 5.8)
    high_edge = (6.9, 1.9, 23.5, 22.5, 74.0, 99.0)
    rows = graded(spark, NORMAL, low_edge, high_edge).collect()
    assert {(r.anomaly_count, r.is_anomaly, r.severity, r.overall_status) for r in rows} == {(0, False, "NONE", "HEALTHY")}


@pytest.mark.parametrize(
    "reading, count, severity, overall",
    [
        ((5.8, 1.5, 21.0, 19.0, 65.0, 7.5), 1, "LOW", "ATTENTION"),
        ((5.8, 2.0, 21.0, 19.0, 65.0, 7.5), 2, "MEDIUM", "ATTENTION"),
        ((5.8, 2.0, 25.0, 19.0, 65.0, 7.5), 3, "HIGH", "CRITICAL"),
        ((7.1, 1.1, 17.0, 23.0, 80.0, 5.7), 6, "HIGH", "CRITICAL"),
    ],
)
def test_severity_follows_the_number_of_abnormal_metrics(spark, reading, count, severity, overall):
    row = graded(spark, reading).first()
    assert (row.anomaly_count, row.severity, row.overall_status) == (count, severity, overall)


def test_null_and_nan_readings_and_missing_bounds(spark):
    row = graded(spark, (None, float("nan"), 21.0, 19.0, None, None), water_temp_max_c=None, do_min_mg_l=None).first()
    assert (row.ph_status, row.ec_status, row.humidity_status) == ("NORMAL", "HIGH", "NORMAL")
    assert (row.water_temp_status, row.do_status) == ("UNKNOWN", "UNKNOWN")
    assert row.anomaly_count == 1


def test_unmatched_zone_and_zone_without_crop(spark):
    facts = spark.createDataFrame([("F1", "Z1"), ("F9", "Z9"), (None, "Z1")], "farm_id STRING, zone_id STRING")
    joined = flag_matched(enrich(facts, master(spark)))
    assert joined.columns[:2] == ["farm_id", "zone_id"]
    assert joined.count() == 3
    assert {(r.farm_id, r.zone_id) for r in unmatched(joined).collect()} == {("F9", "Z9"), (None, "Z1")}
    no_crop = flag_matched(enrich(facts, master(spark, {"crop_type": None})))
    assert no_crop.filter(MATCHED).count() == 0


def test_doubled_dimension_key_is_an_error_that_names_it(spark):
    facts = spark.createDataFrame([("F1", "Z1")], "farm_id STRING, zone_id STRING")
    with pytest.raises(ValueError, match="'F1', 'Z1'"):
        enrich(facts, master(spark, {}, {"location": "Dallas"}))


def test_silver_order_of_stages(spark):
    rows = [
        record(1), record(2), record(2, eventhub_offset=50),
        record(3, ph=99.0),
        record(4, farm_id="F9", device_id="D1"), record(6, farm_id="F9", device_id="D1"),
        record(5), record(7, timestamp="garbage"),
    ]
    built = build_silver(bronze(spark, rows), master(spark), at("2024-03-02"))
    published = {r.event_id: r for r in built.published.collect()}
    assert set(published) == {"E1", "E2", "E5", "E7"}
    assert published["E5"].missing_packet_count == 2
    assert published["E7"].event_timestamp is None
    rejected = {r.event_id: r.validation_error for r in built.quarantined.collect()}
    assert rejected == {"E3": "INVALID_PH", "E4": "MASTER_DATA_NOT_FOUND", "E6": "MASTER_DATA_NOT_FOUND"}
    assert len(built.published.columns) == 60 and len(built.quarantined.columns) == 20


def test_alert_thresholds_come_from_the_zone(spark):
    assert graded(spark, NORMAL).select(F.col("ph_min")).first()[0] == ZONE["ph_min"]


def test_a_large_dimension_is_joined_by_shuffle_and_staged(spark):
    facts = spark.range(100).selectExpr("id % 10 AS k", "id")
    wide = spark.range(10).selectExpr("id AS k", "repeat('x', 1000) AS text")
    small = enrich(facts, wide, ["k"])
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    staged = enrich(facts, wide, ["k"], broadcast_rows=5)
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert staged.count() == 100 and staged.columns == small.columns


def test_size_proofs_look_at_rows_and_bytes(spark):
    rows = spark.range(10).selectExpr("id", "repeat('x', 1000) AS text")
    assert is_small(rows) and not is_small(rows, max_rows=9) and not is_small(rows, max_bytes=5_000)
