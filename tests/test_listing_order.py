from pyspark.sql import functions as F

from fieldgauge.operators import listing

ZONES = [("F2", "Z1", 1), ("F1", "Z2", 2), ("F1", "Z1", 3)]


def values(df, column="n"):
    return [r[column] for r in df.collect()]


def test_listings_by_zone(spark):
    zones = spark.createDataFrame(ZONES, "farm_id string, zone_id string, n int")
    assert values(listing.current_listing(zones)) == [3, 2, 1]
    alerts = zones.crossJoin(spark.createDataFrame([("b",), ("a",)], "alert_type string"))
    assert [(r.n, r.alert_type) for r in listing.alert_listing(alerts).collect()] == [(n, t) for n in (3, 2, 1) for t in "ab"]


def test_kpi_listing_is_newest_first(spark):
    zones = spark.createDataFrame(ZONES, "farm_id string, zone_id string, n int")
    days = zones.crossJoin(spark.sql("SELECT explode(array(date'2024-01-01', date'2024-01-03', null)) AS kpi_date"))
    got = [(r.kpi_date and r.kpi_date.day, r.n) for r in listing.kpi_listing(days).collect()]
    assert got == [(d, n) for d in (3, 1, None) for n in (3, 2, 1)]


def test_anomalies_are_newest_first(spark):
    rows = spark.createDataFrame(
        [("a", 1, True), ("c", 2, True), ("b", 2, True), ("d", 3, False)], "event_id string, event_timestamp int, is_anomaly boolean"
    )
    assert values(listing.anomalies(rows), "event_id") == ["b", "c", "a"]
    assert listing.anomalies(rows, ["event_id"]).columns == ["event_id"]


def test_most_frequent_first(spark):
    rows = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "k string")
    assert values(listing.frequency(rows, ["k"]), "k") == ["y", None, "x"]


def test_gaps_are_in_device_order(spark):
    rows = spark.createDataFrame(
        [("F1", "Z1", "D2", 9), ("F1", "Z1", "D1", 7), ("F1", "Z1", "D1", 3)], "farm_id string, zone_id string, device_id string, seq_num long"
    ).selectExpr("*", "1L AS previous_seq_num", "1L AS missing_packet_count", "true AS has_sequence_gap", "timestamp'2024-01-01' AS event_timestamp")
    assert values(listing.gaps(rows), "seq_num") == [3, 7, 9]


def test_newest_has_a_definite_order(spark):
    rows = spark.range(20).withColumn("t", F.col("id") % 3)
    assert values(listing.newest(rows, 4, [F.desc("t"), "id"]), "id") == [2, 5, 8, 11]
