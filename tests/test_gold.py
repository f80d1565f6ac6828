from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from tests.data import at, bronze, master, record

from fieldgauge.operators import audit, listing
from fieldgauge.operators.alerts import alert_lifecycle, current_alert_conditions, episode_history, open_alerts
from fieldgauge.operators.current import current_status
from fieldgauge.operators.kpi import daily_kpi
from fieldgauge.plans.silver import build_silver
from fieldgauge.session import cut_lineage


def silver(spark, rows, *zones):
    return build_silver(bronze(spark, rows), master(spark, *zones), at("2024-03-02")).published


def current(spark, n, **changes):
    return current_status(silver(spark, [record(n, **changes)]), at("2024-03-02"))


def states(alerts):
    return sorted(
        (r.alert_type, r.alert_status, r.first_detected_at.minute, r.last_detected_at.minute, r.resolved_at is not None)
        for r in alerts.collect()
    )


def step(alerts, spark, n, **changes):
    seen = open_alerts(current(spark, n, **changes), at(f"2024-03-02 00:{n:02d}:00"))
    return cut_lineage(seen if alerts is None else alert_lifecycle(alerts, seen, at(f"2024-03-02 00:{n:02d}:00")))


def test_conditions_are_one_row_per_abnormal_metric(spark):
    found = current_alert_conditions(current(spark, 1, ph=5.0, dissolved_oxygen_mg_l=1.0, humidity_pct=90.0)).collect()
    assert {(r.alert_type, r.current_value, r.min_threshold, r.max_threshold, r.severity) for r in found} == {
        ("PH_LOW", 5.0, 5.9, 6.9, "HIGH"),
        ("DISSOLVED_OXYGEN_LOW", 1.0, 5.8, None, "HIGH"),
        ("HUMIDITY_HIGH", 90.0, 56.0, 74.0, "HIGH"),
    }
    forged = current(spark, 1).withColumn("do_status", F.lit("HIGH"))
    assert current_alert_conditions(forged).count() == 0


def test_episode_opens_refreshes_resolves_and_recurs(spark):
    alerts = step(None, spark, 1, ph=5.0)
    first_id = alerts.first().alert_id
    alerts = step(alerts, spark, 2, ph=5.2)
    assert states(alerts) == [("PH_LOW", "ACTIVE", 1, 2, False)]
    assert (alerts.first().alert_id, alerts.first().current_value) == (first_id, 5.2)
    alerts = step(alerts, spark, 3)
    assert states(alerts) == [("PH_LOW", "RESOLVED", 1, 2, True)]
    assert alerts.first().resolved_at == datetime(2024, 3, 2, 0, 3)
    alerts = step(alerts, spark, 4, ph=5.0)
    assert states(alerts) == [("PH_LOW", "ACTIVE", 4, 4, False), ("PH_LOW", "RESOLVED", 1, 2, True)]


def test_a_flip_closes_one_episode_and_opens_another(spark):
    alerts = step(step(None, spark, 1, ph=5.0), spark, 2, ph=8.0)
    assert states(alerts) == [("PH_HIGH", "ACTIVE", 2, 2, False), ("PH_LOW", "RESOLVED", 1, 1, True)]


def test_repeating_a_batch_changes_only_the_stamp(spark):
    once = step(None, spark, 1, ph=5.0, ec_ms_cm=2.5)
    twice = step(once, spark, 1, ph=5.0, ec_ms_cm=2.5)
    assert sorted(once.drop("gold_updated_at").collect(), key=str) == sorted(
        twice.drop("gold_updated_at").collect(), key=str
    )


def test_current_state_is_the_newest_reading_of_any_device(spark):
    rows = [record(1, device_id="D2"), record(2), record(3, device_id="D3", ph=5.0)]
    state = current_status(silver(spark, rows), at("2024-03-02")).collect()
    assert [(r.device_id, r.ph_status, r.last_reading_at) for r in state] == [("D3", "LOW", datetime(2024, 3, 1, 0, 3))]
    assert len(state[0]) == 49


def test_kpi_uses_the_local_day_and_charges_a_gap_to_the_later_event(spark):
    rows = [
        record(1, timestamp="2024-03-10T05:59:00+00:00"),
        record(5, timestamp="2024-03-10T06:01:00+00:00", ph=5.0, is_aerator_on=None),
        record(6, timestamp="2024-03-10T08:30:00+00:00"),
    ]
    kpi = {r.kpi_date: r for r in daily_kpi(silver(spark, rows), at("2024-03-11")).collect()}
    assert set(kpi) == {date(2024, 3, 9), date(2024, 3, 10)}
    later = kpi[date(2024, 3, 10)]
    assert (later.reading_count, later.anomaly_reading_count, later.missing_packet_count) == (2, 1, 3)
    assert (later.anomaly_rate_pct, later.health_score, later.packet_gap_rate_pct) == (50.0, 50.0, 60.0)
    assert later.aerator_runtime_pct == 100.0
    # The clocks went forward at 2 o'clock that day.
    assert later.last_reading_at == datetime(2024, 3, 10, 3, 30)
    assert len(later) == 31


def test_kpi_of_an_unreadable_time_has_no_date_unless_dropped(spark):
    published = silver(spark, [record(1, timestamp="garbage"), record(2)])
    assert daily_kpi(published, at("2024-03-02")).filter("kpi_date IS NULL").count() == 1
    assert daily_kpi(published, at("2024-03-02"), drop_null_date=True).filter("kpi_date IS NULL").count() == 0


@pytest.mark.parametrize("values, expected", [([6.5, 6.55], 6.53), ([1.0, 1.01], 1.01), ([0.1] * 3, 0.1)])
def test_average_on_a_rounding_edge_goes_up(spark, values, expected):
    rows = [record(i, ph=v) for i, v in enumerate(values)]
    assert daily_kpi(silver(spark, rows), at("2024-03-02")).first().avg_ph == expected


def test_validation_report_counts_each_failure(spark):
    good = silver(spark, [record(1), record(2, ph=5.0)])
    state, now = current_status(good, at("2024-03-02")), at("2024-03-02")
    alerts, kpi = open_alerts(state, now), daily_kpi(good, now)
    clean = {r.check_name: (r.failures, r.passed) for r in audit.validation_report(good, state, alerts, kpi).collect()}
    assert len(clean) == 8 and set(clean.values()) == {(0, True)}

    bad = audit.validation_report(
        good.unionAll(good),
        state.unionAll(state).withColumn("last_reading_at", F.lit("2020-01-01").cast("timestamp")),
        alerts.unionAll(alerts),
        kpi.unionAll(kpi).withColumns({"health_score": F.lit(None).cast("double"), "anomaly_rate_pct": F.lit(101.0)}),
    )
    assert {r.check_name: r.failures for r in bad.collect()} == {
        "Silver duplicate event IDs": 2,
        "Gold current duplicate keys": 1,
        "Gold active alert duplicates": 1,
        "Gold daily duplicate keys": 1,
        "Invalid health scores": 2,
        "Invalid anomaly rates": 2,
        "Gold freshness": 2,
        "OVERALL": 11,
    }


def test_null_comparison_is_fresh_and_null_rate_passes(spark):
    good = silver(spark, [record(1)])
    state = current_status(good, at("2024-03-02")).withColumn("last_reading_at", F.lit(None).cast("timestamp"))
    assert audit.stale(audit.freshness(state, good)).count() == 0
    kpi = daily_kpi(good, at("2024-03-02")).withColumn("anomaly_rate_pct", F.lit(None).cast("double"))
    assert kpi.filter(audit.bad_anomaly_rate()).count() == 0


def test_severity_can_be_sorted_by_weight(spark):
    rows = [("LOW", 1), ("HIGH", 2), ("MEDIUM", 3)]
    alerts = spark.createDataFrame(rows, "severity STRING, n INT").selectExpr(
        "severity", "string(n) AS alert_id", "'ACTIVE' AS alert_status", "'F' AS farm_id", "'Z' AS zone_id",
        "'c' AS crop_type", "'t' AS alert_type", "1D AS current_value", "1D AS min_threshold", "1D AS max_threshold",
        "TIMESTAMP '2024-01-01' AS first_detected_at", "TIMESTAMP '2024-01-01' AS last_detected_at",
    )
    assert [r.severity for r in listing.active_alerts(alerts).collect()] == ["MEDIUM", "LOW", "HIGH"]
    assert [r.severity for r in listing.active_alerts(alerts, by_rank=True).collect()] == ["HIGH", "MEDIUM", "LOW"]


def test_history_equals_one_merge_after_the_other(spark):
    # Two zones, ten batches: a condition that lasts, recurs, flips and is carried over silent batches.
    readings = {
        "Z1": {1: 5.0, 2: 5.2, 4: 6.5, 5: 8.0, 6: 5.0, 9: 5.1}, "Z2": {3: 6.5, 4: 8.1, 8: 8.2, 10: 8.3}, "Z3": {2: 5.0, 10: 6.5},
    }
    rows = [record(100 * z + n, zone_id=zone, device_id=zone, ph=ph)
            for z, (zone, phs) in enumerate(readings.items()) for n, ph in phs.items()]
    number = {r["event_id"]: n for r, n in zip(rows, [n for phs in readings.values() for n in phs])}
    held = [
        (zone, phs[n], n, min([m for m in phs if m > n], default=11) - 1) for zone, phs in readings.items() for n in phs
    ]
    batch_of = spark.createDataFrame(list(number.items()), "event_id string, n int")
    until = spark.createDataFrame([(z, n, to) for z, _, n, to in held], "zone_id string, n int, upto int")
    good = cut_lineage(
        silver(spark, rows, {"zone_id": "Z1"}, {"zone_id": "Z2"}, {"zone_id": "Z3"}).join(batch_of, "event_id").join(until, ["zone_id", "n"])
        .withColumn("last_reading_at", F.col("event_timestamp"))
    )

    def clock(n):
        return F.timestamp_add("DAY", n, at("2024-03-02"))

    merged = None
    for n in range(1, 11):
        seen = open_alerts(good.filter(f"n <= {n} AND upto >= {n}"), clock(F.lit(n)))
        merged = cut_lineage(seen if merged is None else alert_lifecycle(merged, seen, clock(F.lit(n))))
    told = episode_history(good, "n", "upto", 10, clock)
    assert merged.count() == 5 and told.columns == merged.columns
    assert sorted(map(str, told.collect())) == sorted(map(str, merged.collect()))


def test_history_of_nothing(spark):
    good = silver(spark, []).withColumns({"n": F.lit(1), "upto": F.lit(1), "last_reading_at": F.col("event_timestamp")})
    assert episode_history(good, "n", "upto", 0, lambda n: at("2024-03-02")).count() == 0
