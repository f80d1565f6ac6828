import random
from datetime import timedelta

from pyspark.sql import functions as F
from tests.data import START, at, bronze, master, record

from fieldgauge.checks.fixtures import envelope
from fieldgauge.operators.current import current_status
from fieldgauge.operators.kpi import daily_kpi
from fieldgauge.plans.stages import run_all, run_kpi, run_silver, validate_lake
from fieldgauge.session import scratch_path
from fieldgauge.sources import tables as sinks
from fieldgauge.sources.readers import read_event_stream, read_path, table
from fieldgauge.streaming.incremental import run_increment, silver_handler, silver_increment
from fieldgauge.streaming.ingest import for_each_run, ingest, rows_read

ZONES = ({}, {"zone_id": "Z2", "timezone": "America/New_York"})


def telemetry(seed: int, n: int = 120) -> list[dict]:
    """Records with losses, doubles, late arrivals, rejects and an unknown zone."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rng.random() < 0.1:
            continue
        at_ = START + timedelta(minutes=37 * i)
        changes = {
            "zone_id": rng.choice(["Z1", "Z2", "Z9"]), "device_id": rng.choice(["D1", "D2"]),
            "timestamp": at_.isoformat() + "+00:00", "eventhub_enqueued_time": at_,
            "ph": rng.choice([6.5, 6.5, 5.0, 99.0, None]), "humidity_pct": rng.choice([60.0, 60.0, 60.0, None]),
        }
        rows.append(record(i, **changes))
        if rng.random() < 0.2:
            late = at_ + timedelta(minutes=rng.choice([1, 300]))
            rows.append(record(i, **{**changes, "ph": 6.4, "eventhub_offset": 1000 + i, "eventhub_enqueued_time": late}))
    return sorted(rows, key=lambda r: (r["eventhub_enqueued_time"], r["eventhub_offset"]))


def start(spark, lake, rows, *zones):
    sinks.publish_snapshot(master(spark, *zones), lake.master, lake.path(lake.master))
    sinks.publish_snapshot(bronze(spark, rows), lake.bronze, lake.path(lake.bronze))


def content(spark, name, *without):
    df = table(spark, name).drop(*without)
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_second_run_changes_nothing(spark, lake):
    start(spark, lake, telemetry(1), *ZONES)
    run_all(spark, lake, at("2024-04-01"))
    names = (lake.silver, lake.invalid, lake.current, lake.alerts, lake.kpi)
    before = {n: content(spark, n) for n in names}
    run_all(spark, lake, at("2024-04-01"))
    assert {n: content(spark, n) for n in names} == before
    report = {r.check_name: r.passed for r in validate_lake(spark, lake).collect()}
    assert all(report.values()) and report["OVERALL"]


def test_kpi_merge_refuses_a_zone_that_changed_during_the_day(spark, lake):
    import pytest

    start(spark, lake, [record(1)], {})
    run_silver(spark, lake, at("2024-04-01"))
    run_kpi(spark, lake, at("2024-04-01"))
    start(spark, lake, [record(1), record(2)], {"crop_type": "Mint"})
    run_silver(spark, lake, at("2024-04-01"))
    with pytest.raises(ValueError, match="F1"):
        run_kpi(spark, lake, at("2024-04-01"))


def test_increments_equal_full_recompute_after_each_slice(spark, lake, tmp_path):
    """A zone's reference data arrives after the first two slices."""
    import uuid
    from dataclasses import replace

    tag = uuid.uuid4().hex
    full = replace(lake, **{f: f"{f}_full_{tag}" for f in ("master", "bronze", "silver", "invalid")})
    rows = telemetry(2)
    cuts = [0, 30, 31, 80, len(rows)]
    for step, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        zones = ZONES if step < 2 else (*ZONES, {"zone_id": "Z9", "timezone": "America/Denver"})
        now = at(f"2024-04-0{step + 1}")
        start(spark, full, rows[:hi], *zones)
        run_silver(spark, full, now)
        sinks.publish_snapshot(master(spark, *zones), lake.master, lake.path(lake.master))
        silver_increment(spark, lake, bronze(spark, rows[lo:hi]), now)
        assert content(spark, lake.silver) == content(spark, full.silver), f"silver after slice {step}"
        assert content(spark, lake.invalid) == content(spark, full.invalid), f"quarantine after slice {step}"


def test_repeated_slice_adds_nothing(spark, lake):
    rows = telemetry(3, 60)
    sinks.publish_snapshot(master(spark, *ZONES), lake.master, lake.path(lake.master))
    silver_increment(spark, lake, bronze(spark, rows[:30]), at("2024-04-01"))
    silver_increment(spark, lake, bronze(spark, rows[30:]), at("2024-04-01"))
    before = content(spark, lake.silver), content(spark, lake.invalid)
    silver_increment(spark, lake, bronze(spark, rows[30:]), at("2024-04-01"))
    assert (content(spark, lake.silver), content(spark, lake.invalid)) == before


def test_touched_zones_and_days_equal_all_of_them(spark, lake):
    rows = telemetry(4, 150)
    sinks.publish_snapshot(master(spark, *ZONES), lake.master, lake.path(lake.master))
    parts = (rows[:70], rows[70:100], rows[100:])
    for step, part in enumerate(parts):
        run_increment(spark, lake, bronze(spark, part), at(f"2024-04-0{step + 1}"))
        silver = table(spark, lake.silver)
        for name, fresh in [
            (lake.kpi, daily_kpi(silver, at("2024-04-01"))),
            (lake.current, current_status(silver, at("2024-04-01"))),
        ]:
            fresh = fresh.drop("gold_updated_at")
            expected = sorted((tuple(r) for r in fresh.select(*sorted(fresh.columns)).collect()), key=str)
            assert content(spark, name, "gold_updated_at") == expected, f"{name} after slice {step}"
    report = {r.check_name: r.passed for r in validate_lake(spark, lake).collect()}
    assert report["OVERALL"]


def test_gold_makes_up_for_a_stage_that_failed(spark, lake):
    rows = telemetry(6, 90)
    sinks.publish_snapshot(master(spark, *ZONES), lake.master, lake.path(lake.master))
    run_increment(spark, lake, bronze(spark, rows[:40]), at("2024-04-01"))
    # The second slice reaches silver, and the run ends there.
    silver_increment(spark, lake, bronze(spark, rows[40:60]), at("2024-04-02"))
    run_increment(spark, lake, bronze(spark, rows[60:]), at("2024-04-03"))
    everything = daily_kpi(table(spark, lake.silver), at("2024-04-01")).drop("gold_updated_at")
    expected = sorted((tuple(r) for r in everything.select(*sorted(everything.columns)).collect()), key=str)
    assert content(spark, lake.kpi, "gold_updated_at") == expected


def test_stream_reads_each_event_once_and_feeds_silver(spark, lake, tmp_path):
    source, raw, checkpoint = (scratch_path(spark, n) for n in ("events", "raw", "progress"))
    rows = bronze(spark, telemetry(5, 80))
    sinks.publish_snapshot(master(spark, *ZONES), lake.master, lake.path(lake.master))
    seen = []
    for part in (rows.filter("eventhub_offset < 40"), rows.filter("eventhub_offset >= 40"), None):
        if part is not None:
            envelope(part).write.mode("append").parquet(source)
        query = ingest(read_event_stream(spark, "parquet", path=source), raw, checkpoint, at("2024-04-01"))
        seen.append(rows_read(query))
        stream = spark.readStream.schema(read_path(spark, raw).schema).parquet(raw)
        for_each_run(stream, f"{checkpoint}-silver", silver_handler(lake, at("2024-04-01")), lake.names)
    assert seen == [rows.filter("eventhub_offset < 40").count(), rows.filter("eventhub_offset >= 40").count(), 0]
    ids = table(spark, lake.silver).select("event_id")
    assert ids.count() == ids.distinct().count() > 0
    in_raw = read_path(spark, raw).filter(F.col("zone_id") != "Z9").filter("ph <= 14 AND humidity_pct IS NOT NULL")
    assert ids.count() == in_raw.select("event_id").distinct().count()


def test_readings_without_a_time_keep_their_day_in_increments(spark, lake):
    rows = [*telemetry(7, 60), record(500, timestamp="garbage")]
    sinks.publish_snapshot(master(spark, *ZONES), lake.master, lake.path(lake.master))
    run_increment(spark, lake, bronze(spark, rows[:15]), at("2024-04-01"))
    run_increment(spark, lake, bronze(spark, rows[15:]), at("2024-04-02"))
    everything = daily_kpi(table(spark, lake.silver), at("2024-04-01")).drop("gold_updated_at")
    expected = sorted((tuple(r) for r in everything.select(*sorted(everything.columns)).collect()), key=str)
    assert content(spark, lake.kpi, "gold_updated_at") == expected
    assert table(spark, lake.silver).filter("event_timestamp IS NULL").count() == table(spark, lake.kpi).filter(
        "kpi_date IS NULL").first()["reading_count"] == 1


def test_all_batches_are_counted_whatever_a_session_keeps(spark):
    source, raw, checkpoint = (scratch_path(spark, n) for n in ("events", "raw", "progress"))
    rows = bronze(spark, telemetry(8, 60))
    envelope(rows).repartition(9).write.parquet(source)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        arriving = read_event_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, path=source)
        run = ingest(arriving, raw, checkpoint, at("2024-04-01"))
        assert spark.conf.get("spark.sql.streaming.numRecentProgressUpdates") == "3"
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert rows_read(run) == rows.count() and len(run.rows_by_batch) >= 9


def test_a_zone_that_appears_late_is_published(spark, lake):
    sinks.publish_snapshot(master(spark, *ZONES), lake.master, lake.path(lake.master))
    early = [record(i, zone_id="Z1") for i in range(100, 120)]
    late = [record(i, zone_id="Z2", device_id="D2") for i in range(5)]  # older readings than those of Z1
    for step, part in enumerate((early, late, [record(130, zone_id="Z1")])):
        run_increment(spark, lake, bronze(spark, part), at(f"2024-04-0{step + 1}"))
        fresh = current_status(table(spark, lake.silver), at("2024-04-01")).drop("gold_updated_at")
        expected = sorted((tuple(r) for r in fresh.select(*sorted(fresh.columns)).collect()), key=str)
        assert content(spark, lake.current, "gold_updated_at") == expected
