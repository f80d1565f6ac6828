"""Incremental runs: what a slice opens, repeats after failures, and the states they keep."""

import glob
import random

import pytest
from pyspark.sql import functions as F
from tests.data import at, bronze, master, record
from tests.test_stages import ZONES, content, telemetry

from fieldgauge.operators.current import current_status
from fieldgauge.operators.kpi import daily_kpi
from fieldgauge.operators.runs import CHUNK_BITS, as_runs, mark_members, merge_runs
from fieldgauge.plans.stages import increments_path, run_all, run_current, run_kpi, run_silver
from fieldgauge.session import scratch_path
from fieldgauge.sources import tables as sinks
from fieldgauge.sources.parts import PART, Parts
from fieldgauge.sources.readers import table
from fieldgauge.streaming import state as states
from fieldgauge.streaming.incremental import run_increment, silver_increment


def assert_gold_is_whole(spark, lake):
    silver = table(spark, lake.silver)
    for name, fresh in [(lake.kpi, daily_kpi(silver, at("2024-04-01"))), (lake.current, current_status(silver, at("2024-04-01")))]:
        fresh = fresh.drop("gold_updated_at")
        expected = sorted((tuple(r) for r in fresh.select(*sorted(fresh.columns)).collect()), key=str)
        assert content(spark, name, "gold_updated_at") == expected, name


def break_files(*folders):
    """Overwrite data files: a job that opens one of them fails."""
    files = [f for folder in folders for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)]
    for file in files:
        with open(file, "wb") as out:
            out.write(b"broken")
        crc = file.rsplit("/", 1)
        for old in glob.glob(f"{crc[0]}/.{crc[1]}.crc"):
            open(old, "wb").close()
    return len(files)


def test_a_slice_opens_neither_silver_nor_untouched_parts(spark, lake):
    sinks.publish_snapshot(master(spark, *ZONES), lake.master, lake.path(lake.master))
    early = [record(i) for i in range(0, 40)]
    run_increment(spark, lake, bronze(spark, early), at("2024-04-01"))
    # A day later, numbers in another block, offsets in another block.
    later = [
        record(i, timestamp=f"2024-03-09T00:{i % 60:02d}:00+00:00", seq_num=10**6 + i, eventhub_offset=10**8 + i)
        for i in range(100, 120)
    ]
    base = increments_path(lake)
    parts = [Parts(spark, f"{base}/{n}", s).held() for n, s in (("ids", "event_id STRING"), ("runs", "lo LONG"), ("offsets", "lo LONG"))]
    assert all(len(p) == 1 for p in parts)
    assert break_files(lake.path(lake.silver), lake.path(lake.invalid), *[f for p in parts for f in p.values()]) >= 4
    run_increment(spark, lake, bronze(spark, later), at("2024-04-02"))
    first = table(spark, lake.kpi).filter("kpi_date = '2024-03-08'").first()
    # The gap to the early block is known from its highest number.
    assert first["reading_count"] == 20 and first["missing_packet_count"] == 10**6 + 100 - 39 - 1
    held = Parts(spark, f"{base}/ids", "event_id STRING").held()
    assert set(held) == {"2024-03-01", "2024-03-09"}
    with pytest.raises(Exception):
        table(spark, lake.silver).count()


class Crash(Exception):
    pass


@pytest.mark.parametrize("where", ["entered", "appended", "runs", "gold"])
def test_a_run_that_fails_anywhere_is_made_up_for(spark, lake, monkeypatch, where):
    rows = telemetry(11, 90)
    sinks.publish_snapshot(master(spark, *ZONES), lake.master, lake.path(lake.master))
    run_increment(spark, lake, bronze(spark, rows[:40]), at("2024-04-01"))

    def fail(*_, **__):
        raise Crash

    with monkeypatch.context() as broken:
        if where == "entered":
            broken.setattr(states.LakeState, "apply", fail)
        elif where == "appended":  # silver has the rows, nothing says so
            broken.setattr(states, "write_text", lambda spark, path, text, real=states.write_text: fail() if path.endswith("published") else real(spark, path, text))
        elif where == "runs":
            broken.setattr(states.LakeState, "_add_offsets", fail)
        else:
            broken.setattr("fieldgauge.streaming.incremental.upsert", fail)
        with pytest.raises(Crash):
            run_increment(spark, lake, bronze(spark, rows[40:60]), at("2024-04-02"))
    run_increment(spark, lake, bronze(spark, rows[40:60]), at("2024-04-02"))  # the source delivers it again
    run_increment(spark, lake, bronze(spark, rows[60:]), at("2024-04-03"))
    assert_gold_is_whole(spark, lake)
    ids = [r[0] for r in table(spark, lake.silver).select("event_id").collect()]
    offsets = [tuple(r) for r in table(spark, lake.invalid).select("eventhub_partition", "eventhub_offset").collect()]
    assert len(ids) == len(set(ids)) and len(offsets) == len(set(offsets))


def test_clock_that_runs_backwards(spark, lake):
    rows = telemetry(12, 90)
    sinks.publish_snapshot(master(spark, *ZONES), lake.master, lake.path(lake.master))
    for part, now in ((rows[:40], "2024-04-05"), (rows[40:60], "2024-04-01"), (rows[60:], "2024-03-01")):
        run_increment(spark, lake, bronze(spark, part), at(now))
        assert_gold_is_whole(spark, lake)


def test_null_day_in_every_slice(spark, lake):
    sinks.publish_snapshot(master(spark, *ZONES), lake.master, lake.path(lake.master))
    for step in range(3):
        rows = [record(10 * step + i, **({"timestamp": "garbage"} if i < 2 else {})) for i in range(5)]
        run_increment(spark, lake, bronze(spark, rows), at(f"2024-04-0{step + 1}"))
    undated = table(spark, lake.kpi).filter("kpi_date IS NULL").orderBy("reading_count").collect()
    assert [r["reading_count"] for r in undated] == [2, 4, 6]
    assert table(spark, lake.kpi).filter("kpi_date IS NOT NULL").agg(F.sum("reading_count")).first()[0] == 9


def test_increments_after_full_runs_and_before(spark, lake):
    """States are read from the tables once if a full run built them."""
    rows = telemetry(13, 120)
    sinks.publish_snapshot(master(spark, *ZONES), lake.master, lake.path(lake.master))
    sinks.publish_snapshot(bronze(spark, rows[:50]), lake.bronze, lake.path(lake.bronze))
    run_all(spark, lake, at("2024-04-01"))
    run_increment(spark, lake, bronze(spark, rows[40:80]), at("2024-04-02"))
    assert_gold_is_whole(spark, lake)
    sinks.publish_snapshot(bronze(spark, rows[:100]), lake.bronze, lake.path(lake.bronze))
    for stage in (run_silver, run_current, run_kpi):
        stage(spark, lake, at("2024-04-03"))
    run_increment(spark, lake, bronze(spark, rows[90:]), at("2024-04-04"))
    assert_gold_is_whole(spark, lake)
    ids = table(spark, lake.silver).select("event_id")
    assert ids.count() == ids.distinct().count()


def test_runs_equal_brute_force(spark):
    r = random.Random(14)
    edge = 1 << CHUNK_BITS
    numbers = sorted({r.choice([0, edge, 5 * edge]) + r.randrange(-60, 60) for _ in range(150)})
    df = spark.createDataFrame([("a", n) for n in numbers] + [("b", 7), ("b", None), (None, 7)], "k string, n long")
    halves = [merge_runs(as_runs(df.filter(F.pmod("n", F.lit(2)) == k), ["k"], "n"), ["k"]) for k in (0, 1)]
    merged = merge_runs(halves[0].unionByName(halves[1]), ["k"])
    found = sorted((x["lo"], x["hi"]) for x in merged.filter("k = 'a'").collect())
    assert [n for lo, hi in found for n in range(lo, hi + 1)] == numbers
    want = sum(1 for n in numbers if n - 1 not in numbers or n % edge == 0)
    assert len(found) == want
    asked = spark.createDataFrame([("a", n) for n in range(-70, edge + 70)] + [(None, 7), ("b", None)], "k string, n long")
    marked = {(x["k"], x["n"]): x["s"] for x in mark_members(asked, merged, ["k"], "n", "s").collect()}
    starts = {n: lo for lo, hi in found for n in range(lo, hi + 1)}
    assert marked == {**{("a", n): starts.get(n) for n in range(-70, edge + 70)}, (None, 7): None, ("b", None): None}


def test_bloom_filters_hold_every_id_and_little_else(spark):
    ids = spark.range(20_000).select(F.concat(F.lit("E"), F.col("id")).alias("event_id"), (F.col("id") % 2).cast("string").alias(PART))
    sizes = {"0": 5, "1": 4}
    blooms = states.bloom_filters(ids, sizes)
    hits = states.bloom_hits(ids.select("event_id"), blooms, sizes)
    assert hits.join(ids, ["event_id", PART]).count() == 20_000
    others = spark.range(20_000).select(F.concat(F.lit("X"), F.col("id")).alias("event_id"))
    assert states.bloom_hits(others, blooms, sizes).count() < 400


def test_parts_leave_others_alone(spark):
    parts = Parts(spark, scratch_path(spark, "parts"), "n LONG")
    rows = lambda *pairs: spark.createDataFrame(list(pairs), f"n long, {PART} string")
    assert parts.manifest() is None and parts.read().count() == 0
    parts.replace(rows((1, "a"), (2, "b")), 1)
    before = dict(parts.held())
    parts.replace(rows((3, "b"), (4, "c")), 2)
    again = Parts(spark, parts.base, "n LONG")
    assert again.applied() == 2 and again.held()["a"] == before["a"] and again.held()["b"] != before["b"]
    assert sorted((r["n"], r[PART]) for r in again.read().collect()) == [(1, "a"), (3, "b"), (4, "c")]
    assert [r["n"] for r in again.read(["c", "x"]).collect()] == [4]
    again.publish({}, 3, emptied=["a"])
    again.forget()
    assert sorted(r["n"] for r in Parts(spark, parts.base, "n LONG").read().collect()) == [3, 4]
    with pytest.raises(FileExistsError):  # another run was first
        parts.publish({}, 3)
