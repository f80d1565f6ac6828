"""Gold tables in partitions: KPIs by day, episodes by status; runs that end in between."""

import datetime

import pytest
from pyspark.sql import functions as F

from tests.data import at
from fieldgauge.operators.alerts import alert_identity, alert_lifecycle
from fieldgauge.plans import stages
from fieldgauge.plans.stages import merge_alerts, upsert
from fieldgauge.session import cut_lineage
from fieldgauge.sources import tables as sinks
from fieldgauge.sources.readers import table
from fieldgauge.sources.schemas import ALERT_COLUMNS, ALERT_DIMENSIONS

DAYS = "day DATE, zone STRING, v INT"
KEYS = ["day", "zone"]


def day(n):
    return None if n is None else datetime.date(2024, 3, n)


def days(spark, *rows):
    return spark.createDataFrame([(day(n), z, v) for n, z, v in rows], DAYS)


def rows_of(spark, name):
    return sorted(((r.day.day if r.day else None, r.zone, r.v) for r in table(spark, name).collect()), key=str)


def files_of(spark, name, where):
    return set(table(spark, name).filter(where).select(F.input_file_name()).distinct().toPandas().iloc[:, 0])


def test_upsert_replaces_only_the_days_it_touches(spark, lake):
    base, name = lake.path("kpi"), lake.kpi
    upsert(days(spark, (1, "a", 1), (2, "a", 2), (2, "b", 3), (3, "a", 4)), name, base, KEYS, by="day")
    before = files_of(spark, name, "day <> DATE'2024-03-02'")
    upsert(days(spark, (2, "a", 20), (4, "a", 5)), name, base, KEYS, by="day")
    assert rows_of(spark, name) == [(1, "a", 1), (2, "a", 20), (2, "b", 3), (3, "a", 4), (4, "a", 5)]
    assert files_of(spark, name, "day IN (DATE'2024-03-01', DATE'2024-03-03')") == before
    assert files_of(spark, name, "day = DATE'2024-03-02'").isdisjoint(before)
    with pytest.raises(ValueError, match="several source rows"):
        upsert(days(spark, (3, "a", 1), (3, "a", 2)), name, base, KEYS, by="day")


def test_upsert_of_undated_rows_and_of_none(spark, lake):
    base, name = lake.path("kpi"), lake.kpi
    upsert(days(spark, (None, "a", 1), (1, "a", 1)), name, base, KEYS, by="day")
    upsert(days(spark, (None, "a", 2)), name, base, KEYS, by="day")
    upsert(days(spark), name, base, KEYS, by="day")
    assert rows_of(spark, name) == [(1, "a", 1), (None, "a", 1), (None, "a", 2)]


def test_upsert_that_ends_between_two_days_is_repeated(spark, lake, monkeypatch):
    base, name = lake.path("kpi"), lake.kpi
    upsert(days(spark, (1, "a", 1), (2, "a", 2), (3, "a", 3)), name, base, KEYS, by="day")
    change = days(spark, (1, "a", 10), (2, "a", 20), (4, "a", 40))
    point = sinks.point_partitions

    def fails_after_one(spark, name, folders):
        point(spark, name, dict(list(folders.items())[:1]))
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(sinks, "point_partitions", fails_after_one)
        with pytest.raises(RuntimeError):
            upsert(change, name, base, KEYS, by="day")
    assert len(rows_of(spark, name)) == 3
    upsert(change, name, base, KEYS, by="day")
    assert rows_of(spark, name) == [(1, "a", 10), (2, "a", 20), (3, "a", 3), (4, "a", 40)]
    assert sinks.drop_superseded(spark, name, base) >= 1
    assert rows_of(spark, name) == [(1, "a", 10), (2, "a", 20), (3, "a", 3), (4, "a", 40)]


def test_partition_values_are_quoted(spark, lake):
    base, name = lake.path("t"), lake.kpi
    odd = spark.createDataFrame([(1, "it's"), (2, "a/b=c"), (3, "50%"), (4, "back\\slash")], "v INT, k STRING")
    for _ in range(2):
        upsert(odd, name, base, ["k"], by="k")
    assert sorted((r.v, r.k) for r in table(spark, name).collect()) == sorted((r.v, r.k) for r in odd.collect())


def sightings(spark, run, zones):
    """One open alert for each zone, seen in run number ``run``."""
    found = spark.createDataFrame([(z, float(run)) for z in zones], "zone_id STRING, current_value DOUBLE").select(
        *[F.lit(c).alias(c) if c != "zone_id" else F.col(c) for c in ALERT_DIMENSIONS],
        F.lit("MEDIUM").alias("severity"), at(f"2024-04-{run:02d}").alias("detected_at"), F.lit("PH_LOW").alias("alert_type"),
        "current_value", F.lit(1.0).alias("min_threshold"), F.lit(2.0).alias("max_threshold"), F.lit("LOW").alias("metric_status"),
    )
    return cut_lineage(alert_identity(found, at(f"2024-04-{run:02d} 01:00:00")).select(*ALERT_COLUMNS))


RUNS = [(1, ["Z1", "Z2"]), (2, ["Z2", "Z3"]), (3, ["Z1"]), (4, []), (5, ["Z1", "Z2"])]


def episodes(frame):
    return sorted((tuple(r) for r in frame.select(*sorted(frame.columns)).collect()), key=str)


def expected(spark):
    target = None
    for run, zones in RUNS:
        seen = sightings(spark, run, zones)
        now = at(f"2024-04-{run:02d} 01:00:00")
        target = seen if target is None else cut_lineage(alert_lifecycle(target, seen, now))
    return episodes(target)


def test_episodes_in_two_parts_equal_whole_merges(spark, lake):
    written = set()
    for run, zones in RUNS:
        merge_alerts(spark, lake, sightings(spark, run, zones), at(f"2024-04-{run:02d} 01:00:00"))
        now = files_of(spark, lake.alerts, "alert_status = 'RESOLVED'")
        assert written <= now, "resolved episodes were written again"
        written = now
    assert episodes(table(spark, lake.alerts)) == expected(spark)
    assert sinks.drop_superseded(spark, lake.alerts, lake.path(lake.alerts)) > 0
    assert episodes(table(spark, lake.alerts)) == expected(spark)


@pytest.mark.parametrize("step", ["append_rows", "point_partitions", "delete"])
def test_a_run_that_ends_between_the_parts_is_ended_by_the_next(spark, lake, monkeypatch, step):
    for run, zones in RUNS:
        seen, now = sightings(spark, run, zones), at(f"2024-04-{run:02d} 01:00:00")
        if run in (2, 3):
            with monkeypatch.context() as patched:
                def fails(*_, **__):
                    raise RuntimeError("lost")

                patched.setattr(stages if step == "delete" else sinks, step, fails)
                with pytest.raises(RuntimeError, match="lost"):
                    merge_alerts(spark, lake, seen, now)
        if run in (2, 3):
            with pytest.raises(RuntimeError, match="has not ended"):
                sinks.drop_superseded(spark, lake.alerts, lake.path(lake.alerts))
        merge_alerts(spark, lake, seen, now)
    assert episodes(table(spark, lake.alerts)) == expected(spark)
