from pyspark.sql import functions as F
from tests.data import at, bronze, master, record
from tests.test_stages import ZONES

from fieldgauge.operators.enrich import MATCHED
from fieldgauge.plans import stages
from fieldgauge.plans.stages import increments_path, run_silver
from fieldgauge.sources import tables as sinks
from fieldgauge.sources.parts import names_in
from fieldgauge.sources.readers import table
from fieldgauge.streaming import incremental


def test_a_second_recompute_stages_no_published_row(spark, lake, monkeypatch):
    sinks.publish_snapshot(master(spark, *ZONES), lake.master, lake.path(lake.master))
    rows = [record(n) for n in range(12)] + [record(20, zone_id="nowhere")]
    sinks.create_if_absent(bronze(spark, rows), lake.bronze, lake.path(lake.bronze))
    staged = []

    def counted(df, real=stages.cut_lineage):
        kept = real(df)
        if MATCHED in kept.columns:
            staged.append(sorted(r[0] for r in kept.select("event_id").collect()))
        return kept

    monkeypatch.setattr(stages, "cut_lineage", counted)
    run_silver(spark, lake, at("2024-04-01"))
    sinks.append_rows(bronze(spark, [record(30)]), lake.bronze)
    run_silver(spark, lake, at("2024-04-02"))
    assert len(staged[0]) == 13 and staged[1] == ["E20", "E30"]
    assert table(spark, lake.silver).count() == 13 and table(spark, lake.invalid).count() == 1


def test_a_slice_stages_its_graded_rows_once(spark, lake, monkeypatch):
    sinks.publish_snapshot(master(spark, *ZONES), lake.master, lake.path(lake.master))
    wide = []

    def counted(df, real=incremental.cut_lineage):
        wide.append(len(df.columns))
        return real(df)

    monkeypatch.setattr(incremental, "cut_lineage", counted)
    for step, rows in enumerate((range(10), range(5, 15))):  # half of the second slice is known
        incremental.silver_increment(spark, lake, bronze(spark, [record(n) for n in rows]), at("2024-04-01"))
        assert len(wide) == step + 1  # the arrived rows alone
    for folder in names_in(spark, f"{increments_path(lake)}/rows"):
        assert names_in(spark, f"{increments_path(lake)}/rows/{folder}") == ["graded", "offsets", "rejects"]
    ids = table(spark, lake.silver).agg(F.count("*"), F.countDistinct("event_id")).first()
    assert tuple(ids) == (15, 15)
