"""The stages over catalog tables, in the order they run."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.config import ACTIVE, ALERT_KEY, EVENT_KEY, KPI_KEYS, OFFSET_KEYS, ZONE_KEYS
from fieldgauge.operators import merge
from fieldgauge.operators.alerts import alert_lifecycle, closed, open_alerts, refreshed
from fieldgauge.operators.audit import validation_report
from fieldgauge.operators.current import current_status
from fieldgauge.operators.enrich import MATCHED
from fieldgauge.operators.grouping import assert_unique
from fieldgauge.operators.kpi import daily_kpi
from fieldgauge.plans.silver import build_silver
from fieldgauge.session import cut_lineage
from fieldgauge.sources import tables as sinks
from fieldgauge.sources.parts import delete, names_in, read_text, write_text
from fieldgauge.sources.readers import read_path, read_reference_csv, table, table_exists

STATUS = "alert_status"


@dataclass(frozen=True)
class Lake:
    """Table names and the folder their files go to."""

    root: str
    master: str = "bronze_farm_crop_master"
    bronze: str = "bronze_iot_telemetry"
    silver: str = "silver_iot_enriched"
    invalid: str = "silver_invalid_records"
    current: str = "gold_current_status"
    alerts: str = "gold_alerts"
    kpi: str = "gold_daily_kpi"

    @property
    def names(self) -> tuple[str, ...]:
        return (self.bronze, self.master, self.silver, self.invalid, self.current, self.alerts, self.kpi)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def increments_path(lake: Lake) -> str:
    """Where incremental runs keep their ledger and what they remember (``streaming.state``)."""
    return f"{lake.root.rstrip('/')}/increments-{lake.silver}"


def processing_time(spark: SparkSession) -> Column:
    """The time now, as one constant for all jobs of a run."""
    return F.lit(spark.sql("SELECT string(current_timestamp())").first()[0]).cast("timestamp")


def load_reference(spark: SparkSession, lake: Lake, csv_path: str) -> None:
    sinks.overwrite_table(read_reference_csv(spark, csv_path), lake.master, lake.path(lake.master))


def insert_unseen(df: DataFrame, name: str, path: str, keys: Sequence[str]) -> None:
    """Insert-only merge of a staged frame into a table. A repeat after a failure adds only what is missing."""
    spark = df.sparkSession
    if sinks.create_if_absent(df, name, path):
        return
    if sinks.supports_merge(spark, name):
        sinks.merge_unseen_into(df, name, keys)
        return
    sinks.append_rows(merge.unseen_rows_late(table(spark, name), df, keys, cut_lineage), name)


def upsert(df: DataFrame, name: str, path: str, keys: Sequence[str], by: str | None = None) -> None:
    """Upsert into a table; doubled source keys that match a row are an error.

    ``by``, one of the keys, partitions a new Parquet table; of such a table only the partitions that
    ``df`` (a staged frame) touches are read and replaced. A repeat after a failure changes nothing
    but what was not switched; rows with a NULL key are inserted again.
    """
    spark = df.sparkSession
    if not table_exists(spark, name):
        if by is None:
            sinks.publish_snapshot(df, name, path)
        else:
            sinks.create_partitioned(spark, df.schema, name, path, by)
            sinks.publish_partitions(df, name, path, by)
        return
    if sinks.supports_merge(spark, name):
        sinks.merge_upsert_into(df, name, keys)
        return
    target = table(spark, name)
    if by not in sinks.partition_columns(spark, name):
        merge.assert_single_match(target, df, keys)
        sinks.publish_snapshot(merge.merge_upsert(target, df, keys), name, path)
        return
    touched = [r[0] for r in df.select(by).distinct().collect()]
    met = F.col(by).isin([v for v in touched if v is not None])
    target = target.filter(met | F.col(by).isNull() if None in touched else met)
    merge.assert_single_match(target, df, keys)
    sinks.publish_partitions(merge.merge_upsert(target, df, keys), name, path, by)


def unpublished(spark: SparkSession, lake: Lake, graded: DataFrame) -> DataFrame:
    """Graded rows without those that silver holds already, which a recompute would only write to drop them again.

    Rows of unknown zones stay for quarantine, whatever silver holds; NULL ids match nothing. Graded rows lie
    partitioned by their id, so only the ids of silver are shuffled.
    """
    if not table_exists(spark, lake.silver):
        return graded
    known = table(spark, lake.silver).select(*EVENT_KEY).distinct().withColumn("_known", F.lit(True))
    marked = graded.join(known, list(EVENT_KEY), "left")
    return marked.filter(F.col("_known").isNull() | ~F.col(MATCHED)).select(*graded.columns)


def run_silver(spark: SparkSession, lake: Lake, now: Column | None = None, strict: bool = False) -> None:
    """Recompute silver from all raw rows and insert what is new.

    What incremental runs remember does not know of these rows and is dropped; the next increment reads
    the tables once to remember them again.
    """
    now = processing_time(spark) if now is None else now
    stage = lambda graded: cut_lineage(unpublished(spark, lake, graded))
    built = build_silver(table(spark, lake.bronze), table(spark, lake.master), now, stage, strict)
    delete(spark, increments_path(lake))
    insert_unseen(built.published, lake.silver, lake.path(lake.silver), EVENT_KEY)
    insert_unseen(cut_lineage(built.quarantined), lake.invalid, lake.path(lake.invalid), OFFSET_KEYS)


def run_current(spark: SparkSession, lake: Lake, now: Column | None = None) -> None:
    now = processing_time(spark) if now is None else now
    state = cut_lineage(current_status(table(spark, lake.silver), now))
    upsert(state, lake.current, lake.path(lake.current), ZONE_KEYS)


def run_alerts(spark: SparkSession, lake: Lake, now: Column | None = None) -> None:
    now = processing_time(spark) if now is None else now
    sightings = cut_lineage(open_alerts(table(spark, lake.current), now))
    assert_unique(sightings, [ALERT_KEY], "the current alert conditions")
    merge_alerts(spark, lake, sightings, now)


def merge_alerts(spark: SparkSession, lake: Lake, sightings: DataFrame, now: Column) -> None:
    """Merge staged sightings into the episodes.

    On Parquet open episodes are a partition that each run replaces, and resolved ones another that
    runs only add to. What a run has decided is written down before either changes; a run that ends
    between the two is ended by the next one, so that no episode is lost or resolved twice.
    """
    if not table_exists(spark, lake.alerts):
        sinks.create_partitioned(spark, sightings.schema, lake.alerts, lake.path(lake.alerts), STATUS)
    if sinks.supports_merge(spark, lake.alerts):
        sinks.merge_episodes_into(
            sightings, lake.alerts, ALERT_KEY, STATUS, ACTIVE, refreshed(now), closed(now)
        )
        return
    if STATUS not in sinks.partition_columns(spark, lake.alerts):
        merged = alert_lifecycle(table(spark, lake.alerts), sightings, now)
        sinks.publish_snapshot(merged, lake.alerts, lake.path(lake.alerts))
        return
    base, run = lake.path(lake.alerts), uuid.uuid4().hex
    if sinks.PENDING in names_in(spark, base):
        switch_episodes(spark, lake, repeated=True)
    still_open = table(spark, lake.alerts).filter(F.col(STATUS) == ACTIVE)
    merged = cut_lineage(alert_lifecycle(still_open, sightings, now))
    merged.filter(F.col(STATUS) == ACTIVE).drop(STATUS).write.parquet(f"{base}/open-{run}")
    merged.filter(F.col(STATUS) != ACTIVE).write.parquet(f"{base}/closed-{run}")
    write_text(spark, f"{base}/{sinks.PENDING}", json.dumps({"run": run}))
    switch_episodes(spark, lake)


def switch_episodes(spark: SparkSession, lake: Lake, repeated: bool = False) -> None:
    """Put in force what a run has decided. A repeat looks up which resolved episodes are there already."""
    base = lake.path(lake.alerts)
    run = json.loads(read_text(spark, f"{base}/{sinks.PENDING}"))["run"]
    ended = read_path(spark, f"{base}/closed-{run}")
    if repeated:
        spark.catalog.refreshTable(lake.alerts)
        there = table(spark, lake.alerts).filter(F.col(STATUS) != ACTIVE).alias("there")
        same = [F.col(f"ended.{c}").eqNullSafe(F.col(f"there.{c}")) for c in ("alert_id", "resolved_at")]
        ended = cut_lineage(ended.alias("ended").join(there, same, "left_anti"))
    sinks.append_rows(ended, lake.alerts)
    sinks.point_partitions(spark, lake.alerts, {f"{STATUS}={ACTIVE}": f"{base}/open-{run}"})
    delete(spark, f"{base}/{sinks.PENDING}")


def run_kpi(spark: SparkSession, lake: Lake, now: Column | None = None, drop_null_date: bool = False) -> None:
    now = processing_time(spark) if now is None else now
    days = cut_lineage(daily_kpi(table(spark, lake.silver), now, drop_null_date))
    upsert(days, lake.kpi, lake.path(lake.kpi), KPI_KEYS, by=KPI_KEYS[0])


def run_all(spark: SparkSession, lake: Lake, now: Column | None = None) -> None:
    """Silver, current state, alerts, KPIs: each only if the one before succeeded."""
    now = processing_time(spark) if now is None else now
    run_silver(spark, lake, now)
    run_current(spark, lake, now)
    run_alerts(spark, lake, now)
    run_kpi(spark, lake, now)


def validate_lake(spark: SparkSession, lake: Lake) -> DataFrame:
    return validation_report(*[table(spark, n) for n in (lake.silver, lake.current, lake.alerts, lake.kpi)])


def existing_tables(spark: SparkSession, lake: Lake) -> dict[str, bool]:
    return {name: table_exists(spark, name) for name in lake.names}
