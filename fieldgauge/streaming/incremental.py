"""Silver and gold from new raw rows only, with the result a full recompute would publish.

Each run of ``silver_increment`` takes one slice of the raw table:

* broken records go to quarantine, unless their offset was seen before;
* valid ones are reduced to the first copy per event, and events taken before are dropped;
* records waiting for reference data are tried again;
* gaps are found against the numbers each device has sent so far.

What earlier slices held is in ``streaming.state``: silver and quarantine are appended to, never read. Current
state and KPIs keep a state of their own, to which each slice's readings are added. A ledger numbers the
slices, so a slice may be repeated, and a run that failed anywhere is made up for by the next one.

A new event whose number its device has sent before follows that number, whichever id is smaller; a full
recompute would let the smaller id follow the gap. Gaps already published are not revised by late packets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.config import KPI_KEYS, OFFSET_KEYS, ZONE_KEYS
from fieldgauge.functions import expressions as X
from fieldgauge.operators.current import current_status
from fieldgauge.operators.enrich import bounded_broadcast
from fieldgauge.operators.grouping import dedup_first, latest_per_key
from fieldgauge.operators.kpi import kpi_of_partials, kpi_partials, merge_partials
from fieldgauge.operators.quality import split_valid, validate
from fieldgauge.operators.quarantine import quarantine
from fieldgauge.operators.runs import as_runs, merge_runs
from fieldgauge.operators.sequence import missing_packets
from fieldgauge.plans.silver import graded_readings
from fieldgauge.plans.stages import Lake, processing_time, run_alerts, upsert
from fieldgauge.session import cut_lineage
from fieldgauge.sources.parts import PART
from fieldgauge.sources.readers import table
from fieldgauge.sources.schemas import BRONZE_SCHEMA
from fieldgauge.streaming.state import ALL, LakeState, current_state, kpi_state, month_part, parts_of


def silver_increment(spark: SparkSession, lake: Lake, batch: DataFrame, now: Column, strict: bool = False) -> None:
    """Publish one slice of raw rows."""
    state = LakeState(spark, lake).open()
    master = table(spark, lake.master)
    valid, invalid = split_valid(validate(batch, strict=strict))
    arrived = cut_lineage(dedup_first(valid).select(*BRONZE_SCHEMA.names))
    fresh = state.unseen_events(arrived)

    numbered = state.with_previous(fresh, state.ready(master))
    timed = numbered.withColumn("event_timestamp", X.parse_event_time("timestamp"))
    stamped = graded_readings(missing_packets(timed), master).withColumn("silver_processed_at", now)
    graded = state.stage("graded", stamped)
    partition, offset = OFFSET_KEYS
    number = state.commit(
        rejects=state.unseen_offsets(quarantine(invalid, graded, now), batch),
        offsets=merge_runs(as_runs(batch, [partition], offset), [partition]),
    )
    state.apply(number)


def current_increment(spark: SparkSession, lake: Lake, now: Column) -> None:
    """Latest state of the zones with new readings: the newest of the state so far and the new ones."""
    state = LakeState(spark, lake).open()
    kept = state._parts("current", table(spark, lake.silver).schema)
    if kept.manifest() is None:
        rows, new = current_state(table(spark, lake.silver)), None
    else:
        new = state.published_after(kept.applied())
        if new is None:
            return
        rows = latest_per_key(kept.read().drop(PART).unionByName(new)).withColumn(PART, F.lit(ALL))
    written = kept.write(rows)
    touched = kept.of_folders(written.values()).drop(PART)
    if new is not None:
        touched = touched.join(bounded_broadcast(new.select(*ZONE_KEYS).distinct()), list(ZONE_KEYS), "left_semi")
    upsert(current_status(touched, now), lake.current, lake.path(lake.current), ZONE_KEYS)
    kept.publish(written, state.last(), emptied=[ALL])


def kpi_increment(spark: SparkSession, lake: Lake, now: Column, drop_null_date: bool = False) -> None:
    """KPIs of the zone days with new readings: the slice's aggregates added to those of the days so far.

    Readings whose time could not be parsed, or whose zone has no time zone, are a day of their own, the
    NULL one, which each run that meets such readings inserts anew; ``drop_null_date`` leaves it out.
    """
    state = LakeState(spark, lake).open()
    silver = table(spark, lake.silver)
    kept = state._parts("kpi", kpi_partials(silver).schema)
    if kept.manifest() is None:
        merged, days = kpi_state(silver), None
    else:
        new = state.published_after(kept.applied())
        if new is None:
            return
        added = cut_lineage(kpi_partials(new))
        before = kept.read(parts_of(added, month_part())).drop(PART)
        merged = merge_partials(before.unionByName(added)).withColumn(PART, month_part())
        days = added.select(*[F.col(k).alias(f"_{k}") for k in KPI_KEYS]).distinct()
    written = kept.write(merged)
    touched = kept.of_folders(written.values()).drop(PART)
    if days is not None:
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KPI_KEYS]
        touched = touched.join(bounded_broadcast(days), same, "left_semi")
    days = cut_lineage(kpi_of_partials(touched, now, drop_null_date))
    upsert(days, lake.kpi, lake.path(lake.kpi), KPI_KEYS, by=KPI_KEYS[0])
    kept.publish(written, state.last())


def run_increment(spark: SparkSession, lake: Lake, batch: DataFrame, now: Column | None = None) -> None:
    """One slice of raw rows through silver, current state, alerts and KPIs."""
    now = processing_time(spark) if now is None else now
    silver_increment(spark, lake, batch, now)
    current_increment(spark, lake, now)
    run_alerts(spark, lake, now)
    kpi_increment(spark, lake, now)
    state = LakeState(spark, lake)
    state.forget(state.last())


def silver_handler(lake: Lake, now: Column | None = None) -> Callable[[DataFrame, int], None]:
    """Publishes slices of the raw table to silver; for ``streaming.ingest.for_each_run``."""

    def handle(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        silver_increment(spark, lake, batch, processing_time(spark) if now is None else now)

    return handle


def lake_handler(lake: Lake, now: Column | None = None) -> Callable[[DataFrame, int], None]:
    """Takes slices of the raw table through all stages; for ``streaming.ingest.for_each_run``."""

    def handle(batch: DataFrame, _: int) -> None:
        run_increment(batch.sparkSession, lake, batch, now)

    return handle
