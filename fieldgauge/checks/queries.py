"""Registered queries: each runs one operator, or a chain of them, over whole driver tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldgauge.checks.fixtures import NOW, deliver, envelope, load, reference, telemetry
from fieldgauge.config import EVENT_KEY, LIMITS, STATUS_COLUMNS, ZONE_KEYS
from fieldgauge.functions import expressions as X
from fieldgauge.operators import audit, listing, merge
from fieldgauge.operators.alerts import alert_lifecycle, current_alert_conditions, episode_history, open_alerts
from fieldgauge.operators.current import current_status
from fieldgauge.operators.enrich import MATCHED, enrich, flag_matched
from fieldgauge.operators.grouping import dedup_first, duplicate_keys, latest_per_key
from fieldgauge.operators.kpi import LOCAL_TIME, daily_kpi, local_day
from fieldgauge.operators.quality import ERROR, REQUIRED_FLAG, VALID_FLAG, validate
from fieldgauge.operators.sequence import HAS_GAP, MISSING, PREVIOUS, gap_totals, missing_packets, previous_seq
from fieldgauge.plans.silver import Silver, build_silver, keep_lazy
from fieldgauge.plans.stages import Lake, existing_tables, run_all
from fieldgauge.session import cut_lineage, prepare, scratch_path
from fieldgauge.sources import tables as sinks
from fieldgauge.sources.readers import parse_json, read_event_stream, read_path, read_reference_csv, table, to_bronze
from fieldgauge.sources.schemas import BRONZE_SCHEMA, REFERENCE_SCHEMA
from fieldgauge.streaming.incremental import run_increment, silver_handler
from fieldgauge.streaming.ingest import for_each_run, ingest, rows_read

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def portable(df: DataFrame) -> DataFrame:
    """Instants as UTC wall time without zone, the type the driver tables use."""
    instants = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in instants}) if instants else df


def registered(run: Query) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(run(prepare(spark), sf_dir))

    REGISTRY[run.__name__] = query
    return run


def _silver(spark: SparkSession, sf_dir: str, cut=keep_lazy) -> Silver:
    return build_silver(telemetry(spark, sf_dir), reference(spark, sf_dir), now(), cut)


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).published


def _current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_status(_published(spark, sf_dir), now())


def _kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_kpi(_published(spark, sf_dir), now())


# Sources and sinks


@registered
def reference_csv(spark, sf_dir):
    path = scratch_path(spark, "reference-csv")
    reference(spark, sf_dir).write.option("header", True).csv(path)
    return read_reference_csv(spark, path)


@registered
def table_scan(spark, sf_dir):
    return read_path(spark, f"{sf_dir}/events.parquet")


@registered
def overwrite_table(spark, sf_dir):
    name, path = f"reference_{uuid.uuid4().hex}", scratch_path(spark, "overwrite")
    rows = reference(spark, sf_dir)
    sinks.overwrite_table(rows.withColumn("active_flag", F.lit(None).cast("boolean")), name, path)
    sinks.overwrite_table(rows, name, path)
    return table(spark, name)


@registered
def create_if_absent(spark, sf_dir):
    name, path = f"created_{uuid.uuid4().hex}", scratch_path(spark, "create")
    rows = reference(spark, sf_dir)
    first = sinks.create_if_absent(rows, name, path)
    second = sinks.create_if_absent(rows, name, path)
    if (first, second) != (True, False):
        raise AssertionError("the second call must leave the table alone")
    sinks.register_table(spark, f"{name}_again", path)
    return table(spark, f"{name}_again")


@registered
def publish_snapshot(spark, sf_dir):
    name, base = f"snapshot_{uuid.uuid4().hex}", scratch_path(spark, "snapshot")
    rows = reference(spark, sf_dir)
    sinks.publish_snapshot(rows.withColumn("location", F.lit("?")), name, base)
    corrected = merge.merge_upsert(table(spark, name), rows, ZONE_KEYS)
    sinks.publish_snapshot(corrected, name, base)
    return table(spark, name)


# Parsing and projections


@registered
def bronze_rows(spark, sf_dir):
    return to_bronze(envelope(telemetry(spark, sf_dir)), now()).drop("raw_payload")


@registered
def parse_props(spark, sf_dir):
    parsed = parse_json(load(spark, sf_dir, "events"), "props", "k BIGINT")
    return parsed.select("event_id", "parsed.k")


@registered
def event_time(spark, sf_dir):
    return telemetry(spark, sf_dir).select(
        "event_id", "eventhub_offset", X.parse_event_time("timestamp").alias("event_timestamp")
    )


# Validation


@registered
def validate_records(spark, sf_dir):
    flags = [limit.flag for limit in LIMITS]
    checked = validate(telemetry(spark, sf_dir))
    return checked.select("event_id", "eventhub_offset", REQUIRED_FLAG, *flags, VALID_FLAG, ERROR)


@registered
def validate_strict(spark, sf_dir):
    return listing.frequency(validate(telemetry(spark, sf_dir), strict=True), [ERROR])


@registered
def split_valid(spark, sf_dir):
    half = F.when(F.col(VALID_FLAG), "valid").when(~F.col(VALID_FLAG), "invalid").otherwise("undecided")
    return listing.frequency(validate(telemetry(spark, sf_dir)).withColumn("half", half), ["half"])


@registered
def invalid_listing(spark, sf_dir):
    columns = ["event_id", "farm_id", "zone_id", "device_id", ERROR, "raw_payload"]
    return listing.invalid_listing(validate(telemetry(spark, sf_dir)).filter(~F.col(VALID_FLAG)), columns)


# Keys


@registered
def dedup_first_events(spark, sf_dir):
    return _silver(spark, sf_dir).deduplicated.select("event_id", "eventhub_partition", "eventhub_offset", "ph")


@registered
def dedup_first_lineitem(spark, sf_dir):
    order = ["l_shipdate", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
    return dedup_first(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"], order)


@registered
def duplicate_events(spark, sf_dir):
    valid = validate(telemetry(spark, sf_dir)).filter(F.col(VALID_FLAG))
    return duplicate_keys(valid, EVENT_KEY)


@registered
def duplicate_keys_lineitem(spark, sf_dir):
    return duplicate_keys(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])


@registered
def latest_per_key_orders(spark, sf_dir):
    return latest_per_key(
        load(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]
    )


# Sequence


@registered
def sequence(spark, sf_dir):
    return _silver(spark, sf_dir).graded.select(
        "event_id", "farm_id", "zone_id", "device_id", "seq_num", PREVIOUS, MISSING, HAS_GAP
    )


@registered
def sequence_orders(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    counted = previous_seq(orders, ["o_custkey"], "o_orderkey", ["o_orderkey"])
    return missing_packets(counted, "o_orderkey")


@registered
def sequence_lineitem(spark, sf_dir):
    row_id = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_shipdate"]
    lines = load(spark, sf_dir, "lineitem").select("l_suppkey", *row_id)
    counted = previous_seq(lines, ["l_suppkey"], "l_orderkey", row_id)
    return missing_packets(counted, "l_orderkey")


@registered
def sequence_totals(spark, sf_dir):
    return gap_totals(_silver(spark, sf_dir).graded)


@registered
def gap_listing(spark, sf_dir):
    return listing.gaps(_silver(spark, sf_dir).graded)


# Joins


@registered
def enrich_telemetry(spark, sf_dir):
    joined = [c for c in REFERENCE_SCHEMA.names if c not in ZONE_KEYS]
    return _silver(spark, sf_dir).graded.select("event_id", *ZONE_KEYS, *joined, MATCHED)


@registered
def enrich_lineitem(spark, sf_dir):
    parts = load(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    return flag_matched(enrich(load(spark, sf_dir, "lineitem"), parts, ["l_partkey"]), "p_type")


@registered
def enrich_orders(spark, sf_dir):
    """A dimension taken to be too large to broadcast: joined by shuffle."""
    customers = load(spark, sf_dir, "customer").selectExpr("c_custkey AS o_custkey", "c_name", "c_mktsegment")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return flag_matched(enrich(orders, customers, ["o_custkey"], broadcast_rows=0), "c_mktsegment")


@registered
def unmatched(spark, sf_dir):
    columns = ["event_id", "farm_id", "zone_id", "device_id", "event_timestamp"]
    return listing.unmatched_listing(_silver(spark, sf_dir).graded, columns)


@registered
def freshness(spark, sf_dir):
    silver = cut_lineage(_published(spark, sf_dir))
    return audit.freshness(current_status(silver, now()), silver)


# Grading and publishing


@registered
def graded(spark, sf_dir):
    return _silver(spark, sf_dir).graded.select(
        "event_id", *STATUS_COLUMNS, "anomaly_count", "is_anomaly", "severity", "overall_status", MATCHED
    )


@registered
def silver(spark, sf_dir):
    return _published(spark, sf_dir)


@registered
def quarantine(spark, sf_dir):
    return _silver(spark, sf_dir).quarantined


@registered
def ph_abnormal(spark, sf_dir):
    return listing.ph_abnormal(_silver(spark, sf_dir).graded, ["event_id", "ph", "ph_status"])


@registered
def anomalies(spark, sf_dir):
    return listing.anomalies(_published(spark, sf_dir))


# Gold


@registered
def current_state(spark, sf_dir):
    return _current(spark, sf_dir)


@registered
def current_listing(spark, sf_dir):
    return listing.current_listing(_current(spark, sf_dir))


@registered
def anomaly_states(spark, sf_dir):
    return listing.anomaly_states(_current(spark, sf_dir))


@registered
def alert_conditions(spark, sf_dir):
    return listing.alert_listing(current_alert_conditions(_current(spark, sf_dir)))


@registered
def alert_identity(spark, sf_dir):
    return open_alerts(_current(spark, sf_dir), now())


@registered
def active_alerts(spark, sf_dir):
    return listing.active_alerts(open_alerts(_current(spark, sf_dir), now()))


def _newest_by_day(spark: SparkSession, sf_dir: str):
    """Newest reading per zone and day, staged, and the first and last day."""
    newest = [F.desc(c) for c in ("event_timestamp", "eventhub_enqueued_time", "eventhub_offset")]
    dated = _published(spark, sf_dir).withColumn("_day", F.to_date("event_timestamp")).filter("_day IS NOT NULL")
    daily = cut_lineage(latest_per_key(dated, [*ZONE_KEYS, "_day"], newest))
    return daily, *daily.agg(F.min("_day"), F.max("_day")).first()


@registered
def alert_merges(spark, sf_dir):
    """One merge per ten days of data, each over the states at their end."""
    daily, first, last = _newest_by_day(spark, sf_dir)
    episodes = None
    for batch in range(1, (last - first).days // 10 + 2):
        end = F.date_add(F.lit(first), 10 * batch)
        batch_now = end.cast("timestamp")
        sightings = open_alerts(current_status(daily.filter(F.col("_day") < end).drop("_day"), batch_now), batch_now)
        episodes = cut_lineage(sightings if episodes is None else alert_lifecycle(episodes, sightings, batch_now))
    return episodes


@registered
def alert_episodes(spark, sf_dir):
    """What one merge per day of data leaves, each over the states at that day's end.

    Silver is reduced to the newest reading per zone and day; such a reading is its zone's state until the
    day of the next one.
    """
    daily, first, last = _newest_by_day(spark, sf_dir)
    batches = 0 if first is None else (last - first).days + 1

    def number(day: Column) -> Column:
        return F.datediff(day, F.lit(first)) + 1

    following = F.lead("_day").over(Window.partitionBy(*ZONE_KEYS).orderBy("_day"))
    states = daily.withColumns({
        "last_reading_at": F.col("event_timestamp"),
        "_from": number(F.col("_day")),
        "_to": F.coalesce(number(following) - 1, F.lit(batches)),
    })
    return episode_history(states, "_from", "_to", batches, lambda n: F.date_add(F.lit(first), n).cast("timestamp"))


@registered
def kpi(spark, sf_dir):
    return _kpi(spark, sf_dir)


@registered
def kpi_listing(spark, sf_dir):
    return listing.kpi_listing(_kpi(spark, sf_dir))


@registered
def local_days(spark, sf_dir):
    return local_day(_published(spark, sf_dir)).select("event_id", LOCAL_TIME, "kpi_date")


# Merges


def _orders(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


def _order_batches(spark, sf_dir):
    """Orders up to 1995, and a later delivery that repeats 1995 with other prices."""
    orders = _orders(spark, sf_dir)
    target = orders.filter("o_orderdate < TIMESTAMP '1996-01-01'")
    source = orders.filter("o_orderdate >= TIMESTAMP '1995-01-01'").withColumn("o_totalprice", F.expr("o_totalprice + 1"))
    return target, source


@registered
def merge_insert_only(spark, sf_dir):
    return merge.merge_insert_only(*_order_batches(spark, sf_dir), ["o_orderkey"])


@registered
def merge_insert_composite(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    columns = ["l_orderkey", "l_linenumber", "l_quantity"]
    target = lines.filter("l_returnflag <> 'N'").select(*columns)
    source = lines.select(*columns).withColumn("l_quantity", F.col("l_quantity") + 100)
    return merge.merge_insert_only(target, source, ["l_orderkey", "l_linenumber"])


@registered
def merge_upsert(spark, sf_dir):
    return merge.merge_upsert(*_order_batches(spark, sf_dir), ["o_orderkey"])


# Reports


@registered
def row_counts(spark, sf_dir):
    built = _silver(spark, sf_dir, cut_lineage)
    current = current_status(built.published, now())
    return listing.row_counts(
        {
            "bronze_iot_telemetry": telemetry(spark, sf_dir),
            "bronze_farm_crop_master": reference(spark, sf_dir),
            "silver_iot_enriched": built.published,
            "silver_invalid_records": built.quarantined,
            "gold_current_status": current,
            "gold_alerts": open_alerts(current, now()),
            "gold_daily_kpi": daily_kpi(built.published, now()),
        }
    )


@registered
def frequency_partition(spark, sf_dir):
    return listing.frequency(telemetry(spark, sf_dir), ["eventhub_partition"])


@registered
def frequency_crop(spark, sf_dir):
    return listing.frequency(_silver(spark, sf_dir).graded, ["crop_type"])


@registered
def frequency_overall_status(spark, sf_dir):
    return listing.frequency(_silver(spark, sf_dir).graded, ["overall_status"])


@registered
def frequency_severity(spark, sf_dir):
    return listing.frequency(_silver(spark, sf_dir).graded, ["severity"])


@registered
def frequency_error(spark, sf_dir):
    return listing.frequency(_silver(spark, sf_dir).quarantined, [ERROR])


@registered
def frequency_alerts(spark, sf_dir):
    return listing.frequency(open_alerts(_current(spark, sf_dir), now()), ["alert_status", "severity"])


@registered
def frequency_orders(spark, sf_dir):
    return listing.frequency(load(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


@registered
def frequency_lineitem(spark, sf_dir):
    return listing.frequency(load(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


@registered
def status_frequency(spark, sf_dir):
    return listing.status_frequency(_silver(spark, sf_dir).graded)


@registered
def extrema_health(spark, sf_dir):
    return listing.extrema(_kpi(spark, sf_dir), "health_score")


@registered
def extrema_orders(spark, sf_dir):
    return listing.extrema(load(spark, sf_dir, "orders"), "o_totalprice")


@registered
def latest_ts_per_key(spark, sf_dir):
    return listing.latest_ts_per_key(
        _published(spark, sf_dir), ZONE_KEYS, "event_timestamp", "silver_latest_timestamp"
    )


@registered
def newest_silver(spark, sf_dir):
    columns = ["event_id", "farm_id", "zone_id", "device_id", "crop_type", "event_timestamp", "ph", "severity",
               "overall_status"]
    return listing.newest(_published(spark, sf_dir).select(*columns), 50, [F.desc("event_timestamp"), "event_id"])


@registered
def sample_silver(spark, sf_dir):
    """Any twenty rows: how many there are, and how many of them silver holds."""
    silver = cut_lineage(_published(spark, sf_dir))
    drawn = cut_lineage(listing.sample(silver, 20))
    held = silver.join(drawn.select("event_id").distinct(), "event_id", "left_semi")
    return drawn.agg(F.count("*").alias("sampled")).crossJoin(held.agg(F.count("*").alias("found")))


# Audits


@registered
def null_counts(spark, sf_dir):
    return audit.null_counts(_published(spark, sf_dir))


@registered
def null_rows_bronze(spark, sf_dir):
    missing = audit.null_rows(telemetry(spark, sf_dir), ["ph", "humidity_pct"])
    return missing.select("event_id", "eventhub_offset", "ph", "humidity_pct")


@registered
def out_of_range(spark, sf_dir):
    return _kpi(spark, sf_dir).select(
        "kpi_date", "farm_id", "zone_id", "health_score", "anomaly_rate_pct",
        audit.bad_health_score().alias("bad_health_score"), audit.bad_anomaly_rate().alias("bad_anomaly_rate"),
    )


@registered
def validation_report(spark, sf_dir):
    silver = cut_lineage(_published(spark, sf_dir))
    current = cut_lineage(current_status(silver, now()))
    return audit.validation_report(silver, current, open_alerts(current, now()), daily_kpi(silver, now()))


@registered
def validation_report_faults(spark, sf_dir):
    """The report over tables with faults of every kind in them."""
    silver = cut_lineage(_published(spark, sf_dir))
    current = cut_lineage(current_status(silver, now()))
    alerts, days = open_alerts(current, now()), daily_kpi(silver, now())
    stale = current.withColumn(
        "last_reading_at", F.when(F.col("zone_id") == "BAY-1", F.expr("last_reading_at - INTERVAL 1 HOUR")).otherwise(F.col("last_reading_at"))
    )
    scored = days.withColumn(
        "health_score", F.when(F.col("reading_count") % 3 == 0, F.lit(100.5)).when(F.col("reading_count") % 3 == 1, F.col("health_score"))
    ).withColumn("anomaly_rate_pct", F.when(F.col("reading_count") % 5 == 0, F.lit(-1.0)).otherwise(F.col("anomaly_rate_pct")))
    return audit.validation_report(
        silver.unionByName(silver.filter("seq_num % 50 = 0")),
        stale.unionByName(stale.filter("farm_id IN ('FARM-1', 'FARM-2')")),
        alerts.unionByName(alerts.filter("severity = 'LOW'")),
        scored.unionByName(scored.filter("farm_id = 'FARM-3'")),
    )


@registered
def null_counts_faults(spark, sf_dir):
    """Required columns with holes."""
    holed = _published(spark, sf_dir).withColumn("crop_type", F.expr("CASE WHEN seq_num % 7 <> 0 THEN crop_type END")).withColumn(
        "ph", F.expr("CASE WHEN seq_num % 11 <> 0 THEN ph END")
    )
    return audit.null_counts(holed)


@registered
def doubled_dimension(spark, sf_dir):
    """Keys a doubled dimension is refused for, as many as the error would find; and that it is refused."""
    parts = load(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    doubled = parts.unionByName(parts.filter("p_size = 1"))
    try:
        enrich(load(spark, sf_dir, "lineitem"), doubled, ["l_partkey"])
        refused = False
    except ValueError:
        refused = True
    return duplicate_keys(doubled, ["l_partkey"]).agg(F.count("*").alias("keys")).withColumn("refused", F.lit(refused))


# Streaming and stages over tables


@registered
def tables_exist(spark, sf_dir):
    """Which tables of a lake exist, before and after its stages."""
    lake = _lake(spark)
    before = existing_tables(spark, lake)
    sinks.create_if_absent(reference(spark, sf_dir), lake.master, lake.path(lake.master))
    sinks.create_if_absent(telemetry(spark, sf_dir), lake.bronze, lake.path(lake.bronze))
    run_all(spark, lake, now())
    after = existing_tables(spark, lake)
    rows = [(n.rsplit("_", 1)[0], before[n], after[n]) for n in lake.names]
    return spark.createDataFrame(rows, "table_name STRING, before BOOLEAN, after BOOLEAN")


@registered
def increments_over_tables(spark, sf_dir):
    """Three slices through all incremental stages: silver, current state and KPIs as published at the end.

    Every slice holds times that do not parse, copies of events of the slice before and, in the last one,
    late packets. Processing times are left out.
    """
    lake = _lake(spark)
    sinks.create_if_absent(reference(spark, sf_dir), lake.master, lake.path(lake.master))
    rows = telemetry(spark, sf_dir).withColumn(
        "timestamp", F.when(F.col("eventhub_offset") % 401 == 0, F.lit("garbage")).otherwise(F.col("timestamp"))
    )
    late = F.col("seq_num") % 97 == 0
    rows = cut_lineage(rows.withColumn("_slice", F.when(late, 2).otherwise(
        F.when(F.col("eventhub_enqueued_time") < F.lit("2024-01-11").cast("timestamp"), 0)
        .when(F.col("eventhub_enqueued_time") < F.lit("2024-01-21").cast("timestamp"), 1).otherwise(2)
    )))
    for step in range(3):
        at = F.date_add(F.lit(NOW).cast("date"), step).cast("timestamp")
        run_increment(spark, lake, rows.filter(F.col("_slice") == step).drop("_slice"), at)
    published = [
        table(spark, name).drop("silver_processed_at", "gold_updated_at").withColumn("table_name", F.lit(label))
        for name, label in ((lake.silver, "silver"), (lake.current, "current"), (lake.kpi, "kpi"))
    ]
    return functools.reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), published)


def _lake(spark) -> Lake:
    tag = uuid.uuid4().hex
    names = ("master", "bronze", "silver", "invalid", "current", "alerts", "kpi")
    return Lake(scratch_path(spark, "lake"), *[f"{n}_{tag}" for n in names])


@registered
def stream_ingest(spark, sf_dir):
    source, raw, checkpoint = (scratch_path(spark, n) for n in ("events", "bronze", "bronze-progress"))
    deliver(envelope(telemetry(spark, sf_dir)), source)
    ingest(read_event_stream(spark, "parquet", path=source), raw, checkpoint, now())
    return read_path(spark, raw).drop("raw_payload")


@registered
def stream_restart(spark, sf_dir):
    """Two deliveries and a run without one: each event is read once."""
    source, raw, checkpoint = (scratch_path(spark, n) for n in ("events", "bronze", "bronze-progress"))
    delivered = envelope(telemetry(spark, sf_dir))
    counts = []
    for run, part in [
        ("first", delivered.filter("timestamp < TIMESTAMP '2024-01-16'")),
        ("second", delivered.filter("timestamp >= TIMESTAMP '2024-01-16'")),
        ("third", None),
    ]:
        if part is not None:
            deliver(part, source)
        query = ingest(read_event_stream(spark, "parquet", path=source), raw, checkpoint, now())
        in_table = read_path(spark, raw).agg(F.count("*").alias("rows_in_table")).first()[0]
        counts.append((run, rows_read(query), in_table))
    return spark.createDataFrame(counts, "run STRING, rows_read BIGINT, rows_in_table BIGINT")


@registered
def stream_backlog(spark, sf_dir):
    """A backlog of more batches than a query keeps reports of, one file each."""
    source, raw, checkpoint = (scratch_path(spark, n) for n in ("events", "bronze", "bronze-progress"))
    deliver(envelope(telemetry(spark, sf_dir)).repartition(110, "offset"), source)
    arriving = read_event_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, path=source)
    run = ingest(arriving, raw, checkpoint, now())
    return spark.createDataFrame(
        [(rows_read(run), len(run.rows_by_batch) > 100)], "rows_read BIGINT, more_than_kept BOOLEAN"
    )


@registered
def silver_in_slices(spark, sf_dir):
    """Raw rows delivered in three parts; each stream run publishes what is new."""
    lake = _lake(spark)
    sinks.create_if_absent(reference(spark, sf_dir), lake.master, lake.path(lake.master))
    raw, checkpoint = lake.path(lake.bronze), scratch_path(spark, "silver-progress")
    rows = telemetry(spark, sf_dir)
    for part in (
        rows.filter("eventhub_enqueued_time < TIMESTAMP '2024-01-11'"),
        rows.filter("eventhub_enqueued_time >= TIMESTAMP '2024-01-11' "
                    "AND eventhub_enqueued_time < TIMESTAMP '2024-01-21'"),
        rows.filter("eventhub_enqueued_time >= TIMESTAMP '2024-01-21'"),
    ):
        part.write.mode("append").parquet(raw)
        arriving = spark.readStream.schema(BRONZE_SCHEMA).parquet(raw)
        for_each_run(arriving, checkpoint, silver_handler(lake, now()), lake.names)
    return table(spark, lake.silver)


@registered
def stages_over_tables(spark, sf_dir):
    """All stages over catalog tables, twice: the second run adds no rows."""
    lake = _lake(spark)
    sinks.create_if_absent(reference(spark, sf_dir), lake.master, lake.path(lake.master))
    sinks.create_if_absent(telemetry(spark, sf_dir), lake.bronze, lake.path(lake.bronze))
    run_all(spark, lake, now())
    run_all(spark, lake, now())
    return listing.row_counts(
        {
            "silver_iot_enriched": table(spark, lake.silver),
            "silver_invalid_records": table(spark, lake.invalid),
            "gold_current_status": table(spark, lake.current),
            "gold_alerts": table(spark, lake.alerts),
            "gold_daily_kpi": table(spark, lake.kpi),
        }
    )

