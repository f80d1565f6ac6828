"""Shape of the physical plans: what is read, what is shuffled."""

import re

import pytest
from pyspark.sql import functions as F
from tests.data import at, bronze, master, record

from fieldgauge.operators import audit, listing, merge
from fieldgauge.operators.alerts import current_alert_conditions
from fieldgauge.operators.current import current_status
from fieldgauge.operators.kpi import daily_kpi
from fieldgauge.plans.silver import build_silver
from fieldgauge.session import cut_lineage, shuffle_partitions


@pytest.fixture(scope="module")
def silver(spark):
    built = build_silver(bronze(spark, [record(n) for n in range(20)]), master(spark), at("2024-03-02"))
    return cut_lineage(built.published)


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def read_schemas(df):
    return re.findall(r"ReadSchema: struct<(.*)>", plan(df))


def exchanges(df):
    return len(re.findall(r"^\(\d+\) Exchange", plan(df), flags=re.M))


def test_kpi_reads_its_columns_only_and_shuffles_once(silver):
    kpi = daily_kpi(silver, at("2024-03-02"))
    (schema,) = read_schemas(kpi)
    assert "previous_seq_num" not in schema and "ph_min" not in schema and "battery_voltage" not in schema
    assert exchanges(kpi) == 1
    assert "HashAggregate" in plan(kpi) and "SortAggregate" not in plan(kpi)


def test_current_state_sends_one_row_per_task_and_zone(silver):
    steps = re.findall(r"^\(\d+\) (\w+)", plan(current_status(silver, at("2024-03-02"))), flags=re.M)
    assert steps.count("Exchange") == 1
    assert steps.index("WindowGroupLimit") < steps.index("Exchange")


def test_alert_conditions_scan_once_without_shuffle(spark, silver):
    current = cut_lineage(current_status(silver, at("2024-03-02")))
    conditions = current_alert_conditions(current)
    assert len(read_schemas(conditions)) == 1 and exchanges(conditions) == 0


def test_status_frequency_and_null_counts_scan_once(silver):
    assert len(read_schemas(listing.status_frequency(silver))) == 1
    counted = audit.null_counts(silver)
    assert len(read_schemas(counted)) == 1 and exchanges(counted) == 1


def test_time_filter_reaches_the_scan(silver):
    near = silver.filter(F.col("event_timestamp") >= at("2024-03-01"))
    assert "GreaterThanOrEqual(event_timestamp" in plan(near.select("event_id"))


def test_top_k_keeps_k_rows_per_task(silver):
    assert "TakeOrderedAndProject" in plan(listing.newest(silver, 50, [F.desc("event_timestamp"), "event_id"]))


def test_small_source_does_not_shuffle_the_target(silver):
    seen = merge.matched_keys(silver, F.broadcast(silver.limit(3).select("event_id")), ["event_id"])
    assert "BroadcastHashJoin" in plan(seen) and "hashpartitioning" not in plan(seen)
    (schema, *_) = read_schemas(seen)
    assert schema == "event_id:string"


def test_no_plan_contains_python(silver):
    for df in (daily_kpi(silver, at("2024-03-02")), current_status(silver, at("2024-03-02"))):
        assert "Python" not in plan(df)


def test_partitions_grow_with_the_input():
    assert shuffle_partitions(1) == 1
    assert shuffle_partitions(100 * 10**12) == 476838
