import pytest

from fieldgauge.operators import merge
from fieldgauge.session import cut_lineage

SCHEMA = "k STRING, p INT, v INT"


def rows(df):
    return sorted(((r.k, r.p, r.v) for r in df.collect()), key=str)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", 1, 10), ("b", 1, 20), (None, 1, 30)], SCHEMA)


def test_insert_only_never_changes_a_row_and_inserts_doubles(spark, target):
    source = spark.createDataFrame([("a", 1, 99), ("c", 1, 1), ("c", 1, 2), (None, 1, 3)], SCHEMA)
    expected = sorted(
        [("a", 1, 10), ("b", 1, 20), (None, 1, 30), ("c", 1, 1), ("c", 1, 2), (None, 1, 3)], key=str
    )
    assert rows(merge.merge_insert_only(target, source, ["k"])) == expected
    unseen = sorted([("c", 1, 1), ("c", 1, 2), (None, 1, 3)], key=str)
    assert rows(merge.unseen_rows(target, source, ["k"])) == unseen
    for limit in (0, 1, 100):
        assert rows(merge.unseen_rows_late(target, source, ["k"], cut_lineage, limit)) == unseen


def test_composite_key_needs_both_parts(spark, target):
    source = spark.createDataFrame([("a", 2, 1), ("a", 1, 2), ("a", None, 3)], SCHEMA)
    unseen = sorted([("a", 2, 1), ("a", None, 3)], key=str)
    assert rows(merge.unseen_rows(target, source, ["k", "p"])) == unseen
    for limit in (0, 100):
        assert rows(merge.unseen_rows_late(target, source, ["k", "p"], cut_lineage, limit)) == unseen


def test_upsert_replaces_inserts_and_keeps(spark, target):
    source = spark.createDataFrame([("a", 7, 99), ("c", 1, 1), (None, 5, 5)], SCHEMA)
    expected = [("a", 7, 99), ("b", 1, 20), ("c", 1, 1), (None, 1, 30), (None, 5, 5)]
    assert rows(merge.merge_upsert(target, source, ["k"])) == sorted(expected, key=str)


def test_two_source_rows_for_one_target_row_are_an_error(spark, target):
    clash = spark.createDataFrame([("a", 1, 1), ("a", 1, 2)], SCHEMA)
    with pytest.raises(ValueError, match="'a'"):
        merge.assert_single_match(target, clash, ["k"])
    harmless = spark.createDataFrame([("z", 1, 1), ("z", 1, 2), (None, 1, 1), (None, 1, 2)], SCHEMA)
    merge.assert_single_match(target, harmless, ["k"])
