import pytest
from tests.data import bronze, record

from fieldgauge.operators.quality import split_valid, undecided, validate


def codes(spark, rows, **options):
    found = validate(bronze(spark, rows), **options).select("event_id", "is_valid_record", "validation_error").collect()
    return {r.event_id: (r.is_valid_record, r.validation_error) for r in found}


def test_first_broken_rule_names_the_error(spark):
    rows = [
        record(1),
        record(2, ph=None, ec_ms_cm=-1.0),
        record(3, ph=14.01, ec_ms_cm=11.0),
        record(4, ec_ms_cm=10.01, water_temp_c=60.0),
        record(5, water_temp_c=50.1, water_level_cm=101.0),
        record(6, water_level_cm=-0.1),
        record(7, dissolved_oxygen_mg_l=20.5, humidity_pct=101.0),
        record(8, humidity_pct=100.5),
        record(9, ph=float("nan")),
        record(10, ph=0.0, ec_ms_cm=10.0, water_temp_c=50.0, water_level_cm=100.0, humidity_pct=0.0),
    ]
    assert codes(spark, rows) == {
        "E1": (True, None),
        "E2": (False, "MISSING_REQUIRED_FIELD"),
        "E3": (False, "INVALID_PH"),
        "E4": (False, "INVALID_EC"),
        "E5": (False, "INVALID_WATER_TEMPERATURE"),
        "E6": (False, "INVALID_WATER_LEVEL"),
        "E7": (False, "INVALID_DISSOLVED_OXYGEN"),
        "E8": (False, "INVALID_HUMIDITY"),
        "E9": (False, "INVALID_PH"),
        "E10": (True, None),
    }


def test_missing_humidity_is_neither_valid_nor_invalid(spark):
    rows = [record(1), record(2, humidity_pct=None), record(3, humidity_pct=None, ph=99.0)]
    validated = validate(bronze(spark, rows))
    valid, invalid = split_valid(validated)
    assert [r.event_id for r in valid.collect()] == ["E1"]
    assert [r.event_id for r in invalid.collect()] == ["E3"]
    assert [r.event_id for r in undecided(validated).collect()] == ["E2"]
    assert codes(spark, rows, strict=True)["E2"] == (False, "INVALID_HUMIDITY")


@pytest.mark.parametrize("strict", [False, True])
def test_every_row_is_in_exactly_one_part(spark, strict):
    rows = [record(n, humidity_pct=None if n % 3 == 0 else 60.0, ph=None if n % 4 == 0 else 6.5) for n in range(40)]
    validated = validate(bronze(spark, rows), strict=strict)
    valid, invalid = split_valid(validated)
    assert valid.count() + invalid.count() + undecided(validated).count() == 40
