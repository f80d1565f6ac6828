"""Record validation: required fields, physical limits, error code, split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.config import LIMITS, REQUIRED, Limit
from fieldgauge.functions import expressions as X

REQUIRED_FLAG = "required_fields_valid"
VALID_FLAG = "is_valid_record"
ERROR = "validation_error"


def validate(
    df: DataFrame, required: Sequence[str] = REQUIRED, limits: Sequence[Limit] = LIMITS, strict: bool = False
) -> DataFrame:
    """Add one flag per rule, their conjunction and the code of the first broken rule.

    A NULL reading in a column that is not required gives a NULL flag, so the conjunction can be
    NULL: such a record is neither valid nor invalid. ``strict`` counts it as broken instead.
    """
    flags = [X.within(limit) for limit in limits]
    if strict:
        flags = [F.coalesce(flag, F.lit(False)) for flag in flags]
    checked = df.withColumns(
        {REQUIRED_FLAG: X.all_present(required), **{lim.flag: flag for lim, flag in zip(limits, flags)}}
    )
    valid = F.expr(" AND ".join([REQUIRED_FLAG, *[limit.flag for limit in limits]]))
    return checked.withColumns({VALID_FLAG: valid, ERROR: X.first_error(REQUIRED_FLAG, limits)})


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid); a record whose flag is NULL is in neither."""
    return validated.filter(F.col(VALID_FLAG)), validated.filter(~F.col(VALID_FLAG))


def undecided(validated: DataFrame) -> DataFrame:
    """Records that are in neither half of the split."""
    return validated.filter(F.col(VALID_FLAG).isNull())
