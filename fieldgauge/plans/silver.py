"""Raw rows to published, graded readings and to quarantine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.operators.enrich import MATCHED, enrich, flag_matched
from fieldgauge.operators.grouping import dedup_first
from fieldgauge.operators.quality import split_valid, validate
from fieldgauge.operators.quarantine import quarantine
from fieldgauge.operators.sequence import missing_packets, previous_seq
from fieldgauge.operators.status import grade
from fieldgauge.functions import expressions as X
from fieldgauge.sources.schemas import REFERENCE_SCHEMA, SILVER_COLUMNS

Cut = Callable[[DataFrame], DataFrame]


def keep_lazy(df: DataFrame) -> DataFrame:
    """Default cut: none, the stages stay one plan."""
    return df


@dataclass(frozen=True)
class Silver:
    validated: DataFrame
    deduplicated: DataFrame
    graded: DataFrame
    published: DataFrame
    quarantined: DataFrame


def sequenced(deduplicated: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Event time and lost packets. Comes before the join: rows of unknown zones count too."""
    timed = deduplicated.withColumn("event_timestamp", X.parse_event_time("timestamp"))
    return missing_packets(previous_seq(timed, history=history))


def graded_readings(sequence: DataFrame, master: DataFrame, check_unique: bool = True) -> DataFrame:
    """Reference data and status of each reading."""
    dimension = master.select(*REFERENCE_SCHEMA.names)
    return grade(flag_matched(enrich(sequence, dimension, check_unique=check_unique)))


def publishable(graded: DataFrame, now: Column) -> DataFrame:
    """Readings of known zones in the published layout."""
    return graded.filter(F.col(MATCHED)).withColumn("silver_processed_at", now).select(*SILVER_COLUMNS)


def build_silver(
    bronze: DataFrame, master: DataFrame, now: Column, cut: Cut = keep_lazy, strict: bool = False,
    check_unique: bool = True,
) -> Silver:
    """validate -> dedup -> sequence -> enrich -> grade -> publish or quarantine.

    ``cut`` is called on the graded rows, which both outputs read; ``session.cut_lineage`` there
    keeps the shuffles before it from running once per output. The deduplicated rows are left
    lazy: their second reader needs five columns only, which is less work than writing them all.
    """
    validated = validate(bronze, strict=strict)
    valid, invalid = split_valid(validated)
    deduplicated = dedup_first(valid)
    graded = cut(graded_readings(sequenced(deduplicated), master, check_unique))
    return Silver(validated, deduplicated, graded, publishable(graded, now), quarantine(invalid, graded, now))
