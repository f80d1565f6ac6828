"""Merges as pure functions: (target, source) -> merged rows.

A match needs equal keys in the SQL sense, so a NULL key never matches. Where a match updates,
two source rows for one target row are an error; where it only inserts, both are inserted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.operators.enrich import BROADCAST_ROWS, bounded_broadcast, is_small
from fieldgauge.operators.grouping import duplicate_keys

Cut = Callable[[DataFrame], DataFrame]


def matched_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the target that also occur in the source. Hint the source to keep the target unshuffled."""
    return target.select(*keys).join(source.select(*keys), list(keys), "left_semi")


def unseen_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not in the target: what an insert-only merge appends."""
    return source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)


def unseen_rows_late(
    target: DataFrame, source: DataFrame, keys: Sequence[str], cut: Cut, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """The same rows, for a source that is a table or a staged frame and may be read twice.

    A source proved small is broadcast against the target's key columns, which are scanned and not
    shuffled. A large one, as in a full recompute, is mostly known already: its keys alone are
    compared, and the wide rows are then picked by the few new keys, again without a shuffle if
    these are proved few. Rows with a NULL in the key match nothing and are all new.
    """
    if is_small(source.select(*keys), broadcast_rows):
        return unseen_rows(matched_keys(target, F.broadcast(source.select(*keys)), keys), source, keys)
    complete = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    new_keys = cut(unseen_rows(target, source.select(*keys).filter(complete), keys).distinct())
    picked = source.join(bounded_broadcast(new_keys, broadcast_rows), list(keys), "left_semi").select(*source.columns)
    return picked.unionByName(source.filter(f"NOT ({complete})"))


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows as they are, and source rows with a key the target does not have."""
    return target.unionByName(unseen_rows(target, source, keys))


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key; other target rows stay."""
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source)


def assert_single_match(target: DataFrame, source: DataFrame, keys: Sequence[str], sample: int = 20) -> None:
    """Raise if two source rows match one target row. Runs one job on the key columns."""
    doubled = duplicate_keys(source.select(*keys), keys)
    clashes = target.select(*keys).join(doubled, list(keys), "left_semi").limit(sample).collect()
    if clashes:
        listed = "; ".join(str(tuple(row)) for row in clashes)
        raise ValueError(f"several source rows match one target row on {', '.join(keys)}: {listed}")


def merge_episodes(
    target: DataFrame,
    source: DataFrame,
    key: str,
    is_open: Column,
    refresh: Mapping[str, Column | None],
    close: Mapping[str, Column],
) -> DataFrame:
    """Three-way merge of sightings into episodes.

    A source row that meets an open target row refreshes the columns in ``refresh`` (from the
    source, or from the given expression). One that meets none is inserted. An open target row
    without source gets the columns in ``close``. Rows that are not open stay as they are and take
    no part in the join, so each key occurs at most once on either side.
    """
    still_open = F.coalesce(is_open, F.lit(False))
    packed_t = target.filter(still_open).select(F.col(key).alias("_tk"), F.struct(*target.columns).alias("_t"))
    packed_s = source.select(F.col(key).alias("_sk"), F.struct(*target.columns).alias("_s"))
    joined = packed_t.join(packed_s, F.col("_tk") == F.col("_sk"), "full_outer")

    def merged(name: str) -> Column:
        old, new = f"_t.{name}", f"_s.{name}"
        given = refresh.get(name)
        if given is None and name not in close:
            # Present on both sides: the sighting's own value if it refreshes, else the old one.
            first, second = ("_s", "_t") if name in refresh else ("_t", "_s")
            return F.expr(f"CASE WHEN {first} IS NOT NULL THEN {first}.{name} ELSE {second}.{name} END AS {name}")
        seen_again = F.expr(new if name in refresh else old) if given is None else given
        gone = close.get(name, F.expr(old))
        return F.when(F.expr("_t IS NULL"), F.expr(new)).when(F.expr("_s IS NULL"), gone).otherwise(seen_again).alias(name)

    changed = joined.select(*[merged(c) for c in target.columns])
    return target.filter(~still_open).unionByName(changed)


def key_condition(keys: Sequence[str], target: str, source: str) -> Column:
    """Match condition for Spark's ``mergeInto``, for table formats that support it."""
    return reduce(and_, [F.col(f"{target}.{k}") == F.col(f"{source}.{k}") for k in keys])

