"""Sorted rows in Arrow batches, group by group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def group_starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """First row of every run of equal keys (numbers without NULL)."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups of rows sorted by ``keys``; a group may span batches.

    Holds a batch and the group that is open at its end, so groups must be bounded.
    """
    carried = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if carried is not None:
            table = pa.concat_tables([carried, table])
        last = int(group_starts(table, keys)[-1])
        if last:
            yield table.slice(0, last)
        carried = table.slice(last)
    if carried is not None:
        yield carried


def each_group(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """One table per group."""
    for table in whole_groups(batches, keys):
        starts = group_starts(table, keys).tolist() + [table.num_rows]
        for a, b in zip(starts[:-1], starts[1:]):
            yield table.slice(a, b - a)
