"""Event stream to the append-only raw table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fieldgauge.sources.readers import table_exists, to_bronze


RETAINED = "spark.sql.streaming.numRecentProgressUpdates"
#: Reports that a running query keeps, and seconds between two looks at them.
REPORTS_KEPT = 10_000
POLL_SECONDS = 1.0
OPEN_COST = "spark.sql.files.openCostInBytes"
#: The smallest piece of a file that is a task of its own. With Spark's 4 MB a batch of one file is read and
#: parsed by one core, as a batch is seldom large; bodies take far longer to parse than files to open.
PIECE_BYTES = 512 * 2**10


@dataclass
class IngestRun:
    """A finished run and the source rows of each of its batches."""

    query: StreamingQuery
    rows_by_batch: dict[int, int]


def _followed(query: StreamingQuery) -> IngestRun:
    """Wait for the end and add up all batches, of which a query only keeps the last reports."""
    rows: dict[int, int] = {}
    ended = False
    while not ended:
        ended = bool(query.awaitTermination(POLL_SECONDS))
        rows.update({progress.batchId: progress.numInputRows for progress in query.recentProgress})
    if rows and len(rows) != max(rows) - min(rows) + 1:
        raise RuntimeError(f"reports of {max(rows) - min(rows) + 1 - len(rows)} batches were missed")
    return IngestRun(query, rows)


@contextmanager
def stream_settings(spark: SparkSession) -> Iterator[None]:
    """Reports enough to count all batches, and files read in small pieces unless the session has its own size."""
    conf = spark.conf
    before = {name: conf.get(name, None) for name in (RETAINED, OPEN_COST)}
    conf.set(RETAINED, str(max(REPORTS_KEPT, int(before[RETAINED] or 0))))
    if before[OPEN_COST] is None:
        conf.set(OPEN_COST, str(PIECE_BYTES))
    try:
        yield
    finally:
        for name, value in before.items():
            conf.set(name, value) if value is not None else conf.unset(name)


def append_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> IngestRun:
    """Append everything that is new since the checkpoint, then stop. Waits for the end."""
    with stream_settings(df.sparkSession):  # a running query looks the reports up at each batch
        query = (
            df.writeStream.format(fmt)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(path)
        )
        return _followed(query)


def ingest(events: DataFrame, path: str, checkpoint: str, now: Column | None = None) -> IngestRun:
    """Parse an event stream and append it to the raw table at ``path``."""
    return append_stream(to_bronze(events, now), path, checkpoint)


def rows_read(run: IngestRun) -> int:
    """Source rows of a finished run, over all its batches."""
    return sum(run.rows_by_batch.values())


def for_each_run(
    df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], writes: Iterable[str] = ()
) -> StreamingQuery:
    """Hand each new slice of an append-only table to ``handle``, then stop.

    Slices run in a session of their own; the caller's session lists the tables in ``writes`` anew.
    """
    query = (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    for name in writes:
        if table_exists(df.sparkSession, name):
            df.sparkSession.catalog.refreshTable(name)
    return query
