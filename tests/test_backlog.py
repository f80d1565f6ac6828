from pyspark.sql import functions as F

from fieldgauge.checks.fixtures import deliver
from fieldgauge.session import scratch_path
from fieldgauge.sources.readers import read_event_stream, read_path
from fieldgauge.streaming.ingest import OPEN_COST, append_stream, rows_read


def test_one_delivered_file_is_read_by_many_tasks(spark):
    """A batch of one file, far below Spark's 4 MB a task, is shared among tasks: each leaves a file."""
    source, raw, progress = (scratch_path(spark, n) for n in ("events", "bronze", "progress"))
    bodies = spark.range(20_000, numPartitions=1).select(
        F.encode(F.sha2(F.col("id").cast("string"), 512), "UTF-8").alias("value"), F.lit(0).alias("partition"),
        F.col("id").alias("offset"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"),
    )
    deliver(bodies, source)
    run = append_stream(read_event_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, path=source), raw, progress)
    written = read_path(spark, raw)
    assert (rows_read(run), len(run.rows_by_batch), written.distinct().count()) == (20_000, 1, 20_000)
    assert len(written.inputFiles()) > 1
    assert spark.conf.get(OPEN_COST, None) is None
