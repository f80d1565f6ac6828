"""Session settings the operators rely on, and the shared folder for lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

SHUFFLE_PARTITION_BYTES = 200 * 2**20
SCAN_PARTITION_BYTES = 256 * 2**20


def shuffle_partitions(input_bytes: int, partition_bytes: int = SHUFFLE_PARTITION_BYTES) -> int:
    """Partitions that keep one sort in memory when all of ``input_bytes`` is shuffled."""
    return max(1, -(-input_bytes // partition_bytes))


def build_session(
    app: str = "fieldgauge", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with UTC time, adaptive execution and whatever ``conf`` adds.

    ``input_bytes``, the size of the largest table a job shuffles, sets the number of shuffle
    partitions. Adaptive execution merges those that turn out small, but it never adds any, and
    Spark's default of 200 would put half a terabyte of a 100 TB table into each.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Each column expression would otherwise ask the JVM for its call site.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    if input_bytes is not None:
        settings.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes)))
        settings.setdefault("spark.sql.files.maxPartitionBytes", str(SCAN_PARTITION_BYTES))
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the time zone of an existing session: alert ids and local days depend on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``."""
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="fieldgauge-")
    spark.conf.set(CHECKPOINT_DIR, made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path of its own below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages restart from files, not from the sources, and read only the columns they need,
    which a row-wise checkpoint would not give them. The folders stay for the owner to expire.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
