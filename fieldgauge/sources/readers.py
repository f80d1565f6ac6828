"""Scans: reference CSV, event streams, tables; and the parse of an event body."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldgauge.sources.schemas import ENVELOPE_SCHEMA, EVENT_SCHEMA, LINEAGE_COLUMNS, REFERENCE_SCHEMA

# Read an event topic from its start and go on if old offsets have expired.
STREAM_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def read_reference_csv(spark: SparkSession, path: str, schema: StructType = REFERENCE_SCHEMA) -> DataFrame:
    """CSV with a header line and a given schema; a value that does not parse is NULL."""
    return spark.read.schema(schema).option("header", True).csv(path)


def kafka_options(servers: str, topic: str, jaas_config: str | None = None, **extra: str) -> dict[str, str]:
    """Options for a topic, with SASL over TLS when a login is given."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, **STREAM_DEFAULTS}
    if jaas_config:
        options["kafka.security.protocol"] = "SASL_SSL"
        options["kafka.sasl.mechanism"] = "PLAIN"
        options["kafka.sasl.jaas.config"] = jaas_config
    return {**options, **extra}


def read_event_stream(
    spark: SparkSession, fmt: str, options: Mapping[str, str] | None = None, path: str | None = None
) -> DataFrame:
    """Unbounded scan with the columns value, partition, offset and timestamp.

    ``kafka`` brings its own schema; file formats are read with the envelope schema.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        reader = reader.schema(ENVELOPE_SCHEMA)
    return reader.load(path) if path else reader.load()


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def source_envelope(events: DataFrame) -> DataFrame:
    """Body as text, source position and time under their lineage names."""
    partition, offset, enqueued = LINEAGE_COLUMNS
    return events.select(
        F.col("value").cast("string").alias("json_value"),
        F.col("partition").alias(partition),
        F.col("offset").alias(offset),
        F.col("timestamp").alias(enqueued),
    )


def parse_json(df: DataFrame, column: str, schema: StructType = EVENT_SCHEMA, into: str = "parsed") -> DataFrame:
    """Permissive parse: a bad body gives NULL fields, a field of the wrong type is NULL on its own."""
    return df.withColumn(into, F.from_json(F.col(column), schema))


def flatten_keep_raw(df: DataFrame) -> DataFrame:
    """Parsed fields, lineage and the body they came from."""
    return df.select("parsed.*", *LINEAGE_COLUMNS, F.col("json_value").alias("raw_payload"))


def stamp(df: DataFrame, name: str, now: Column | None = None) -> DataFrame:
    """Processing time; ``now`` fixes it."""
    return df.withColumn(name, F.current_timestamp() if now is None else now)


def to_bronze(events: DataFrame, now: Column | None = None) -> DataFrame:
    """Event source rows to rows of the raw table."""
    parsed = parse_json(source_envelope(events), "json_value")
    return stamp(flatten_keep_raw(parsed), "bronze_ingestion_time", now)
