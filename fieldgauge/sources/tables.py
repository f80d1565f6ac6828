"""Sinks: full refresh, create, append, snapshot switch, merge where the format has it."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldgauge.operators.merge import key_condition
from fieldgauge.sources.parts import delete, names_in
from fieldgauge.sources.readers import table_exists

# Formats whose tables take row-level changes through Spark's MERGE.
MERGE_FORMATS = ("delta", "iceberg")
# What a run has decided and not yet switched, in the folder of the table.
PENDING = "pending.json"


def overwrite_table(df: DataFrame, name: str, path: str, fmt: str = "parquet") -> None:
    """Full refresh of an external table. Do not read the same path in ``df``."""
    df.write.format(fmt).mode("overwrite").option("path", path).saveAsTable(name)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Give an existing folder a name, unless the name is taken."""
    if not table_exists(spark, name):
        spark.catalog.createTable(name, path=path, source=fmt)


def create_if_absent(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet") -> bool:
    """First load. True if this call created the table."""
    if table_exists(df.sparkSession, name):
        return False
    writer = df.write.format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return True


def append_rows(df: DataFrame, name: str) -> None:
    """Append by column name."""
    spark = df.sparkSession
    df.select(*spark.table(name).columns).write.insertInto(name)
    spark.catalog.refreshTable(name)


def publish_snapshot(df: DataFrame, name: str, base: str, fmt: str = "parquet") -> str:
    """Write ``df`` to a new folder below ``base``, then point the table at it.

    ``df`` may read the table it replaces: readers and this job keep the old folder until the
    catalog switches, and a lost executor only repeats tasks of the new one. Old folders stay
    until ``drop_superseded`` is called, as readers may still be at work on them.
    """
    spark = df.sparkSession
    path = f"{base.rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    df.write.format(fmt).save(path)
    if table_exists(spark, name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=path, source=fmt)
    return path


def create_partitioned(spark: SparkSession, schema: StructType, name: str, base: str, column: str) -> None:
    """An empty Parquet table with a partition for each value of ``column``, which becomes its last column."""
    fields = sorted(schema.fields, key=lambda f: f.name == column)
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({listed}) USING parquet "
        f"PARTITIONED BY (`{column}`) LOCATION '{base.rstrip('/')}/rows'"
    )


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _spec(partition: str) -> str:
    """``column=value``, as folders and the catalog write it, as SQL."""
    column, _, value = partition.partition("=")
    if value == "__HIVE_DEFAULT_PARTITION__":
        return f"`{column}` = NULL"
    text = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"`{column}` = '{text}'"


def point_partitions(spark: SparkSession, name: str, folders: Mapping[str, str]) -> None:
    """Point partitions (``column=value``) at folders; each one switches at once, all others stay."""
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    added = [f"PARTITION ({_spec(p)}) LOCATION '{path}'" for p, path in folders.items() if p not in known]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(added)}")
    for partition, path in folders.items():
        if partition in known:
            spark.sql(f"ALTER TABLE {name} PARTITION ({_spec(partition)}) SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def publish_partitions(df: DataFrame, name: str, base: str, column: str) -> list[str]:
    """Replace the partitions that occur in ``df``; files of others are neither read nor written.

    ``df`` may read what it replaces: rows are written whole to a new folder before any partition is
    pointed there. A run that ends in between leaves every partition either old or new, and a repeat
    puts the rest right. Old folders stay until ``drop_superseded``.
    """
    spark = df.sparkSession
    folder = f"{base.rstrip('/')}/data-{uuid.uuid4().hex}"
    df.hint("rebalance", column).write.partitionBy(column).parquet(folder)
    written = [n for n in names_in(spark, folder) if n.startswith(f"{column}=")]
    point_partitions(spark, name, {n: f"{folder}/{n}" for n in written})
    return written


def drop_superseded(spark: SparkSession, name: str, base: str) -> int:
    """Delete the folders below ``base`` that the table no longer points at; how many there were.

    For the owner to call when no reader of an older state and no run of a stage is left.
    """
    base = base.rstrip("/")
    if partition_columns(spark, name):
        files = [path.rsplit(f"{base}/", 1)[-1] for path in spark.table(name).inputFiles()]
        used = {path.split("/", 1)[0] for path in files}
    else:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
        used = {described["data_type"].rstrip("/").rsplit("/", 1)[-1]}
    names = names_in(spark, base)
    if PENDING in names:
        raise RuntimeError(f"a run of {name} has not ended; the next one ends it")
    old = [n for n in names if n.startswith(("snapshot-", "data-", "open-", "closed-")) and n not in used]
    for folder in old:
        delete(spark, f"{base}/{folder}")
    return len(old)


def supports_merge(spark: SparkSession, name: str) -> bool:
    """True if the table's format takes row-level changes."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == "Provider")
    provider = described.select(F.lower("data_type")).collect()
    return bool(provider) and provider[0][0] in MERGE_FORMATS


def merge_unseen_into(df: DataFrame, name: str, keys: Sequence[str]) -> None:
    """Insert-only merge by the table format itself."""
    source = df.alias("source")
    source.mergeInto(name, key_condition(keys, name.split(".")[-1], "source")).whenNotMatched().insertAll().merge()


def merge_upsert_into(df: DataFrame, name: str, keys: Sequence[str]) -> None:
    """Upsert by the table format itself."""
    source = df.alias("source")
    condition = key_condition(keys, name.split(".")[-1], "source")
    source.mergeInto(name, condition).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def merge_episodes_into(
    df: DataFrame, name: str, key: str, status: str, open_value: str,
    refresh: Mapping[str, Column | None], close: Mapping[str, Column],
) -> None:
    """Three-way merge of sightings by the table format itself."""
    target = name.split(".")[-1]
    is_open = F.col(f"{target}.{status}") == open_value
    renewed = {c: F.col(f"source.{c}") if given is None else given for c, given in refresh.items()}
    (
        df.alias("source")
        .mergeInto(name, key_condition([key], target, "source") & is_open)
        .whenMatched().update(renewed)
        .whenNotMatched().insertAll()
        .whenNotMatchedBySource(is_open).update(dict(close))
        .merge()
    )
