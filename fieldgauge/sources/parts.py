"""Rows kept in parts: a folder for each part and a manifest that names the current folder of every part.

A write adds folders for the parts it replaces and then one manifest, whose appearance under its own name
is the switch; folders of other parts are neither read nor written. Manifests also carry the number of the
last slice that was applied, so that a repeat after a failure knows what is done.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PART = "_part"


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of files and folders below ``path``, none if it does not exist."""
    files, folder = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []


def read_text(spark: SparkSession, path: str) -> str:
    files, file = _files(spark, path)
    stream = files.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole under its name, and never replaces one."""
    files, file = _files(spark, path)
    _, draft = _files(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = files.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    if files.exists(file) or not files.rename(draft, file):
        raise FileExistsError(f"{path} was written by another run")


def delete(spark: SparkSession, path: str) -> None:
    files, folder = _files(spark, path)
    files.delete(folder, True)


@dataclass
class Manifest:
    """``applied``: the last slice in these parts. ``folders``: part to folder. ``notes``: part to a number."""

    version: int = 0
    applied: int = -1
    folders: dict[str, str] = field(default_factory=dict)
    notes: dict[str, int] = field(default_factory=dict)


class Parts:
    """A table in parts below ``base``; ``schema`` is without the part."""

    def __init__(self, spark: SparkSession, base: str, schema: StructType | str):
        self.spark, self.base = spark, base.rstrip("/")
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self._manifest: Manifest | None = None

    def manifest(self) -> Manifest | None:
        """The one in force when this object first asked, or wrote; None if nothing was ever written."""
        if self._manifest is None:
            versions = [n for n in names_in(self.spark, self.base) if n.startswith("manifest-") and n.endswith(".json")]
            if versions:
                self._manifest = Manifest(**json.loads(read_text(self.spark, f"{self.base}/{versions[-1]}")))
        return self._manifest

    def applied(self) -> int:
        return (self.manifest() or Manifest()).applied

    def held(self) -> dict[str, str]:
        """Part to folder."""
        return (self.manifest() or Manifest()).folders

    def read(self, parts: Iterable[str] | None = None) -> DataFrame:
        """Rows of these parts (all by default) with their part; other folders are not listed."""
        held = self.held()
        return self.of_folders([held[p] for p in (held if parts is None else dict.fromkeys(parts)) if p in held])

    def of_folders(self, paths: Iterable[str]) -> DataFrame:
        schema = StructType([*self.schema.fields]).add(PART, "string")
        paths = list(paths)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def write(self, rows: DataFrame) -> dict[str, str]:
        """New folders for the parts that occur in ``rows`` (which has the column of the part), not in force yet."""
        folder = f"{self.base}/data-{uuid.uuid4().hex}"
        # The part is in the files as well, so that a folder can be read alone.
        marked = rows.select(*self.schema.names, PART, F.col(PART).alias("part_folder"))
        marked.repartition(PART).write.partitionBy("part_folder").parquet(folder)
        return {n.partition("=")[2]: f"{folder}/{n}" for n in names_in(self.spark, folder) if n.startswith("part_folder=")}

    def publish(
        self, written: dict[str, str], applied: int, emptied: Iterable[str] = (), notes: dict[str, int] | None = None
    ) -> None:
        """Put written folders in force, drop the parts ``emptied``, leave all others."""
        before = self.manifest() or Manifest()
        kept = {part: path for part, path in before.folders.items() if part not in set(emptied)}
        after = Manifest(before.version + 1, applied, {**kept, **written}, {**before.notes, **(notes or {})})
        write_text(self.spark, f"{self.base}/manifest-{after.version:012d}.json", json.dumps(after.__dict__))
        self._manifest = after

    def replace(
        self, rows: DataFrame, applied: int, emptied: Iterable[str] = (), notes: dict[str, int] | None = None
    ) -> None:
        self.publish(self.write(rows), applied, emptied, notes)

    def forget(self) -> None:
        """Delete manifests and folders that are no longer in force."""
        names = names_in(self.spark, self.base)
        current = max((n for n in names if n.endswith(".json")), default="")
        used = {path.rsplit("/", 2)[1] for path in self.held().values()}
        for name in names:
            if name != current and name not in used:
                delete(self.spark, f"{self.base}/{name}")
