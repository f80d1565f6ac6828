"""What increments remember of all slices before, in parts that a slice opens only where it touches them.

* ``ids`` with ``blooms``: ids of events by event date, and a Bloom filter of each date's ids. An arriving id is
  tested against all filters; only dates with a hit have their ids read.
* ``runs`` with ``tops``: runs of numbers seen per device, by blocks of numbers, and each block's highest number.
* ``offsets``: runs of offsets seen per source partition.
* ``waiting``: records without reference data, as raw rows.
* ``current``, ``kpi``: the newest reading of each zone; mergeable aggregates of each zone day, by month.

A ledger numbers the slices. A slice is decided when its entry appears; its rows are staged by then, and every
table and state takes slices in order, each once. A run that fails in between is made up for by the next one.
The clock plays no part in it.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldgauge.config import DEVICE_KEYS, EVENT_KEY, MASTER_DATA_NOT_FOUND, OFFSET_KEYS, ZONE_KEYS
from fieldgauge.functions import expressions as X
from fieldgauge.operators.enrich import MATCHED, bounded_broadcast
from fieldgauge.operators.grouping import first_by, latest_per_key
from fieldgauge.operators.kpi import kpi_partials
from fieldgauge.operators.quality import ERROR
from fieldgauge.operators.runs import as_runs, mark_members, merge_runs
from fieldgauge.operators.sequence import PREVIOUS, previous_seq
from fieldgauge.plans.stages import Lake, increments_path, insert_unseen
from fieldgauge.session import cut_lineage
from fieldgauge.sources import tables as sinks
from fieldgauge.sources.parts import PART, Parts, delete, names_in, read_text, write_text
from fieldgauge.sources.readers import parse_json, table, table_exists
from fieldgauge.sources.schemas import BRONZE_SCHEMA, LINEAGE_COLUMNS, SILVER_COLUMNS

#: Numbers and offsets in a part, as powers of two.
NUMBER_BITS, OFFSET_BITS = 14, 20
#: A Bloom filter: bits in a bucket (a bitmap of Spark's), bits per id, hashes per id.
BUCKET_BITS, BITS_PER_ID, HASHES = 32_768, 16, 4
ALL, UNDATED = "all", "none"


def date_part(instant: str) -> Column:
    return F.coalesce(F.date_format(instant, "yyyy-MM-dd"), F.lit(UNDATED))


def block_part(number: str, bits: int) -> Column:
    return F.shiftright(F.col(number).cast("long"), bits).cast("string")


def parts_of(df: DataFrame, part: Column) -> list[str]:
    """Parts that rows fall in; few, as the rows of a slice are close to each other."""
    return [r[0] for r in df.select(part.alias("p")).filter("p IS NOT NULL").distinct().collect()]


def _fields(*names: str) -> StructType:
    return StructType([BRONZE_SCHEMA[n] for n in names])


class LakeState:
    def __init__(self, spark: SparkSession, lake: Lake):
        self.spark, self.lake, self.base = spark, lake, increments_path(lake)
        runs = lambda *keys: _fields(*keys).add("lo", "long").add("hi", "long")
        self.ids = self._parts("ids", _fields(*EVENT_KEY))
        self.blooms = self._parts("blooms", "bucket INT, bits BINARY")
        self.runs = self._parts("runs", runs(*DEVICE_KEYS))
        self.tops = self._parts("tops", _fields(*DEVICE_KEYS).add("block", "string").add("hi", "long"))
        self.offsets = self._parts("offsets", runs(OFFSET_KEYS[0]))
        self.waiting = self._parts("waiting", BRONZE_SCHEMA)
        self._folder: str | None = None
        self._schemas: dict[str, str] = {}

    def _parts(self, name: str, schema) -> Parts:
        return Parts(self.spark, f"{self.base}/{name}", schema)

    # Ledger

    def entries(self) -> list[int]:
        """Numbers of the slices entered, but for old ones that all tables have taken."""
        names = names_in(self.spark, f"{self.base}/slices")
        return sorted(int(n[6:-5]) for n in names if n.startswith("slice-") and n.endswith(".json"))

    def last(self) -> int:
        return max(self.entries(), default=0)

    def stage(self, name: str, frame: DataFrame) -> DataFrame:
        """Write rows of the slice that is being made where its entry will name them, and read them back."""
        if self._folder is None:
            self._folder = f"{self.base}/rows/{self.last() + 1}-{uuid.uuid4().hex}"
        path = f"{self._folder}/{name}"
        frame.write.parquet(path)
        self._schemas[name] = frame.schema.json()
        return self.spark.read.schema(frame.schema).parquet(path)

    def commit(self, **frames: DataFrame) -> int:
        """Stage what is left of the rows of a slice, then enter it. Its number."""
        number = self.last() + 1
        for name, frame in frames.items():
            self.stage(name, frame)
        entry = {"folder": self._folder, "schemas": self._schemas}
        write_text(self.spark, f"{self.base}/slices/slice-{number:012d}.json", json.dumps(entry))
        self._folder, self._schemas = None, {}
        return number

    def rows(self, number: int) -> dict[str, DataFrame]:
        """Frames of a slice. Published rows and what is taken from them are views of the graded ones, which are wide."""
        entry = json.loads(read_text(self.spark, f"{self.base}/slices/slice-{number:012d}.json"))
        frames = {
            name: self.spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{entry['folder']}/{name}")
            for name, schema in entry["schemas"].items()
        }
        if (graded := frames.pop("graded", None)) is not None:
            waits = F.when(~F.col(MATCHED), F.struct(*BRONZE_SCHEMA.names))
            frames["published"] = graded.filter(F.col(MATCHED)).select(*SILVER_COLUMNS)
            frames["taken"] = graded.select(
                *EVENT_KEY, *DEVICE_KEYS, "seq_num", date_part("event_timestamp").alias(PART), waits.alias("raw")
            )
        return frames

    def published_after(self, applied: int) -> DataFrame | None:
        """Silver rows of the slices after ``applied``; None if there is none."""
        frames = [self.rows(n)["published"] for n in self.entries() if n > applied]
        return reduce(DataFrame.unionByName, frames) if frames else None

    def forget(self, until: int) -> None:
        """Drop what is no longer needed once all tables have taken the slices up to ``until``.

        Staged rows, marks and entries of these slices go, but for the last entry, which carries the number,
        and so do folders of states that were replaced.
        """
        for folder, number_of in (
            ("rows", lambda n: int(n.partition("-")[0])),
            ("marks", lambda n: int(n[:12])),
            ("slices", lambda n: int(n[6:18]) + 1),
        ):
            for name in names_in(self.spark, f"{self.base}/{folder}"):
                if number_of(name) <= until and not name.endswith(f"{until:012d}.done"):
                    delete(self.spark, f"{self.base}/{folder}/{name}")
        for state in (self.ids, self.blooms, self.runs, self.tops, self.offsets, self.waiting):
            state.forget()

    # Slices before this one

    def open(self) -> "LakeState":
        """Apply what is entered but not applied; of a lake that was built by full runs, read the tables once."""
        marks = set(names_in(self.spark, f"{self.base}/marks"))
        if self.ids.manifest() is None and table_exists(self.spark, self.lake.silver):
            self._from_tables()
        for number in self.entries():
            if f"{number:012d}.done" not in marks:
                self.apply(number, repeated=True)
        return self

    def apply(self, number: int, repeated: bool = False) -> None:
        """Take a slice into silver, quarantine and all states, each of which may have it already."""
        marks = set(names_in(self.spark, f"{self.base}/marks"))
        rows = self.rows(number)

        def mark(what: str) -> None:
            if f"{number:012d}.{what}" not in marks:
                write_text(self.spark, f"{self.base}/marks/{number:012d}.{what}", "")

        for name, target, keys in (
            ("published", self.lake.silver, EVENT_KEY), ("rejects", self.lake.invalid, OFFSET_KEYS)
        ):
            if f"{number:012d}.{name}" in marks:
                continue
            if repeated:  # an append may have happened before the failure
                insert_unseen(rows[name], target, self.lake.path(target), keys)
            elif not sinks.create_if_absent(rows[name], target, self.lake.path(target)):
                sinks.append_rows(rows[name], target)
            mark(name)
        self._add_ids(rows["taken"], number)
        self._add_numbers(rows["taken"], number)
        self._add_offsets(rows["offsets"], number)
        self._keep_waiting(rows, number)
        mark("done")

    def _keep_waiting(self, rows: dict[str, DataFrame], number: int) -> None:
        if self.waiting.applied() >= number:
            return
        new = rows["taken"].filter("raw IS NOT NULL").select("raw.*")
        if not self.waiting.held():
            if new.isEmpty():
                self.waiting.publish({}, number)
                return
            left = new
        else:
            done = rows["published"].select(*EVENT_KEY)
            left = self.waiting.read().drop(PART).join(done, list(EVENT_KEY), "left_anti").unionByName(new)
        kept = first_by(left, EVENT_KEY, EVENT_KEY).withColumn(PART, F.lit(ALL))
        self.waiting.replace(kept, number, emptied=[ALL])

    def _from_tables(self) -> None:
        silver, invalid = table(self.spark, self.lake.silver), table(self.spark, self.lake.invalid)
        kept = invalid.filter(F.col(ERROR) == MASTER_DATA_NOT_FOUND)
        raw = kept.select(F.col("raw_payload").alias("json_value"), *LINEAGE_COLUMNS, "bronze_ingestion_time")
        parsed = parse_json(raw, "json_value").select(
            "parsed.*", *LINEAGE_COLUMNS, F.col("json_value").alias("raw_payload"), "bronze_ingestion_time"
        ).select(*BRONZE_SCHEMA.names)
        still = parsed.join(silver.select(*EVENT_KEY), list(EVENT_KEY), "left_anti")
        still = cut_lineage(first_by(still, EVENT_KEY, EVENT_KEY))
        narrow = [*EVENT_KEY, *DEVICE_KEYS, "seq_num"]
        keys = silver.select(*narrow, date_part("event_timestamp").alias(PART)).unionByName(
            still.withColumn("_t", X.parse_event_time("timestamp")).select(*narrow, date_part("_t").alias(PART))
        )
        self._add_numbers(keys, 0)
        seen = silver.select(*OFFSET_KEYS).unionByName(invalid.select(*OFFSET_KEYS))
        self._add_offsets(merge_runs(as_runs(seen, OFFSET_KEYS[:1], OFFSET_KEYS[1]), OFFSET_KEYS[:1]), 0)
        self.waiting.replace(still.withColumn(PART, F.lit(ALL)), 0)
        self._add_ids(keys, 0)

    # Ids

    def _add_ids(self, keys: DataFrame, number: int) -> None:
        """Ids of the slice into the parts of their dates; only these get a new filter."""
        if self.blooms.applied() >= number:
            return
        touched = parts_of(keys, F.col(PART))
        if self.ids.applied() < number:
            self.ids.replace(self.ids.read(touched).unionByName(keys.select(*EVENT_KEY, PART)).distinct(), number)
        ids = self.ids.read(touched)
        sizes = {r[0]: max(1, -(-r[1] * BITS_PER_ID // BUCKET_BITS)) for r in ids.groupBy(PART).count().collect()}
        self.blooms.replace(bloom_filters(ids, sizes), number, notes=sizes)

    def unseen_events(self, arrived: DataFrame) -> DataFrame:
        """Rows of a staged frame whose id was never taken before. Only the known ids are staged, not the rows."""
        sizes = (manifest := self.blooms.manifest()) and manifest.notes
        if not sizes:
            return arrived
        hits = cut_lineage(bloom_hits(arrived.select(*EVENT_KEY), self.blooms.read(), sizes))
        opened = parts_of(hits, F.col(PART))
        if not opened:
            return arrived
        known = bounded_broadcast(hits).join(self.ids.read(opened), [*EVENT_KEY, PART], "left_semi").select(*EVENT_KEY)
        known = bounded_broadcast(cut_lineage(known))
        return arrived.join(known, list(EVENT_KEY), "left_anti").select(*arrived.columns)

    # Numbers

    def _add_numbers(self, keys: DataFrame, number: int) -> None:
        if self.tops.applied() >= number:
            return
        if self.runs.applied() < number:
            self.runs.replace(self.merged_runs(keys), number)
        touched = parts_of(keys, block_part("seq_num", NUMBER_BITS))
        heights = self.runs.read(touched).select(*DEVICE_KEYS, F.col(PART).alias("block"), "hi")
        known = self.tops.read().drop(PART).unionByName(heights)
        tops = known.groupBy(*DEVICE_KEYS, "block").agg(F.max("hi").alias("hi"))
        self.tops.replace(tops.withColumn(PART, F.lit(ALL)), number)

    def merged_runs(self, keys: DataFrame, also: DataFrame | None = None) -> DataFrame:
        """Runs of the blocks that rows touch, with the rows' numbers added."""
        part = block_part("seq_num", NUMBER_BITS)
        touched = parts_of(keys.select("seq_num") if also is None else keys.select("seq_num").union(also.select("seq_num")), part)
        old = self.runs.read(touched).drop(PART)
        merged = merge_runs(old.unionByName(as_runs(keys, DEVICE_KEYS, "seq_num")), DEVICE_KEYS)
        return merged.withColumn(PART, block_part("lo", NUMBER_BITS))

    def with_previous(self, fresh: DataFrame, ready: DataFrame | None) -> DataFrame:
        """The number before each row's own, among all numbers of its device so far and those of the slice.

        A new row with a number that was seen before follows that number. ``ready`` rows waited, so their
        own numbers have been seen; they look below them.
        """
        part = block_part("seq_num", NUMBER_BITS)
        blocks = parts_of(fresh, part)
        old = self.runs.read(blocks).drop(PART)
        both = fresh.select(*DEVICE_KEYS)
        devices = bounded_broadcast((both if ready is None else both.unionByName(ready.select(*DEVICE_KEYS))).distinct())
        tops = self.tops.read().drop(PART, "block").join(devices, list(DEVICE_KEYS), "left_semi")

        def ends(runs: DataFrame) -> DataFrame:
            below = runs.select(*DEVICE_KEYS, "hi").unionByName(tops)
            return below.select(*DEVICE_KEYS, F.col("hi").alias("seq_num"), F.lit(None).cast("string").alias(EVENT_KEY[0])).distinct()

        if not set(blocks) & set(self.runs.held()):
            found = previous_seq(fresh, history=ends(old))
        else:
            marked = mark_members(fresh, old, DEVICE_KEYS, "seq_num", "_start")
            new = previous_seq(marked.filter("_start IS NULL").drop("_start"), history=ends(old))
            found = new.unionByName(marked.filter("_start IS NOT NULL").drop("_start").withColumn(PREVIOUS, F.col("seq_num")))
        if ready is None:
            return found
        merged = cut_lineage(self.merged_runs(fresh, ready).drop(PART))
        placed = cut_lineage(mark_members(ready, merged, DEVICE_KEYS, "seq_num", "_start"))
        inside = placed.filter("_start < seq_num").withColumn(PREVIOUS, F.col("seq_num") - 1)
        first = placed.filter("_start IS NULL OR _start >= seq_num").drop("_start")
        others = ends(merged).join(first.select(*DEVICE_KEYS, "seq_num"), [*DEVICE_KEYS, "seq_num"], "left_anti")
        return found.unionByName(inside.drop("_start")).unionByName(previous_seq(first, history=others))

    # Offsets

    def _add_offsets(self, runs: DataFrame, number: int) -> None:
        if self.offsets.applied() >= number:
            return
        touched = parts_of(runs, block_part("lo", OFFSET_BITS))
        merged = merge_runs(self.offsets.read(touched).drop(PART).unionByName(runs), OFFSET_KEYS[:1])
        self.offsets.replace(merged.withColumn(PART, block_part("lo", OFFSET_BITS)), number)

    def unseen_offsets(self, rows: DataFrame, batch: DataFrame) -> DataFrame:
        """Of these rows of a slice, those whose source offset was in no slice before; NULL offsets are always new."""
        touched = parts_of(batch, block_part(OFFSET_KEYS[1], OFFSET_BITS)) if self.offsets.held() else []
        if not set(touched) & set(self.offsets.held()):
            return rows
        marked = mark_members(rows, self.offsets.read(touched).drop(PART), OFFSET_KEYS[:1], OFFSET_KEYS[1], "_start")
        return marked.filter("_start IS NULL").drop("_start")

    # Waiting records

    def ready(self, master: DataFrame) -> DataFrame | None:
        """Waiting records whose zone has arrived in the reference data; None if there are none."""
        if not self.waiting.held():
            return None
        known = bounded_broadcast(master.filter("crop_type IS NOT NULL").select(*ZONE_KEYS))
        found = self.waiting.read().drop(PART).join(known, list(ZONE_KEYS), "left_semi").select(*BRONZE_SCHEMA.names)
        return None if found.isEmpty() else cut_lineage(found)


def month_part() -> Column:
    return F.coalesce(F.date_format("kpi_date", "yyyy-MM"), F.lit(UNDATED))


def kpi_state(silver: DataFrame) -> DataFrame:
    return kpi_partials(silver).withColumn(PART, month_part())


def current_state(silver: DataFrame) -> DataFrame:
    return latest_per_key(silver).withColumn(PART, F.lit(ALL))


def _bits(key: str) -> list[Column]:
    return [F.expr(f"pmod(xxhash64({key}, {k}), {BUCKET_BITS})") for k in range(1, HASHES + 1)]


def bloom_filters(ids: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """One bitmap per part and bucket; ``sizes`` gives the buckets of each part."""
    key = EVENT_KEY[0]
    buckets = F.element_at(F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]), F.col(PART)) if sizes else F.lit(1)
    placed = ids.select(
        PART, F.pmod(F.xxhash64(key), buckets).cast("int").alias("bucket"), F.explode(F.array(*_bits(key))).alias("bit")
    )
    return placed.groupBy(PART, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def bloom_hits(ids: DataFrame, blooms: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """``event_id`` and part of all ids that a part's filter may hold."""
    key = EVENT_KEY[0]
    parts = F.array(*[F.struct(F.lit(p).alias("part"), F.lit(n).alias("n")) for p, n in sizes.items()])
    asked = ids.select(key, F.explode(parts).alias("p")).select(
        key, F.col("p.part").alias(PART), F.pmod(F.xxhash64(key), F.col("p.n")).cast("int").alias("bucket")
    )
    met = asked.join(blooms, [PART, "bucket"])
    held = [
        F.expr(f"(CAST(conv(hex(substring(bits, CAST(b{k} DIV 8 AS INT) + 1, 1)), 16, 10) AS INT) >> CAST(b{k} % 8 AS INT)) & 1 = 1")
        for k in range(HASHES)
    ]
    tested = met.select("*", *[b.alias(f"b{k}") for k, b in enumerate(_bits(key))])
    return tested.filter(reduce(Column.__and__, held)).select(key, PART)
