"""Mixing sources to target weights.

One aggregate gives the words of each source; a few aggregates over one row per source settle the
targets; each document is then emitted ``floor(rate)`` times, plus once more if its keyed draw falls
below the fraction. Texts are never shuffled.

A few very long documents can take independent draws far from the target. Every source therefore
rotates its draws by one of ``ROTATIONS`` offsets, the one with which its words come nearest to the
target; a rotated draw is as uniform as the draw itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.staging import cut_lineage, global_rank, small_side, without

WORD = r"[^\x20\x09-\x0D]+"
DRAW_BITS = 52
ROTATIONS = 32
ADDED = ("size", "source_size", "target", "rate", "copies")


def word_count(text: str) -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.size(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def draw(seed: str, *columns: str) -> Column:
    """A number in [0, 1) that depends on the seed and the columns alone."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws(":", F.lit(seed), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("long") / F.lit(float(2**DRAW_BITS))


def source_targets(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """Targets from ``(source, source_size)`` rows: shares by weight, none above ``cap`` times its size.

    Sources take the weights in turn, ordered by code point with NULL last. What a capped source
    cannot take raises the level of the others; each round is one aggregate, and at least one more
    source is capped in each, until none is above.
    """
    ranked = global_rank(sizes, F.asc_nulls_last("source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighted = cut_lineage(
        ranked.withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))).drop("rank")
    )
    level, capped_before = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > F.lit(cap) * F.col("source_size")
        total, taken, free, capped = weighted.agg(
            F.sum("source_size"),
            F.sum(F.when(above, F.col("source_size")).otherwise(0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
            F.count_if(above),
        ).first()
        if capped == capped_before or not total or not free:
            break
        capped_before = capped
        level = (total - cap * taken) / free
    share = F.col("weight") * F.lit(level)
    limit = F.lit(float(cap)) * F.col("source_size")
    return weighted.withColumn("target", F.when(share > limit, limit).otherwise(share))


def mix_plan(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    cap: float = 3,
    seed: str = "mix",
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Every document with ``size``, ``source_size``, ``target``, ``rate`` and ``copies``.

    * The draw depends on the seed, the id and the text, so repeated rows share it and reruns agree.
    * A NULL text has size 0. A NULL source is a source of its own, the last one.
    * A source without any word has target 0, and none of its documents is emitted. An empty document
      of another source is emitted at that source's rate and costs nothing.
    * Input columns named like one of the added ones are replaced. An empty table stays empty.
    """
    names = without(docs, *ADDED).columns
    plan = _planned(_packed(docs, names, doc_id, text, source), weights, cap, seed)
    return plan.select(*[F.col("_row").getField(c).alias(c) for c in names], *ADDED)


def _packed(docs: DataFrame, names: Sequence[str], doc_id: str, text: str, source: str) -> DataFrame:
    """The columns ``names`` as a struct, so that none of them meets one used here, and those that decide."""
    told = {"_id": doc_id, "_text": text, "_of": source}
    kept = [F.col(f"`{c}`") for c in names] or [F.lit(None).cast("int").alias("none")]
    return docs.select(F.struct(*kept).alias("_row"), *[F.col(f"`{c}`").alias(k) for k, c in told.items()])


def _planned(packed: DataFrame, weights: Sequence[float], cap: float, seed: str) -> DataFrame:
    """``_row`` and the added columns."""
    sized = packed.select("_row", "_of", word_count("_text").alias("size"), draw(seed, "_id", "_text").alias("_draw"))
    slim = cut_lineage(sized.select(F.col("_of").alias("source"), "size", "_draw"))
    sizes = cut_lineage(slim.groupBy("source").agg(F.sum("size").alias("source_size")))
    targets = source_targets(sizes, weights, cap).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    ).select(F.col("source").alias("_source"), "source_size", "target", "rate")
    settled = rotations(slim, cut_lineage(targets))
    joined = sized.join(small_side(settled), F.col("_of").eqNullSafe(F.col("_source")), "left")
    return joined.withColumn("copies", copies(F.col("rotation"))).select("_row", *ADDED)


def copies(rotation: Column) -> Column:
    """``floor(rate)`` and the Bernoulli copy of a row with ``rate`` and ``_draw``."""
    turned = F.col("_draw") + rotation / F.lit(float(ROTATIONS))
    turned = F.when(turned >= 1, turned - 1).otherwise(turned)
    whole = F.floor("rate")
    return (whole + (turned < F.col("rate") - whole).cast("int")).cast("int")


def rotations(slim: DataFrame, targets: DataFrame) -> DataFrame:
    """The targets with the rotation that suits each source best; one aggregate for all rotations."""
    rated = slim.join(small_side(targets), F.col("source").eqNullSafe(F.col("_source")))
    taken = [F.sum(F.col("size") * copies(F.lit(k))).alias(f"taken_{k}") for k in range(ROTATIONS)]
    best = F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"taken_{k}") - F.col("target")).alias("off"), F.lit(k).alias("rotation"))
        for k in range(ROTATIONS)
    ]))
    found = rated.groupBy("_source", "source_size", "target", "rate").agg(*taken)
    return cut_lineage(found.select("_source", "source_size", "target", "rate", best["rotation"].alias("rotation")))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (5, 2, 1), cap: float = 3, seed: str = "mix",
) -> DataFrame:
    """The mixed corpus: each row as often as ``mix_plan`` says, in the columns of ``docs``, whatever their names."""
    plan = _planned(_packed(docs, docs.columns, doc_id, text, source), weights, cap, seed)
    copied = plan.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
    return copied.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
