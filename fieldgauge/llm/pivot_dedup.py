"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its nearest reference points, in order. Inverted lists, one per pivot, hold
the vectors that name it; two vectors of a list that share enough pivots are candidates and are verified
by their cosine in double precision, in the list of the least pivot they share, so each pair is met once.

Equal vectors are one row from the start. A dense group has a pivot in it, as pivots are drawn from the
data, and then forms a ball around it: vectors within half the limit's angle of one pivot are certainly
linked with one another and are counted, not compared. They stand in the list of their own pivot, and in
those of pivots near enough for a link to reach out of the ball.

Lists are cut into blocks, and pairs of blocks are the groups that tasks work on. What leaves a task is
a count per vector and a spanning forest of the links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.components import components
from fieldgauge.llm.staging import cut_lineage
from fieldgauge.llm.streams import each_group
from fieldgauge.llm.vectors import matrix, units, usable

#: Pivots per square root of the number of vectors, and their bounds.
PIVOT_FACTOR = 1.5
LEAST_PIVOTS, MOST_PIVOTS = 32, 4_096
#: Pivots in a description, and how many two vectors must share.
NAMED = 8
SHARED = 3
BLOCK_ROWS = 1_024
#: Angles are rounded; within this of a limit nothing is taken for certain.
SLACK = 1e-6


def spread_pivots(candidates: np.ndarray, angle: float) -> np.ndarray:
    """Candidates in order, leaving out those within ``angle`` of one already taken."""
    taken = np.zeros((0, candidates.shape[1]))
    for c in candidates:
        if not len(taken) or (taken @ c).max() < np.cos(angle):
            taken = np.vstack([taken, c])
    return taken


def _describe(shared, width: int, limit: float, named: int):
    """One row per list a vector stands in, with its description and the ball it is in, or -1."""
    half = np.arccos(limit) / 2 - SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        k = min(named, len(pivots))
        near = np.arccos(np.clip(pivots @ pivots.T, -1, 1)) <= 4 * half + 1e-3
        for batch in batches:
            rows = units(matrix(batch.column("vector"), width))
            cosine = rows @ pivots.T
            order = np.argsort(-cosine, axis=1, kind="stable")[:, :k]
            angle = np.arccos(np.clip(np.take_along_axis(cosine, order, 1), -1, 1))
            home = np.where(angle[:, 0] <= half, order[:, 0], -1)
            # Out of a ball only pivots near its own can lead to a link.
            stands = (home[:, None] < 0) | near[np.maximum(home, 0)[:, None], order]
            row, place = np.nonzero(stands)
            taken = batch.take(pa.array(row))
            columns = {
                **{c: taken.column(c) for c in ("rep", "n", "vector")},
                "pivot": pa.array(order[row, place].astype(np.int64)), "home": pa.array(home[row].astype(np.int64)),
                "angle": pa.array(angle[row, place]),
                "named": _lists(order[row]), "listed": _lists(np.where(stands, order, -1)[row]),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _lists(rows: np.ndarray) -> pa.Array:
    at = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(at), pa.array(rows.ravel().astype(np.int32)))


LISTED = (
    "rep long, n long, vector array<double>, pivot long, home long, angle double, named array<int>, listed array<int>"
)


def _bit_table(numbers: np.ndarray, words: int) -> np.ndarray:
    """Rows of numbers as bit sets; -1 is none."""
    bits = np.zeros((len(numbers), words), np.uint64)
    for k in range(numbers.shape[1]):
        some = np.flatnonzero(numbers[:, k] >= 0)
        bits[some, numbers[some, k] // 64] |= np.uint64(1) << (numbers[some, k] % 64).astype(np.uint64)
    return bits


def least_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number two bit sets share, row by row; -1 if none."""
    least = np.full(len(a), -1)
    for w in range(a.shape[1] - 1, -1, -1):
        common = a[:, w] & b[:, w]
        lowest = np.bitwise_count((common & (~common + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        least = np.where(common != 0, 64 * w + lowest, least)
    return least


def forest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of the component of each of ``size`` nodes under links ``a[i]-b[i]``."""
    root = np.arange(size)
    while True:
        before = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            return root


def _link_blocks(width: int, limit: float, shared: int):
    """Links within a block, or between two, as a count per vector and links to the least member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each_group(batches, ["pivot", "i", "j"]):
            found = links_of(block)
            if found is not None:
                yield found

    def links_of(block: pa.Table):
        ids, n, home, side, pivot = (block.column(c).to_numpy() for c in ("rep", "n", "home", "side", "pivot"))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        within = block.column("i")[0] == block.column("j")[0]
        right = left if within else right
        if not len(left) or not len(right):
            return None
        rows = units(matrix(block.column("vector").combine_chunks(), width))
        named, listed = (block.column(c).combine_chunks().flatten().to_numpy().reshape(len(ids), -1) for c in ("named", "listed"))
        words = int(named.max()) // 64 + 1
        bits, lists = _bit_table(named, words), _bit_table(listed, words)
        firsts, seconds = [], []
        for a in range(0, len(left), 256):
            some = left[a : a + 256]
            common = np.zeros((len(some), len(right)), np.uint8)
            for w in range(words):
                common += np.bitwise_count(bits[some, w][:, None] & bits[right, w][None, :])
            # Members of one ball are linked and counted elsewhere.
            candidate = (common >= shared) & ~((home[some][:, None] == home[right]) & (home[some][:, None] >= 0))
            if within:
                candidate &= np.arange(a, a + len(some))[:, None] < np.arange(len(right))
            i, j = np.nonzero(candidate & (rows[some] @ rows[right].T >= limit))
            i, j = some[i], right[j]
            here = least_common(lists[i], lists[j]) == pivot[0]
            firsts.append(i[here])
            seconds.append(j[here])
        i, j = np.concatenate(firsts), np.concatenate(seconds)
        if not len(i):
            return None
        counts = np.bincount(i, n[j], minlength=len(ids)) + np.bincount(j, n[i], minlength=len(ids))
        root = forest(len(ids), i, j)
        at = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[at]), pa.array(counts[at].astype(np.int64)), pa.array(ids[root[at]])], ["rep", "links", "root"]
        )

    return run


def block_pairs(listed: DataFrame, limit: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of the inverted lists, repeated for every pair of blocks they take part in.

    A list has the members of its pivot's ball and others. Others meet one another; ball members meet
    only others that are near enough for a link, and in a list without such they meet nobody.
    """
    reach = float(np.arccos(limit) * 1.5 + 1e-3)
    rows = listed.withColumn("inside", F.col("home") == F.col("pivot")).withColumn(
        "close", ~F.col("inside") & (F.col("angle") <= reach)
    )
    sizes = rows.groupBy("pivot").agg(
        F.ceil(F.count_if(~F.col("inside")) / block_rows).cast("int").alias("others"),
        F.when(F.count_if("close") > 0, F.ceil(F.count_if("inside") / block_rows)).otherwise(0).cast("int").alias("balls"),
    )
    sized = rows.join(F.broadcast(sizes), "pivot")  # a row per pivot, of which there are at most MOST_PIVOTS
    many = F.when(F.col("inside"), F.col("balls")).otherwise(F.col("others"))
    sized = sized.filter(many > 0).withColumn("own", F.pmod(F.xxhash64("rep"), many).cast("int"))
    none = F.array().cast("array<struct<i:int,j:int,side:int>>")

    def key(i, j, side):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))

    def others(x):
        return F.when(F.col("own") <= x, key(F.col("own"), x, 0)).otherwise(key(x, F.col("own"), 1))

    with_others = F.transform(F.sequence(F.lit(0), F.col("others") - 1), others)
    with_balls = F.when(
        F.col("close") & (F.col("balls") > 0),
        F.transform(F.sequence(F.lit(0), F.col("balls") - 1), lambda c: key(F.col("own"), F.col("others") + c, 0)),
    ).otherwise(none)
    of_ball = F.when(
        F.col("others") > 0,
        F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda b: key(b, F.col("others") + F.col("own"), 1)),
    ).otherwise(none)
    keys = F.when(F.col("inside"), of_ball).otherwise(F.concat(with_others, with_balls))
    return sized.withColumn("key", F.explode(keys)).select(
        "pivot", "key.i", "key.j", "key.side", "rep", "n", "vector", "home", "named", "listed"
    )


def near_duplicates(
    vectors: DataFrame, limit: float = 0.9, vec_id: str = "vec_id", vector: str = "embedding",
    named: int = NAMED, shared: int = SHARED, pivots: int | None = None,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Two vectors link if their cosine is ``limit`` or more; ``n_links`` counts the others linked
    directly, ``component_id`` is the least id that links reach, ``kept`` marks the row that names it.

    * Vectors that are NULL, empty or zero, or hold NULL or non-finite components, link with nothing,
      nor do rows with a NULL id, whose component is NULL and which are kept.
    * Shorter vectors are read as ending in zeros.
    * Repeated rows are vectors of their own, linked with one another. Rows of one id with different
      vectors count as one vector that has the links of all.
    * No pair below the limit links. Pairs whose descriptions share fewer than ``shared`` pivots are not
      found; README has the recall measured.
    """
    spark = vectors.sparkSession
    every = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    valid = F.col("vec_id").isNotNull() & usable("vector")
    nodes = cut_lineage(
        every.filter(valid).groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    )
    total, width = nodes.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    wanted = pivots or int(np.clip(PIVOT_FACTOR * total**0.5, LEAST_PIVOTS, MOST_PIVOTS))
    drawn = nodes.orderBy(F.xxhash64(F.lit("pivot"), "rep"), "rep").select("vector").limit(wanted).toArrow()
    candidates = units(matrix(drawn.column("vector").combine_chunks(), width)) if drawn.num_rows else np.eye(1, width)
    table = spark.sparkContext.broadcast(spread_pivots(candidates, float(np.arccos(limit) / 2)))
    # With few pivots all are named; then sharing must not be asked for beyond their number.
    shared = min(shared, len(table.value))

    listed = cut_lineage(nodes.select("rep", "n", "vector").mapInArrow(_describe(table, width, limit, named), LISTED))
    keys = ["pivot", "i", "j"]
    found = cut_lineage(
        block_pairs(listed, limit).repartition(*keys).sortWithinPartitions(*keys)
        .mapInArrow(_link_blocks(width, limit, shared), "rep long, links long, root long")
    )
    members = listed.filter("home = pivot")
    balls = members.groupBy("home").agg(F.sum("n").alias("all"), F.min("rep").alias("root"))
    in_balls = members.join(F.broadcast(balls), "home").select(
        "rep", (F.col("all") - F.col("n")).alias("links"), "root"
    )
    links = cut_lineage(found.unionByName(in_balls))
    labels = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    of_node = cut_lineage(
        nodes.join(counts, "rep", "left").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
            F.col("vector").alias("_vector"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    joined = every.withColumn("_key", F.when(valid, F.col("vector"))).join(
        of_node, F.col("_key") == F.col("_vector"), "left"
    )
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
