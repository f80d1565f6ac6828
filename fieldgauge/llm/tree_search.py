"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample and holds centres only; every row is dealt to its leaf. A query
walks the tree best bin first: a priority queue of branches, nearest centre first, gives the leaves in
the order in which they are visited. How many are visited is calibrated: sample queries are answered by
brute force against all rows, and leaf visits are widened until the wanted share of their true
neighbours is reached. Leaves and the queries that visit them are cut into blocks of bounded size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldgauge.llm.staging import cut_lineage
from fieldgauge.llm.streams import each_group
from fieldgauge.llm.vectors import matrix, usable

#: Expected rows the tree is fitted on, children of a node, and rows of the sample a leaf keeps.
SAMPLE_ROWS = 8_000
BRANCHING = 8
LEAF_SAMPLE = 64
#: Queries the number of leaf visits is calibrated with, and the share of neighbours to reach.
CALIBRATION_ROWS = 128
TARGET_RECALL = 0.98
#: Rows of a leaf, and queries, that one task compares at a time.
BLOCK_ROWS = 2_048


@dataclass
class Tree:
    """Nodes in arrays: ``children[i]`` lists node numbers, none for a leaf."""

    centres: np.ndarray
    children: list[list[int]]
    leaf_number: np.ndarray  # -1 for inner nodes
    leaves: int

    def order(self, query: np.ndarray) -> list[int]:
        """All leaves, best bin first."""
        queue, visited = [(0.0, 0)], []
        while queue:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                visited.append(int(self.leaf_number[node]))
                continue
            distance = ((self.centres[below] - query) ** 2).sum(axis=1)
            for d, child in zip(distance.tolist(), below):
                heapq.heappush(queue, (d, child))
        return visited

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf each row belongs to, by descending to the nearest child."""
        leaf = np.zeros(len(rows), np.int64)
        stack = [(0, np.arange(len(rows)))]
        while stack:
            node, members = stack.pop()
            below = self.children[node]
            if not below:
                leaf[members] = self.leaf_number[node]
                continue
            nearest = squared_distances(rows[members], self.centres[below]).argmin(axis=1)
            for i, child in enumerate(below):
                if (nearest == i).any():
                    stack.append((child, members[nearest == i]))
        return leaf


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By the expanded form: fast, and good enough to choose a branch."""
    return (a**2).sum(axis=1)[:, None] - 2 * a @ b.T + (b**2).sum(axis=1)


def _kmeans(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(rounds):
        nearest = squared_distances(rows, centres).argmin(axis=1)
        used = np.unique(nearest)
        centres = np.stack([rows[nearest == i].mean(axis=0) for i in used])
    return centres, squared_distances(rows, centres).argmin(axis=1)


def fit_tree(sample: np.ndarray, branching: int = BRANCHING, leaf_sample: int = LEAF_SAMPLE, seed: int = 11) -> Tree:
    rng = np.random.default_rng(seed)
    width = sample.shape[1]
    centres, children, stack = [np.zeros(width)], [[]], [(0, np.arange(len(sample)))]
    while stack:
        node, members = stack.pop()
        if len(members) <= leaf_sample:
            continue
        middle, nearest = _kmeans(sample[members], branching, rng)
        used = np.unique(nearest)
        if len(used) < 2:
            continue  # equal rows do not divide
        for i in used:
            children[node].append(len(centres))
            stack.append((len(centres), members[nearest == i]))
            centres.append(middle[i])
            children.append([])
    leaf = np.array([not c for c in children])
    return Tree(np.stack(centres), children, np.where(leaf, np.cumsum(leaf) - 1, -1), int(leaf.sum()))


def exact_distances(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision from differences, some queries at a time."""
    out = np.empty((len(queries), len(rows)))
    step = max(1, 2**21 // max(1, rows.size))
    for a in range(0, len(queries), step):
        out[a : a + step] = np.sqrt(((queries[a : a + step, None, :] - rows[None, :, :]) ** 2).sum(axis=2))
    return out


def nearest_in_block(queries, query_ids, rows, row_ids, k: int):
    """Row numbers and distances of each query's ``k`` nearest rows, ties to the smaller id.

    Distances by the expanded form pick those that may be among them, with a margin above its error;
    exact distances decide.
    """
    rough = squared_distances(queries, rows)
    slack = 1e-9 * ((queries**2).sum(axis=1)[:, None] + (rows**2).sum(axis=1).max(initial=0))
    own = row_ids[None, :] == query_ids[:, None]
    rough[own] = np.inf
    for i in range(len(queries)):
        if len(rows) > k:
            limit = np.partition(rough[i], k - 1)[k - 1] + slack[i]
            near = np.flatnonzero((rough[i] <= limit) & ~own[i])
        else:
            near = np.flatnonzero(~own[i])
        distance = exact_distances(queries[i : i + 1], rows[near])[0]
        best = np.lexsort((row_ids[near], distance))[:k]
        yield i, near[best], distance[best]


FOUND = "query_id long, vec_id long, score double"


def _emit(query_id, row_ids, scores):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(query_id)), pa.array(np.concatenate(row_ids)), pa.array(np.concatenate(scores))],
        ["query_id", "vec_id", "score"],
    )


def _search_blocks(width: int, k: int):
    """Blocks of a leaf with the queries that visit it, sorted by leaf and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each_group(batches, ["leaf", "block", "query_block"]):
            asks = block.column("is_query").to_numpy(zero_copy_only=False)
            ids = block.column("vec_id").to_numpy()
            rows = matrix(block.column("vector").combine_chunks(), width)
            if not asks.any() or asks.all():
                continue
            found = [(np.full(len(near), ids[asks][i]), ids[~asks][near], score) for i, near, score in
                     nearest_in_block(rows[asks], ids[asks], rows[~asks], ids[~asks], k)]
            if found:
                yield _emit(*zip(*found))

    return run


def _brute_force(queries: np.ndarray, ids: np.ndarray, width: int, k: int):
    """Each partition's nearest rows of a bounded set of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, row_ids = matrix(batch.column("vector"), width), batch.column("vec_id").to_numpy()
            for a in range(0, len(rows), BLOCK_ROWS):
                part, part_ids = rows[a : a + BLOCK_ROWS], row_ids[a : a + BLOCK_ROWS]
                found = [(np.full(len(near), ids[i]), part_ids[near], score)
                         for i, near, score in nearest_in_block(queries, ids, part, part_ids, k)]
                if found:
                    yield _emit(*zip(*found))

    return run


def first_k(found: DataFrame, k: int) -> DataFrame:
    """Ranks from 1, nearest first, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _drawn(rows: DataFrame, n: int, total: int, salt: str) -> DataFrame:
    share = min(1.0, n / max(total, 1))
    return rows.filter(F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(2**30)) < share * 2**30)


def _to_numpy(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    table = rows.select("vec_id", "vector").toArrow()
    if not table.num_rows:
        return np.zeros(0, np.int64), np.zeros((0, width))
    return table.column("vec_id").to_numpy(), matrix(table.column("vector").combine_chunks(), width)


def calibrate(
    rows: DataFrame, tree: Tree, width: int, total: int, k: int, queries: int = CALIBRATION_ROWS, target: float = TARGET_RECALL
) -> tuple[int, float]:
    """Leaves to visit so that sample queries find ``target`` of their true ``k`` neighbours; and the share found.

    The truth comes from one pass over all rows; the driver gets ``k`` rows per sample query.
    """
    ids, vectors = _to_numpy(_drawn(rows, queries, total, "calibrate"), width)
    if not len(ids) or tree.leaves == 1:
        return 1, 1.0
    nearest = first_k(rows.mapInArrow(_brute_force(vectors, ids, width, k), FOUND), k)
    truth = nearest.join(rows.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").toPandas()
    depth = []
    for number, vector in zip(ids, vectors):
        place = np.empty(tree.leaves, np.int64)
        place[tree.order(vector)] = np.arange(tree.leaves)
        depth.append(place[truth.loc[truth["query_id"] == number, "leaf"].to_numpy()])
    depth = np.concatenate(depth)
    reached = np.searchsorted(np.sort(depth), np.arange(tree.leaves), "right") / max(len(depth), 1)
    visits = int(np.searchsorted(reached, target)) + 1
    return min(visits, tree.leaves), float(reached[min(visits, tree.leaves) - 1])


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
    sample_rows: int = SAMPLE_ROWS, target_recall: float = TARGET_RECALL, calibration_rows: int = CALIBRATION_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows found, by Euclidean distance in doubles.

    ``queries`` has the columns of ``vectors``. A row is no candidate for the query of its own id.

    * Vectors that are NULL, empty, zero, or hold NULL or non-finite components take no part, nor do
      rows with a NULL id. Shorter vectors are read as ending in zeros.
    * Equal distances are ranked by id. Repeated rows are candidates once each; of queries with one id
      one is answered.
    * A query widens its visits beyond the calibrated number until it has met ``k`` candidates, so with
      fewer rows it gets all. No queries or no rows give no result.
    * At most about ``sample_rows`` rows reach the driver, where the tree is fitted.
    """
    def clean(df):
        return df.filter(F.col(vec_id).isNotNull() & usable(vector)).select(
            F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
        )

    rows, asks = clean(vectors), clean(queries).dropDuplicates(["vec_id"])
    total, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    wider = asks.agg(F.max(F.size("vector"))).first()[0] or 1
    width = max(width, wider)
    _, sample = _to_numpy(_drawn(rows, sample_rows, total, "fit"), width)
    tree = fit_tree(sample if len(sample) else np.zeros((1, width)))
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def assign(batches):
        for batch in batches:
            leaf = shared.value.assign(matrix(batch.column("vector"), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], ["vec_id", "vector", "leaf"])

    indexed = cut_lineage(rows.mapInArrow(assign, "vec_id long, vector array<double>, leaf long"))
    visits, _ = calibrate(indexed, tree, width, total, k, calibration_rows, target_recall)
    sizes = np.zeros(tree.leaves, np.int64)
    for r in indexed.groupBy("leaf").agg(F.count("*").alias("n")).collect():  # one row per leaf
        sizes[r["leaf"]] = r["n"]
    blocks = np.maximum(1, -(-sizes // BLOCK_ROWS))
    plan = rows.sparkSession.sparkContext.broadcast((sizes, blocks))

    def visit(batches):
        """One row per query, leaf and block of the leaf."""
        size, block = plan.value
        for batch in batches:
            vectors_here = matrix(batch.column("vector"), width)
            which, leaf, part = [], [], []
            for i, query in enumerate(vectors_here):
                met = 0
                for n, number in enumerate(shared.value.order(query)):
                    if n >= visits and met > k:
                        break
                    met += size[number]
                    which += [i] * block[number]
                    leaf += [number] * block[number]
                    part += range(block[number])
            taken = batch.take(pa.array(which, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(leaf, pa.int64()), pa.array(part, pa.int64())], ["vec_id", "vector", "leaf", "block"]
            )

    of_leaf = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), (F.col("leaf") + 1).cast("int"))
    placed = indexed.withColumn("block", F.pmod(F.xxhash64("vec_id"), of_leaf.cast("long")))
    visiting = asks.mapInArrow(visit, "vec_id long, vector array<double>, leaf long, block long")
    # Of very many queries at one leaf a task takes a block as well; the leaf's rows are repeated for each.
    query_blocks = max(1, -(-asks.count() // (BLOCK_ROWS * 4)))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long")))
    together = placed.select("leaf", "block", every.alias("query_block"), F.lit(False).alias("is_query"), "vec_id", "vector").unionByName(
        visiting.select("leaf", "block", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).alias("query_block"),
                        F.lit(True).alias("is_query"), "vec_id", "vector")
    )
    keys = ["leaf", "block", "query_block"]
    found = together.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_search_blocks(width, k), FOUND)
    return first_k(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
