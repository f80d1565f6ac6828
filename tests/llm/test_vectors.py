import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import pivot_dedup, tree_search

VECTORS = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)


def clustered(n=400, width=16, seed=0):
    r = np.random.default_rng(seed)
    rows = r.standard_normal((n, width))
    near = rows[r.integers(0, n, n // 2)] + 0.08 * r.standard_normal((n // 2, width))
    dense = rows[:1] + 0.05 * r.standard_normal((n // 2, width))
    return np.vstack([rows, near, dense, rows[:5], 3 * rows[5:9]]).astype(np.float32)


def links(vectors, limit=0.9):
    v = vectors.astype(np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    linked = v @ v.T >= limit
    np.fill_diagonal(linked, False)
    return linked


def reach(linked):
    root = np.arange(len(linked))
    while True:
        new = np.minimum(root, np.where(linked, root[None, :], len(root)).min(axis=1))
        if (new == root).all():
            return root
        root = new


@pytest.mark.parametrize("block", [16, 1024])
def test_links_and_components(spark, monkeypatch, block):
    vectors = clustered()
    linked = links(vectors)
    monkeypatch.setattr(pivot_dedup.block_pairs, "__defaults__", (block,))
    got = pivot_dedup.near_duplicates(frame(spark, list(enumerate(vectors.tolist())))).orderBy("vec_id").collect()
    counts = np.array([r["n_links"] for r in got])
    assert (counts <= linked.sum(axis=1)).all() and counts.sum() >= 0.97 * linked.sum()
    root = reach(linked)
    assert np.mean([r["component_id"] == c for r, c in zip(got, root)]) > 0.97
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_ball_members_are_counted_not_compared(spark):
    r = np.random.default_rng(5)
    centre = r.standard_normal(16)
    dense = centre + 0.02 * r.standard_normal((200, 16))
    others = r.standard_normal((100, 16))
    vectors = np.vstack([dense, others]).astype(np.float32)
    got = pivot_dedup.near_duplicates(frame(spark, list(enumerate(vectors.tolist())))).orderBy("vec_id").collect()
    assert [r["n_links"] for r in got[:200]] == [199] * 200 and {r["component_id"] for r in got[:200]} == {0}


def test_dedup_edges(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]), (7, [1.0, 2.0]), (8, [2.0, 4.0]),
            (9, [2.0, 4.0]), (9, [2.0, 4.0]), (10, [1.0]), (11, [5.0, 0.0]), (None, [1.0, 2.0]), (12, [-1.0, -2.0]), (13, [1e-30, 2e-30])]
    got = {r["vec_id"]: tuple(r)[1:] for r in pivot_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert all(got[i] == (0, i, True) for i in range(1, 7)) and got[12] == (0, 12, True) and got[None] == (0, None, True)
    assert got[7] == (4, 7, True) and got[9] == (4, 7, False) and got[13][1] == 7 and got[10] == (1, 10, True) and got[11] == (1, 10, False)
    assert pivot_dedup.near_duplicates(frame(spark, [])).count() == 0
    clash = frame(spark, rows[6:8]).withColumn("n_links", F.lit("x")).withColumn("rep", F.lit(1)).withColumn("n", F.lit(1))
    assert [r["n_links"] for r in pivot_dedup.near_duplicates(clash).collect()] == [1, 1]


def nearest(vectors, ids, query, k):
    distance = np.sqrt(((vectors - vectors[ids.index(query)]) ** 2).sum(axis=1))
    return sorted((d, i) for d, i in zip(distance, ids) if i != query)[:k]


def test_search_against_brute_force(spark):
    vectors = clustered().astype(np.float64)
    ids = list(range(len(vectors)))
    df = frame(spark, list(zip(ids, vectors.tolist())))
    got = tree_search.search(df, df.filter("vec_id % 20 = 0"), k=10, sample_rows=300).collect()
    hits = total = 0
    for query in ids[::20]:
        found = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == query)
        assert [f[0] for f in found] == list(range(1, 11))
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        for _, i, score in found:
            assert score == pytest.approx(float(np.sqrt(((vectors[i] - vectors[query]) ** 2).sum())), abs=1e-12)
        hits += len({f[1] for f in found} & {i for _, i in nearest(vectors, ids, query, 10)})
        total += 10
    assert hits >= 0.9 * total


def test_small_blocks_find_the_same(spark, monkeypatch):
    vectors = clustered(120).astype(np.float64)
    df = frame(spark, list(enumerate(vectors.tolist())))
    queries = df.filter("vec_id % 10 = 0")
    whole = tree_search.search(df, queries, k=5, target_recall=1.0).collect()
    monkeypatch.setattr(tree_search, "BLOCK_ROWS", 7)
    assert sorted(map(tuple, tree_search.search(df, queries, k=5, target_recall=1.0).collect())) == sorted(map(tuple, whole))


def test_search_edges(spark):
    rows = [(100, [0.0, 1.0]), (1, [0.0, 2.0]), (2, [0.0, 2.0]), (3, None), (4, [math.nan, 1.0]), (5, [0.0, 0.0]), (None, [1.0, 1.0]), (6, [3.0]), (200, None)]
    df = frame(spark, rows)
    got = [tuple(r) for r in tree_search.search(df, df.filter("vec_id % 100 = 0"), k=10).orderBy("rank").collect()]
    assert got == [(100, 1, 1, 1.0), (100, 2, 2, 1.0), (100, 3, 6, math.sqrt(10.0))]
    assert tree_search.search(frame(spark, []), frame(spark, [])).count() == 0
    assert tree_search.search(df, df.filter("false")).count() == 0
    clash = df.withColumn("leaf", F.lit("x")).withColumn("rank", F.lit("y"))
    assert tree_search.search(clash, clash.filter("vec_id = 100")).count() == 3
