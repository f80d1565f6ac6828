import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import jaccard_join as J
from fieldgauge.llm.components import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    """Least id reachable, over all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(n=160, seed=2):
    r = random.Random(seed)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for i in range(n):
        words = [f"w{r.randrange(3000)}" for _ in range(r.choice([0, 2, 4, 5, 9, 30, 80]))]
        if r.random() < 0.4:
            words[len(words) // 2 : len(words) // 2] = passage[: r.choice([20, 60])]
        if rows and r.random() < 0.6:
            words = rows[r.randrange(len(rows))][1].split()
            for _ in range(r.randrange(4)):
                if words:
                    words[r.randrange(len(words))] = f"e{r.randrange(99)}"
        rows.append((i, " ".join(words).title() if i % 5 == 0 else " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [2, 3])
def test_components_against_brute_force(spark, seed):
    rows = corpus(seed=seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df).collect()}
    assert got == brute(rows)


def test_small_blocks_and_buckets_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_ROWS", 3)
    monkeypatch.setattr(J, "BUCKET_SETS", 2)
    rows = corpus(seed=7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for sample in (0, 4_000):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df, sample_docs=sample).collect()}
        assert got == brute(rows)


def test_chain_of_links_that_no_leader_sees(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*words[i * 4 :], *[f"x{i}_{k}" for k in range(i * 4)]])) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df).collect()} == brute(rows)


def test_pairs_that_no_round_of_leaders_finds(spark, monkeypatch):
    passage, other = [f"p{k}" for k in range(60)], [f"q{k}" for k in range(60)]
    near = [f"a{k}" for k in range(60)]
    rows = [(i, " ".join([*passage, *other, *[f"x{i}_{k}" for k in range(60)]])) for i in range(2, 42)]
    rows += [(i, " ".join([*passage, *near, *near[::-1], f"end{i}"])) for i in (0, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept, real = [], J.possible_pairs
    monkeypatch.setattr(J, "possible_pairs", lambda *a: kept.append(real(*a)) or kept[-1])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df, sample_docs=0).collect()}
    assert [k.count() for k in kept[: J.ROUNDS]] == [0] * J.ROUNDS
    assert got == brute(rows) and got[1][1] == 0


def test_frequent_tokens_are_bounded(spark, monkeypatch):
    rows = [(i, " ".join([*"abcdefghij"[: 5 + i], *[f"x{i // 2}_{k}" for k in range(30)]])) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    tokens, counts = J.frequent_tokens(df, 5, 100)
    assert len(tokens) > 60 and (np.diff(tokens.astype(object)) > 0).all()
    monkeypatch.setattr(J, "HEAVY_TOKENS", 4)
    few, most = J.frequent_tokens(df, 5, 100)
    assert sorted(most) == [3, 4, 5, 6] and set(few) <= set(tokens) and max(counts) == 6
    monkeypatch.setattr(J, "HEAVY_TOKENS", 0)
    assert len(J.frequent_tokens(df, 5, 100)[0]) == 0


def test_trie_overlaps_against_sets():
    r = np.random.default_rng(1)
    for _ in range(60):
        base = np.unique(r.integers(0, 2**63, r.integers(1, 300)).astype(np.uint64))
        sets = []
        for _ in range(12):
            kept = base[r.random(len(base)) > r.choice([0, 0.05, 0.12, 0.5])]
            more = r.integers(0, 2**63, r.integers(0, 30)).astype(np.uint64)
            sets.append(np.unique(np.concatenate([kept, more])))
        want = [bool(len(s)) and 100 * len(set(s) & set(base)) >= 80 * len(set(s) | set(base)) for s in sets]
        assert J.trie_overlaps(base, sets).tolist() == want


def test_parity_sketch_never_exceeds_the_difference():
    r = np.random.default_rng(4)
    for n in (10, 900, 3_000):
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[r.random(len(a)) > 0.2], r.integers(0, 2**63, n // 5).astype(np.uint64)]))
        x, y = (np.frombuffer(J.parity_sketch(s), np.uint64) for s in (a, b))
        words = min(len(x), len(y))
        x, y = J.folded(x, words), J.folded(y, words)
        assert np.bitwise_count(x ^ y).sum() <= len(set(a) ^ set(b))


def test_edges(spark, documents):
    odd = [(1, None, None, None), (2, "", None, None), (3, " \t\n", "en", "s"), (4, "one two", None, None), (5, "ONE two", None, None),
           (6, "w " * 60_000 + "end", None, None), (7, "W " * 60_000 + "end", None, None), (8, "a b c d e f", None, None), (8, "a b c d e f", None, None),
           (None, "a b c d e f", None, None), (None, None, None, None)]
    got = sorted([tuple(r) for r in J.jaccard_components(documents(odd)).collect()], key=str)
    assert len(got) == len(odd)
    assert {k: c for k, _, c in got if k} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6, 8: 8}
    assert [(n, c) for k, n, c in got if k is None and n] == [(2, None)]
    assert {n for k, n, _ in got if k in (6, 7)} == {2}
    assert J.jaccard_components(documents([])).count() == 0


def test_keep_one(documents):
    rows = [(3, "a b c d e f g h i", "en", "s"), (2, "A b c d e f g h i", "en", "s"), (2, "A b c d e f g h i", "en", "s"), (5, "other words here", "en", "s"),
            (None, "a b c d e f g h i", None, None), (6, None, None, None), (7, None, None, None)]
    docs = documents(rows).withColumn("component_id", F.lit("mine"))
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 2, 5, 6, 7]


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 101), (103, 101), (7, 7), (None, 3), (60, 5), (60, 5)] + [(200, 300 + i) for i in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in [*range(51), 60]} == {0} and {got[i] for i in (100, 101, 103)} == {100}
    assert {got[300 + i] for i in range(40)} == {200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_with_columns_named_like_those_used_inside(documents):
    docs = documents([(1, "a b c d e f", "en", "s"), (2, "a b c d e f", "en", "s"), (None, "x", "en", "s")])
    named = docs.selectExpr("*", "1 AS _print", "2 AS _kept", "3 AS _id", "4 AS _row", "5 AS component_id")
    kept = J.keep_one(named)
    assert kept.columns == named.columns and sorted(map(str, (r["doc_id"] for r in kept.collect()))) == ["1", "None"]
