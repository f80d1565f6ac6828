import re

import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import mixing


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Brute force: share what is left among the sources that are not capped, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(cap * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in free))
        above = {s for s in free if weight[s] * level > cap * sizes[s]}
        if not above:
            return {s: cap * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= above


def rows(n=600):
    return [(i, "word " * (1 + i * i % 37), "en", ("b", "a", None, "c", "é")[i % 7 % 5]) for i in range(n)]


def test_targets_and_rates(documents):
    plan = mixing.mix_plan(documents(rows())).collect()
    sizes = {}
    for r in plan:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    wanted, taken = targets(sizes), dict.fromkeys(sizes, 0)
    for r in plan:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(wanted[r["source"]])
        assert r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) and r["copies"] <= 3
        taken[r["source"]] += r["size"] * r["copies"]
    for source, words in taken.items():
        assert words == pytest.approx(wanted[source], abs=60)


def test_capped_source_passes_its_excess_on(documents):
    docs = documents([(1, "x", "en", "a"), *[(i, "one two three four", "en", "b") for i in range(2, 40)]])
    by_source = {r["source"]: r for r in mixing.mix_plan(docs).collect()}
    assert by_source["a"]["target"] == 3.0
    assert by_source["b"]["target"] == 1 + 4 * 38 - 3


def test_reruns_agree_and_mix_emits_copies(documents):
    docs = documents(rows(200))
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    found = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert found == {k: n for k, n in plan.items() if n}


def test_edges(spark, documents):
    assert mixing.mix_plan(documents([])).count() == 0 and mixing.mix(documents([])).count() == 0
    odd = documents([(None, None, None, None), (None, "", None, "a"), (3, "w " * 100_000, None, "a"), (3, "w " * 100_000, None, "a")])
    plan = mixing.mix_plan(odd).collect()
    assert sorted(r["size"] for r in plan) == [0, 0, 100_000, 100_000]
    assert [r["copies"] for r in plan if r["source"] is None] == [0]
    assert len({r["copies"] for r in plan if r["doc_id"] == 3}) == 1  # repeated rows share their draw
    clash = documents(rows(50)).withColumn("size", F.lit("mine")).withColumn("RATE", F.lit(7)).withColumn("copies", F.lit(9))
    assert set(mixing.mix_plan(clash).columns) == {"doc_id", "text", "lang", "source", "n_chars", "size", "source_size", "target", "rate", "copies"}
    assert mixing.mix(clash).select("size", "RATE").distinct().collect() == [("mine", 7)]


def test_input_columns_named_like_those_used_inside(documents):
    docs = documents(rows(90))
    named = docs.selectExpr("*", "1 AS rotation", "2 AS _draw", "3 AS _row", "4 AS _source", "5 AS _of", "6 AS target")
    plain = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(docs).collect()}
    got = mixing.mix_plan(named).collect()
    assert {r["doc_id"]: r["copies"] for r in got} == plain
    assert {(r["rotation"], r["_draw"], r["_row"], r["_source"], r["_of"]) for r in got} == {(1, 2, 3, 4, 5)}
    mixed = mixing.mix(named)
    assert mixed.columns == named.columns and mixed.count() == sum(plain.values())
