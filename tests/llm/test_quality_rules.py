import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import quality_rules
from fieldgauge.llm.queries import op13_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside),
    }


def passes(text):
    m, text = brute(text), text or ""
    letters, capitals = sum(c.isalpha() for c in text), sum(c.isupper() for c in text)
    return not (
        m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"] or 100 * m["n_symbols"] > 10 * m["n_words"]
        or not 2 * m["n_words"] <= m["word_chars"] <= 12 * m["n_words"] or 100 * m["n_dup_lines"] > 30 * m["n_lines"]
        or 100 * letters < 55 * m["word_chars"] or 100 * capitals > 60 * letters
        or 100 * len(re.findall(r"(?m)^[ \t]*[-*•]", text)) > 90 * m["n_lines"]
    )


def texts():
    r = random.Random(4)
    vocabulary = ["ab", "cde", "fgh", "é", "THE", "of", "a#b", "|", "x\x1cy", "ß", "漢字", "-", "12"]
    made = [
        "".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "\n", "\t", "\n\n", "\x0b", "  ", "\r\n"]) for _ in range(r.randrange(200)))
        for _ in range(120)
    ]
    prose = " ".join("".join(r.choices("abcdefghij", k=r.randrange(2, 9))) for _ in range(120))
    return made + [prose, prose.upper(), prose + " # $" * 20, "- " + prose.replace(" ", "\n- "), (prose + "\n") * 2, prose.replace(" ", "12345678 ")]


def test_measures_and_verdicts_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    found = quality_rules.judge(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    verdicts = set()
    for row in found:
        text = row["row"]["text"]
        want = brute(text)
        assert {m: row[m] for m in quality_rules.MEASURES} == want, text
        assert row["base_failed"] == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        assert row["kept"] == passes(text), text
        verdicts.add((row["base_failed"], row["kept"]))
    assert verdicts == {(True, False), (False, False), (False, True)} and len(found) == len(rows)


def test_equal_hashes_do_not_make_windows_equal(spark, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr(quality_rules.F, "xxhash64", lambda *c: real(*c) * 0)
    rows = [(1, "a b c d e f"), (2, "a b c x a b c"), (3, "a a a a a")]
    found = quality_rules.measured(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["row"]["doc_id"]: r["n_repeat_words"] for r in found} == {1: 0, 2: 6, 3: 5}


def test_edges(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, " \n\t\x0b\x0c\r"), (3, "a"), (4, "a b"), (5, "one\n\none\none \none"), (6, "a b c a b c")]
    found = quality_rules.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows) and all(r["base_failed"] and not r["kept"] for r in found)
    for row in found:
        assert {m: row[m] for m in quality_rules.MEASURES} == brute(row["row"]["text"])
    assert quality_rules.judge(spark.createDataFrame([], SCHEMA)).collect() == []


def test_clashing_columns_stay(spark):
    schema = "text string, n_words int, kept string, row int, _m int, _words string, `a.b` map<string,int>"
    df = spark.createDataFrame([("x y", 9, "k", 3, 4, "w", {"k": 1})], schema)
    (row,) = quality_rules.judge(df).collect()
    assert row["n_words"] == 2 and row["kept"] is False
    assert row["row"].asDict() == {"text": "x y", "n_words": 9, "kept": "k", "row": 3, "_m": 4, "_words": "w", "a.b": {"k": 1}}


def test_long_text(spark):
    words = [f"w{i}" for i in range(60_000)] + ["x", "y", "z"] * 30_000
    (row,) = quality_rules.measured(spark.createDataFrame([(1, " ".join(words))], SCHEMA)).collect()
    assert (row["n_words"], row["n_repeat_words"]) == (150_000, 90_000)


def test_order_by_rejections_per_second():
    # Fail together, as bits: cheap 0b001, dear 0b010, twin 0b100 of the dear one.
    costs = {"cheap": 1.0, "dear": 10.0, "twin": 2.0}
    together = {0b000: 50, 0b001: 10, 0b110: 40}
    assert quality_rules.cascade_order(costs, together) == ["twin", "cheap", "dear"]
    assert quality_rules.cascade_order({"a": 2.0, "b": 1.0}, {}) == ["b", "a"]


def test_later_rules_are_not_evaluated_for_rejected_rows(spark):
    rules = {"first": "n < 5", "second": "raise_error('evaluated') IS NOT NULL"}
    df = spark.range(5).select(F.col("id").alias("n"))
    assert [r[0] for r in df.select(quality_rules.cascade(rules, ["first", "second"])).collect()] == [False] * 5


def test_no_python_on_the_main_path(spark):
    plan = quality_rules.judge(spark.createDataFrame(spark.range(3).selectExpr("string(id) AS text").toArrow()))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString().replace("PythonRDD", "")


@pytest.mark.parametrize("order", [0, 1])
def test_verdict_does_not_depend_on_the_order(spark, monkeypatch, order):
    monkeypatch.setattr(quality_rules, "cascade_order", lambda costs, _: sorted(costs, reverse=bool(order)))
    found = quality_rules.judge(spark.createDataFrame(list(enumerate(texts())), SCHEMA)).collect()
    assert all(r["kept"] == passes(r["row"]["text"]) for r in found)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = {r["doc_id"]: r for r in op13_quality_rules(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert {d: r["kept"] for d, r in found.items()} == {d: passes(t) for d, t in docs}
