import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldgauge.llm import periodic
from fieldgauge.llm.queries import op12_periodic_runs, planted_periods
from fieldgauge.llm.words import split_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, min_length=6, min_exponent=4):
    """Runs by comparing words period by period."""
    n, runs = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_exponent * q):
                runs.setdefault((i, j + q - i), q)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in runs.items())


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def by_trees(texts, *limits, **options):
    rows = periodic.find_runs(split_words(pa.array(texts)), *limits, **options).tolist()
    return [[tuple(r[1:]) for r in rows if r[0] == i] for i in range(len(texts))]


pieces = st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=6), st.integers(1, 9))
texts_of_runs = st.lists(pieces, max_size=5).map(lambda parts: " ".join(w for p, k in parts for w in p * k))


@given(st.lists(texts_of_runs, min_size=1, max_size=4), st.sampled_from([(6, 4), (2, 2), (5, 2.5), (9, 3)]), st.sampled_from([4, 2**17]))
@settings(max_examples=300, deadline=None)
def test_runs_equal_brute_force(texts, limits, slice_words):
    assert by_trees(texts, *limits, slice_words=slice_words) == [brute(t.split(), *limits) for t in texts]


def test_suffix_tree_holds_every_suffix():
    text = [1, 2, 1, 2, 2, 1, 2, 1, 0]
    child, start, end, suffix, symbols = periodic.suffix_tree(text)
    assert sorted(s for s in suffix if s >= 0) == list(range(len(text)))
    for at in range(len(text)):
        node, i = 0, at
        while i < len(text):
            node = child[node * symbols + text[i]]
            label = text[start[node] : end[node]]
            assert text[i : i + len(label)] == label
            i += len(label)
        assert suffix[node] == at


def test_extensions():
    text = [3, 1, 2, 1, 2, 1, 2, 0]
    common = periodic.Extensions(text).common
    for i in range(len(text)):
        for j in range(len(text)):
            if i != j:
                want = next(k for k in range(len(text)) if i + k >= len(text) or j + k >= len(text) or text[i + k] != text[j + k])
                assert common(pa.array([i]).to_numpy(), pa.array([j]).to_numpy())[0] == want


def test_windows_shorter_than_a_run():
    assert periodic.window_words(6, 4) == 5
    assert periodic.window_words(2, 2) == 1


def test_edges(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a a a a a"), (5, "a a a a a a"), (6, "x " + "a b " * 4 + "a c"),
        (6, "x " + "a b " * 4 + "a c"), (None, "é é é é é é "), (8, "  " * 7), (9, "a\x00 " * 6),
    ]
    found = periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    for row in found:
        words = WORD.findall(row["text"] or "")
        runs = [tuple(r) for r in row["runs"]]
        assert runs == brute(words)
        assert row["collapsed"] == collapsed(words, runs)


def test_clashing_columns_and_empty_table(spark):
    schema = "text string, runs string, Collapsed int, _row int, _text string, `a.b c` map<string,int>"
    rows = [("a " * 6, "r", 1, 2, "t", {"k": 1})]
    found = periodic.periodic_runs(spark.createDataFrame(rows, schema))
    assert found.columns == ["text", "_row", "_text", "a.b c", "runs", "collapsed"]
    (row,) = found.collect()
    assert (row["_row"], row["_text"], row["a.b c"], row["collapsed"]) == (2, "t", {"k": 1}, "a")
    assert periodic.periodic_runs(spark.createDataFrame([], schema)).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(found, min_exponent=1)


def test_long_text(spark):
    r = random.Random(2)
    words = [r.choice("abcdefgh") for _ in range(30_000)] + ["u", "v", "w"] * 20_000 + ["z"]
    (row,) = periodic.periodic_runs(spark.createDataFrame([(" ".join(words),)], "text string")).collect()
    longest = max(row["runs"], key=lambda x: x["length"])
    assert (longest["start"], longest["length"], longest["period"]) == (30_000, 60_000, 3)
    assert len(row["collapsed"].split()) == len(words) - sum(x["length"] - x["period"] for x in row["runs"])


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in op12_periodic_runs(spark, sf_dir).collect()}
    texts = {r["doc_id"]: r["text"] for r in planted_periods(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    planted = 0
    for doc_id, text in docs:
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            a, g = h // 10 % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            planted += 1
        assert WORD.findall(texts[doc_id] or "") == words
        row = found[doc_id]
        digest = hashlib.sha256(" ".join(words).encode()).hexdigest()
        assert (row["collapsed_sha256"] == digest) == (row["n_runs"] == 0)
        if n > 1500:
            continue  # brute force is quadratic
        runs = brute(words)
        assert row["n_runs"] == len(runs)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{x},{q}\n" for s, x, q in runs).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (None,) * 4 if top is None else (*top, 1000 * top[1] // top[2])
        assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == want
    assert planted > 5
