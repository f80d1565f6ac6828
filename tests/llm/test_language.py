import itertools

import numpy as np
import pytest

from fieldgauge.llm import language

WORDS = {
    "en": "the house and river with over morning water thing other".split(),
    "de": "der haus und fluss mit über morgen wasser schön andere".split(),
    "ru": "дом и река через утро вода вещь другой".split(),
}


def text(lang, n, at=0):
    return " ".join(WORDS[lang][(at + i * 7) % len(WORDS[lang])] for i in range(n))


@pytest.fixture(scope="module")
def labelled():
    return [(i, text(g, 20 + i % 30, i), g, "s") for i in range(90) for g in [("en", "de", "ru")[i % 3]]]


@pytest.fixture
def model(documents, labelled):
    return language.learn(documents(labelled), sample_rows=1000)


def test_viterbi_against_brute_force():
    rng = np.random.default_rng(0)
    for n, langs in ((1, 2), (4, 3), (6, 2)):
        scores = rng.normal(0, 3, (n + 2, langs)).astype(np.float32)
        labels = language.viterbi(scores, np.array([0, n, n, n + 2]), 2.0)
        for a, b in ((0, n), (n, n + 2)):
            def value(path):
                return sum(scores[a + i, s] for i, s in enumerate(path)) - 2.0 * sum(x != y for x, y in zip(path, path[1:]))
            best = max(value(p) for p in itertools.product(range(langs), repeat=b - a))
            assert value(labels[a:b]) == pytest.approx(best, abs=1e-4)


def test_mixed_text_is_cut_into_spans(documents, model):
    mixed = text("en", 30) + " " + text("de", 40) + "\n" + text("ru", 12)
    (row,) = language.identify(documents([(1, mixed, None, None)]), model).collect()
    assert [s["lang"] for s in row["spans"]] == ["en", "de", "ru"]
    assert row["lang_pred"] == "de" and 0.3 < row["score"] < 0.7
    first = row["spans"][0]
    assert abs(first["end"] - len(text("en", 30))) < 20


def test_script_narrows(documents, model):
    rows = language.identify(documents([(1, "совершенно незнакомое", None, None), (2, "unseen palavra", None, None)]), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in rows}[1] == "ru"
    assert {r["doc_id"]: r["lang_pred"] for r in rows}[2] in ("en", "de")


def test_words_of_an_excluded_script_are_never_labelled(documents, model):
    for foreign in (1, 2, 3):
        mixed = f"{text('en', 15)} {text('ru', foreign)} {text('en', 15, 3)}"
        (row,) = language.identify(documents([(1, mixed, None, None)]), model).collect()
        assert [s["lang"] for s in row["spans"]] == ["en", "ru", "en"]
        start, end = row["spans"][1]["start"], row["spans"][1]["end"]
        assert mixed[start:end] == text("ru", foreign) and row["lang_pred"] == "en"


def test_too_many_labels_are_an_error(documents, labelled, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    with pytest.raises(ValueError, match="more than 2 languages"):
        language.learn(documents(labelled))


def test_held_out_accuracy(documents, labelled):
    docs = documents(labelled)
    model = language.learn_documents(docs)
    rows = language.identify(docs, model).withColumn("out", language.held_out()).filter("out").collect()
    assert rows and all(r["lang_pred"] == r["lang"] for r in rows)


def test_edges(documents, model):
    odd = [(None, None, None, None), (1, "", "en", "s"), (2, "12 *** \n", "en", "s"), (3, text("de", 50_000), "x", None), (4, "a" * 300_000, None, None),
           (5, text("en", 9), None, None), (5, text("en", 9), None, None)]
    found = {(r["doc_id"], r["n_chars"]): r for r in language.identify(documents(odd), model).collect()}
    assert all(found[k]["lang_pred"] == "und" and found[k]["score"] == 0 and found[k]["spans"] == [] for k in ((None, None), (1, 0), (2, 8)))
    assert found[(3, len(text("de", 50_000)))]["lang_pred"] == "de"
    assert language.identify(documents([]), model).count() == 0
    assert language.learn(documents([])) is None and language.learn(documents([(1, None, "en", "s"), (2, "x", None, "s")])) is None
    (row,) = language.identify(documents([(1, "text", None, None)]), None).collect()
    assert row["lang_pred"] == "und" and row["spans"] == []


def test_clashing_columns_are_replaced(documents, model):
    docs = documents([(1, text("en", 20), None, None)]).selectExpr("*", "'x' AS score", "5 AS LANG_PRED", "'y' AS spans")
    (row,) = language.identify(docs, model).collect()
    assert row["lang_pred"] == "en" and row["score"] == 1.0
