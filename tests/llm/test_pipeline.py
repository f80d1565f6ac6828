import re

from fieldgauge.llm import mixing

import corpus_pipeline as C

SCHEMA = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order(spark, documents, tmp_path):
    english = "the house and river with over morning water thing other"
    german = "der haus und fluss mit über morgen wasser schön andere"
    rows = [
        (i, " ".join(f"{w}{chr(97 + i % 26)}{chr(97 + i // 26)}" for w in (english if i % 2 else german).split() * 3), "en" if i % 2 else "de", f"s{i % 3}")
        for i in range(60)
    ]
    rows += [(100, rows[1][1], "en", "s0"), (101, "*** 12 ***", None, "s1"), (102, None, None, None), (103, english * 3 + " mail a.b@mail.example.com now", "en", "s1")]
    docs = documents(rows)
    kept = docs
    counts = []
    for name, stage in C.STAGES:
        kept = C.cut_lineage(stage(spark, kept, None))
        counts.append((name, {r["doc_id"] for r in kept.collect()}))
        if name != "tokens":
            assert kept.columns == SCHEMA
        if name == "personal_data":
            (row,) = kept.filter("doc_id = 103").collect()
            assert "a.b@mail" not in row["text"] and row["n_chars"] == len(row["text"]) and re.search("@.*com now", row["text"])
            assert kept.filter("doc_id = 1").first()["text"] == rows[1][1]
            plan = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(kept).collect()}
    found = dict(counts)
    assert found["language"] == {r[0] for r in rows} - {101, 102}
    assert found["near_duplicates"] == found["language"] - {100} == found["personal_data"]
    assert {r["doc_id"]: r["count"] for r in kept.groupBy("doc_id").count().collect()} == {k: n for k, n in plan.items() if n}
    assert kept.filter("n_tokens = size(ids) AND n_tokens > 0").count() == kept.count()

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(map(str, C.run(spark, str(tmp_path)).collect())) == sorted(map(str, kept.collect()))


def test_texts_in_several_languages_stay(spark, documents):
    words = {
        "en": "the house and river with over morning water thing other",
        "de": "der haus und fluss mit über morgen wasser schön andere",
        "ru": "дом и река через утро вода вещь другой",
    }
    rows = [(i, " ".join(w.split()[i % 5:] * 4), g, "s") for i in range(30) for g, w in words.items()]
    rows.append((100, "\n".join(" ".join(w.split() * 4) for w in words.values()), None, "s"))
    rows.append((101, "12 -- 34", "en", "s"))
    docs = documents([(i, *r[1:]) if r[0] < 100 else r for i, r in enumerate(rows)])
    kept = {r["doc_id"] for r in C.identify_language(spark, docs, None).collect()}
    assert 100 in kept and 101 not in kept and len(kept) == 91


def test_an_empty_corpus_passes(spark, documents):
    docs = documents([])
    for _, stage in C.STAGES:
        docs = C.cut_lineage(stage(spark, docs, None))
    assert docs.count() == 0
