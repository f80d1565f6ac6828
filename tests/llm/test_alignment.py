import hashlib
import json
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fieldgauge.llm import alignment
from fieldgauge.llm.queries import BYTE_BPE, PIECE_MODEL, op11_token_alignment

SCHEMA = "doc_id long, text string"


def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def byte_of():
    """The inverse of the byte-level alphabet, from the single-byte entries of the vocabulary: ids 0 to 255."""
    from tokenizers import decoders

    decoder = decoders.ByteLevel()
    vocabulary = json.load(open(BYTE_BPE))["model"]["vocab"]
    chars = {c for token in vocabulary if not token.startswith("<|") for c in token}
    known = {}
    for c in chars:
        text = decoder.decode([c])
        if text != "�":
            known[c] = ord(text)
    # Bytes above 0x7F decode to a replacement character; printable Latin-1 stands for itself, others count up from 256.
    rest = iter(range(256, 256 + 68))
    for b in range(256):
        c = chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 else chr(next(rest))
        assert known.get(c, b) == b
        known[c] = b
    return known


class Brute:
    """Groups and counts of whole texts, token by token."""

    def __init__(self):
        self.a, self.b = tokenizers()
        self.byte = byte_of()

    def tokens(self, text):
        spaced = (" " + text).encode()
        coded = self.a.encode(" " + text, add_special_tokens=False)
        ends = []
        at = 0
        for t in coded.tokens:
            at += len(t)
            ends.append(at)
        if bytes(self.byte[c] for t in coded.tokens for c in t) != spaced:
            return None
        ids = self.b.encode(text)
        pieces = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self.b.id_to_piece(i)) for i in ids)]
        if b"".join(pieces) != spaced:
            return None
        return (coded.ids, ends), (ids, np.cumsum([len(p) for p in pieces]).tolist())

    def groups(self, text):
        found = self.tokens(text) if text else None
        if found is None:
            return []
        (a, a_ends), (b, b_ends) = found
        shared = sorted(set(a_ends) & set(b_ends))
        out = [([], []) for _ in shared]
        for side, (ids, ends) in enumerate(((a, a_ends), (b, b_ends))):
            g = 0
            for i, end in zip(ids, ends):
                while end > shared[g]:
                    g += 1
                out[g][side].append(i)
        return out

    def rows(self, texts):
        grouped = [self.groups(t) for t in texts]
        links = [Counter((x, y) for a, b in g for x in a for y in b) for g in grouped]
        count = Counter(pair for found in links for pair in found)
        most = Counter()
        for (x, _), n in count.items():
            most[x] = max(most[x], n)
        self.count, self.links, rows = count, sum(links, Counter()), []
        for g, found in zip(grouped, links):
            listed = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            rows.append((
                sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(found.values()), listed,
                sum(n for p, n in found.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in found.items()),
            ))
        return rows


@pytest.fixture(scope="module")
def brute():
    return Brute()


def texts():
    r = random.Random(5)
    parts = [
        "the", "Überraschung", "l'été", "don't", "we'll", " ", "  ", "\n", "\n\n", "\t", " ", "　", " ", "漢字かな", "😀👍🏽",
        "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "x" * 40, "1234567", "3.14", "...", "---", "\x00", "\x1c", "\x85", "ﬁ", "é",
        "naïve", "Привет", "مرحبا", "नमस्ते", "한국어", "«a»", "a‍b", "﻿", "�", "()[]{}", "        ", "http://a.b/c?d=e&f",
    ]
    made = ["".join(r.choice(parts) + r.choice(["", " ", " ", " "]) for _ in range(r.randrange(1, 60))) for _ in range(150)]
    marked = ["a ▁ b", "▁", "ends in spaces   ", " starts with one", "   three", " ", "\n", "same text here", "same text here"]
    return made + marked + ["", None] + [" ".join(r.choices(["of", "the", "cat", "sat"], k=300)) for _ in range(20)]


def rows_of(frame):
    return {
        r["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups"], r["n_best"], r["count_sum"]) for r in frame.collect()
    }


def test_equals_brute_force(spark, brute):
    given = list(enumerate(texts()))
    df = spark.createDataFrame(given, SCHEMA).repartition(3)
    found = alignment.align(df, BYTE_BPE, PIECE_MODEL, columns=["doc_id"])
    rows = rows_of(found.documents)
    assert len(rows) == len(given)
    for (i, text), want in zip(given, brute.rows([t for _, t in given])):
        assert rows[i] == want, text
    pairs = {(r["a"], r["b"]): (r["n_docs"], r["n_links"]) for r in found.pairs.collect()}
    assert pairs == {p: (n, brute.links[p]) for p, n in brute.count.items()}


def test_slices_blocks_and_calls_do_not_matter(brute, monkeypatch):
    given = texts()
    pair = alignment.load(open(BYTE_BPE, "rb").read(), open(PIECE_MODEL, "rb").read())
    assert pair.cuts
    for call_bytes, large in ((1, 10**9), (64, 1), (10**6, 64)):
        monkeypatch.setattr(alignment, "CALL_BYTES", call_bytes)
        monkeypatch.setattr(alignment, "LARGE_GROUP", large)
        units, at = alignment.cut_units(pa.array(given), True)
        coded = units.dictionary_encode()
        distinct, place = alignment.arrange(coded.dictionary)
        found = alignment.align_units(pair, distinct)
        codes = place[coded.indices.to_numpy()]
        for i, want in enumerate(brute.rows(given)):
            own = codes[at[i] : at[i + 1]]
            if found.exact[own].all():
                assert ";".join(found.groups[c] for c in own) == want[4]
                assert found.n_links[own].sum() == want[3]
            else:
                assert want[:5] == (0, 0, 0, 0, "")


def test_planes_round_trip():
    r = np.random.default_rng(6)
    for docs in (1, 17, 300, 2**15):
        n = 4_000
        pair, doc = r.integers(0, 30, n) ** 3, r.integers(0, docs, n)
        times = r.integers(1, 9, n) ** r.integers(1, 6, n)
        pair, doc, times = alignment._summed(pair, doc, times)
        made = alignment.planes_of(pair, doc, times, docs)
        assert made.column("pair").to_pylist() == np.unique(pair).tolist()
        row, at, part = alignment.read_planes(made.column("planes"))
        back = Counter()
        for x, d, p in zip(row.tolist(), at.tolist(), part.tolist()):
            back[(made.column("pair")[x].as_py(), d)] += p
        assert back == dict(zip(zip(pair.tolist(), doc.tolist()), times.tolist()))
        assert made.column("n_docs").to_pylist() == [c for _, c in sorted(Counter(pair.tolist()).items())]
        assert sum(made.column("n_pair_links").to_pylist()) == times.sum()
        sliced = alignment.read_planes(made.slice(1, 3).column("planes"))
        assert set(sliced[0].tolist()) <= {0, 1, 2}


def test_many_blocks(spark, brute):
    """Blocks of four documents: postings and scores of many blocks of a partition."""
    given = [(i, t) for i, t in enumerate(texts()[:60])]
    df = spark.createDataFrame(given, SCHEMA).coalesce(1)
    rows = rows_of(alignment.align(df, BYTE_BPE, PIECE_MODEL, columns=["doc_id"], block_docs=4).documents)
    for (i, _), want in zip(given, brute.rows([t for _, t in given])):
        assert rows[i] == want


def test_edges(spark, brute):
    empty = alignment.align(spark.createDataFrame([], SCHEMA), BYTE_BPE, PIECE_MODEL)
    assert empty.documents.collect() == [] and empty.pairs.collect() == []
    nothing = alignment.align(spark.createDataFrame([(1, None), (2, ""), (3, "▁")], SCHEMA), BYTE_BPE, PIECE_MODEL)
    assert {r[1:] for r in map(tuple, nothing.documents.drop("text").collect())} == {(0, 0, 0, 0, "", 0, 0)}
    schema = "text string, block string, doc string, pair int, n_a string, _row int, _text string, `a.b c` map<string,int>"
    df = spark.createDataFrame([("hello there", "b", "d", 3, "n", 5, "t", {"k": 1})] * 2, schema)
    rows = alignment.align(df, BYTE_BPE, PIECE_MODEL, groups="sha256").documents.collect()
    (want,) = set(brute.rows(["hello there"] * 2))
    for row in rows:
        assert (row["block"], row["doc"], row["pair"], row["_row"], row["a.b c"]) == ("b", "d", 3, 5, {"k": 1})
        assert (row["n_a"], row["groups"]) == (want[0], hashlib.sha256(want[4].encode()).hexdigest())
    assert len(rows) == 2


def test_long_texts(spark, brute):
    r = random.Random(7)
    long = ["x" * 30_000, "ab" * 10_000, " " * 5_000 + "end", " ".join(r.choices(["alpha", "beta", "gämma"], k=20_000)), "\n" * 3_000]
    rows = rows_of(alignment.align(spark.createDataFrame(list(enumerate(long)), SCHEMA), BYTE_BPE, PIECE_MODEL, columns=["doc_id"]).documents)
    for i, want in enumerate(brute.rows(long)):
        assert rows[i] == want


def test_query_equals_brute_force(spark, brute):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in op11_token_alignment(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for (i, _), want in zip(docs, brute.rows([t for _, t in docs])):
        r = found[i]
        digest = hashlib.sha256(want[4].encode()).hexdigest() if want[0] else ""
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"], r["n_best"], r["count_sum"]) == (*want[:4], digest, *want[5:])
