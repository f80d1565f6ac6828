import random
from pathlib import Path

import pyarrow as pa
import pytest

from fieldgauge.llm import sentencepiece as S
from fieldgauge.llm.queries import PIECE_MODEL

pytestmark = pytest.mark.skipif(not Path(PIECE_MODEL).exists(), reason="no model file here")


@pytest.fixture(scope="module")
def vocabulary():
    return S.load_vocabulary(PIECE_MODEL)


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PIECE_MODEL)


def check(vocabulary, library, texts):
    ids = S.encode_batch(S.Matcher(vocabulary), pa.array(texts, pa.string()))
    assert ids.to_pylist() == library.encode(texts, num_threads=1)
    assert S.decode_batch(vocabulary, ids).to_pylist() == [t.replace("▁", " ") for t in texts]


def test_odd_texts(vocabulary, library):
    check(vocabulary, library, ["", " ", "  ", "a", "hello world", "  Hello  world\n\tñandú ▁x 漢字😀", "a\0b", "\n\n", "\r)\r\n", "ﬁ ①２ é é", " " * 333,
                                "ab" * 900, "aaaa aaaaaaa", "漢字仮名" * 200, "x" * 20_000, "});\r\n"])


def test_random_texts(vocabulary, library):
    r = random.Random(1)
    for letters in ("ab c", "abcdefghijklmnopqrstuvwxyz   éñüß\n.,AEIOU", "()[]{};:\r\n\t '\"=<>"):
        check(vocabulary, library, ["".join(r.choices(letters, k=120)) for _ in range(300)])
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.vocab_size())]
    check(vocabulary, library, ["".join(r.choices(pieces, k=60)) for _ in range(400)])


def test_blocks_and_slices_do_not_matter(vocabulary, library, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BYTES", 64)
    monkeypatch.setattr(S, "LONG_UNIT", 5)
    r = random.Random(2)
    check(vocabulary, library, ["".join(r.choices("theandr  ing,\n", k=90)) for _ in range(60)])


def test_frames(documents, library):
    rows = [(1, "one two", "en", "s"), (1, "one two", "en", "s"), (2, None, None, None), (3, "", None, None), (None, "word " * 60_000, None, None)]
    docs = documents(rows).selectExpr("*", "'mine' AS IDS", "'mine' AS decoded")
    out = S.decode(S.encode(docs, PIECE_MODEL), PIECE_MODEL).collect()
    assert len(out) == 5 and all(r["decoded"] == r["text"] for r in out)
    assert all(r["ids"] == (None if r["text"] is None else library.encode(r["text"])) for r in out)
    assert S.encode(documents([]), PIECE_MODEL).count() == 0
    assert S.encode(docs, PIECE_MODEL, columns=["doc_id"]).columns == ["doc_id", "ids"]


def test_bytes_that_are_no_text_decode_to_replacements(vocabulary, library):
    lone = [vocabulary.byte_ids[0xE6].item(), vocabulary.byte_ids[0x41].item(), 1, 2]
    assert S.decode_batch(vocabulary, pa.array([lone, []], pa.list_(pa.int32()))).to_pylist() == ["�A", ""]
