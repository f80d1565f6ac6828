"""Token alignment between a byte-level BPE tokenizer (A) and a SentencePiece model (B).

Tokens of both cover the same bytes. Byte offsets at which tokens of both end cut them into groups; every
token of A is linked with every token of B of its group. How many documents hold a pair of ids linked
scores the link.

Inverted pair bitmaps give these counts. Documents are numbered within blocks; per block and pair there is
one posting: bit planes of the numbers of links in each document, plane ``k`` holding the documents whose
number has bit ``k``. The OR of the planes is the pair's document bitmap, its popcount the number of
documents; ``2^k`` times the popcounts of the planes is the number of links. A plane is kept as a sorted
array of document numbers or as bits, whichever is shorter. Popcounts of blocks add up, as their documents
differ; a pair's score then returns to its documents through the same postings.

Texts are cut into units where neither tokenizer can join what lies on both sides, and each distinct unit
of a slice is encoded and aligned once. A cut is made before a space that stands alone between two
characters which are no white space: the pre-tokenizer of A starts a new word there, and no piece of B has a
space after another character (checked; if one has, texts are not cut).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from fieldgauge.llm.staging import cut_lineage, row_and_text, unpacked
from fieldgauge.llm.words import slices, text_bytes

SLICE_BYTES = 4 * 2**20
#: A block is closed when it has this many pairs of a document and two linked ids, or this many documents.
BLOCK_ENTRIES, BLOCK_DOCS = 2_000_000, 2**15
#: Units are joined to about this many bytes for one call of a tokenizer.
CALL_BYTES = 4_096
#: Links of a group with more than this many are counted by distinct ids.
LARGE_GROUP = 1_024
#: Bits of a block's number for its place within its partition; partitions that share a count of a pair.
PLACE_BITS, SHARED_PARTITION_BITS = 20, 6
#: A table with one row per id of A is broadcast up to this many ids.
BROADCAST_IDS = 1_000_000

#: What the first pass writes: rows of documents and, with ``pair``, postings.
STAGED = (
    "block long, doc int, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "pair long, n_docs long, n_pair_links long, planes binary"
)
OUTPUTS = ("n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")

WHITE_LEADS = np.zeros(256, bool)
WHITE_LEADS[:0x21] = True
#: 0x7F is kept apart to be safe; the others begin characters some of which are white space.
WHITE_LEADS[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = True


def byte_level() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones themselves, others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[3:-1], 16)]) if is_byte else piece.replace("▁", " ").encode()


@dataclass
class Units:
    """Distinct units, those that may stand side by side (the first ``joinable`` ones) before all others."""

    data: np.ndarray
    at: np.ndarray
    joinable: int

    def text(self, first: int, end: int) -> bytes:
        return self.data[self.at[first] : self.at[end]].tobytes()


def arrange(units: pa.LargeBinaryArray) -> tuple[Units, np.ndarray]:
    """Units in an order in which they can be joined, and the new place of each."""
    data, at = binary_bytes(units)
    begin, end = at[:-1], at[1:]
    # The last character's first byte, and the byte after the space at the start.
    lead = np.maximum.accumulate(np.where((data & 0xC0) != 0x80, np.arange(len(data)), 0))[end - 1] if len(data) else begin
    white = WHITE_LEADS[data]
    inner = (end - begin > 1) & ~white[lead] & ~white[np.minimum(begin + 1, len(data) - 1)] if len(begin) else np.zeros(0, bool)
    order = np.argsort(~inner, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    data, at = binary_bytes(units.take(pa.array(order)))
    return Units(data, at, int(inner.sum())), place


def binary_bytes(column: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Tokens:
    """Ids of consecutive units: those of unit ``i`` are ``ids[at[i]:at[i + 1]]``, none where bytes differ."""

    ids: np.ndarray
    at: np.ndarray
    exact: np.ndarray


class Encoder:
    """One tokenizer: ids of texts that start with a space, and the bytes of every id."""

    def __init__(self, call, table: list[bytes]):
        self.call, self.table = call, table
        self.sizes = np.array([len(t) for t in table], np.int64)
        #: Every id as text, before a comma; and so before a mark.
        self.listed = np.array([f"{i}," for i in range(len(table))], object)

    def spells(self, tokens: list[int], text: bytes) -> bool:
        return b"".join(map(self.table.__getitem__, tokens)) == text

    def units(self, units: Units) -> Tokens:
        """Units that may stand side by side are joined for a call; others, and those of a failed call, go alone."""
        n, joined = len(units.at) - 1, units.joinable
        sizes = np.diff(units.at)
        breaks = np.flatnonzero(np.diff(units.at[:joined] // CALL_BYTES)) + 1
        bounds = np.concatenate([[0] if joined else [], breaks, np.arange(joined, n + 1)]).astype(np.int64)
        spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
        texts = [units.text(a, b) for a, b in spans]
        exact, parts = np.ones(n, bool), []
        for (a, b), text, tokens in zip(spans, texts, self.call([t.decode() for t in texts])):
            if self.spells(tokens, text):
                parts.append(tokens)
                continue
            alone = [units.text(i, i + 1) for i in range(a, b)]
            for i, own, tokens in zip(range(a, b), alone, self.call([t.decode() for t in alone])):
                exact[i] = self.spells(tokens, own)
                parts.append(tokens if exact[i] else [])
        ids = np.concatenate([np.zeros(0, np.int64), *[np.array(p, np.int64) for p in parts]])
        ends, wanted = np.cumsum(self.sizes[ids]), np.cumsum(sizes * exact)
        at = np.concatenate([[0], np.searchsorted(ends, wanted, "right")])
        if (np.concatenate([[0], ends])[at[1:]] != wanted).any():
            raise AssertionError("a token reaches over the border of two units")
        return Tokens(ids, at, exact)


@dataclass
class Pair:
    """Both tokenizers, and whether texts may be cut into units for them."""

    a: Encoder
    b: Encoder
    cuts: bool


_loaded: dict[str, Pair] = {}


def load(a_json: bytes, b_model: bytes) -> Pair:
    """Tokenizers from the contents of their files; kept by a Python worker for its next tasks."""
    key = hashlib.sha256(a_json + b_model).hexdigest()
    if key in _loaded:
        return _loaded[key]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    byte_bpe = Tokenizer.from_str(a_json.decode())
    byte_bpe.encode_special_tokens = True
    byte_of = byte_level()
    vocabulary = json.loads(a_json)["model"]["vocab"]
    a_table = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        a_table[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    pieces = sentencepiece.SentencePieceProcessor(model_proto=b_model)
    names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
    b_table = [piece_bytes(p, pieces.is_byte(i)) for i, p in enumerate(names)]
    cuts = not any("▁" in p.lstrip("▁") for p in names)

    def call_a(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in byte_bpe.encode_batch(texts, add_special_tokens=False)]

    def call_b(texts: list[str]) -> list[list[int]]:
        return pieces.encode([t[1:] for t in texts], num_threads=1)  # the model adds the space

    _loaded[key] = Pair(Encoder(call_a, a_table), Encoder(call_b, b_table), cuts)
    return _loaded[key]


def cut_units(column: pa.Array, cuts: bool) -> tuple[pa.Array, np.ndarray]:
    """Units of space + text of every text, and where each text's begin; empty texts have none."""
    data, offsets = text_bytes(column)
    filled = np.diff(offsets) > 0
    # A space before every text that is not empty.
    spaced = np.insert(data, offsets[:-1][filled], 0x20)
    at = offsets + np.concatenate([[0], np.cumsum(filled)])
    starts = at[:-1][filled]
    if cuts and len(spaced):
        lead_at = np.maximum.accumulate(np.where((spaced & 0xC0) != 0x80, np.arange(len(spaced)), 0))
        white = WHITE_LEADS[spaced]
        spaces = np.flatnonzero(spaced[1:-1] == 0x20) + 1
        alone = spaces[~white[spaces + 1] & ~white[lead_at[spaces - 1]]]
        # A text's last space stays in its unit, as what follows belongs to the next text.
        marked = np.zeros(len(spaced), bool)
        marked[starts], marked[alone] = True, True
        starts = np.flatnonzero(marked)
    bounds = np.concatenate([starts, [len(spaced)]]).astype(np.int64)
    units = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(spaced))]
    )
    return units, np.searchsorted(starts, at)


@dataclass
class Aligned:
    """Distinct units aligned: counts per unit, groups as text, and pairs of linked ids with their numbers."""

    exact: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    pair_at: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


def _ends(tokens: Tokens, sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes[tokens.ids])


def _expand(counts: np.ndarray) -> np.ndarray:
    """0, 1, .., counts[0] - 1, 0, 1, .."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def pair_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a << 32) | b


def align_units(pair: Pair, units: Units) -> Aligned:
    a, b = pair.a.units(units), pair.b.units(units)
    count = len(units.at) - 1
    exact = a.exact & b.exact
    for tokens in (a, b):
        kept = np.repeat(exact, np.diff(tokens.at))
        counts = np.where(exact, np.diff(tokens.at), 0)
        tokens.ids, tokens.at = tokens.ids[kept], np.concatenate([[0], np.cumsum(counts)])
    ends_a, ends_b = _ends(a, pair.a.sizes), _ends(b, pair.b.sizes)
    shared = ends_a[np.isin(ends_a, ends_b, assume_unique=True, kind="table")] if len(ends_a) else ends_a
    # Groups are numbered through; ids of group g are those whose token ends in (shared[g - 1], shared[g]].
    last_a, last_b = np.searchsorted(ends_a, shared, "right"), np.searchsorted(ends_b, shared, "right")
    in_a, in_b = np.diff(last_a, prepend=0), np.diff(last_b, prepend=0)
    first_a, first_b = last_a - in_a, last_b - in_b
    group_at = np.searchsorted(first_a, a.at)
    links = in_a * in_b

    groups = _group_texts(pair, a, b, ends_a, ends_b, shared, last_a, last_b)
    unit_of = np.repeat(np.arange(count), np.diff(group_at))
    small = np.flatnonzero(links <= LARGE_GROUP)
    each = np.repeat(small, links[small])
    step = _expand(links[small])
    rows = [(
        unit_of[each],
        pair_of(a.ids[first_a[each] + step // in_b[each]], b.ids[first_b[each] + step % in_b[each]]),
        np.ones(len(each), np.int64),
    )]
    for g in np.flatnonzero(links > LARGE_GROUP):
        x, n = np.unique(a.ids[first_a[g] : last_a[g]], return_counts=True)
        y, m = np.unique(b.ids[first_b[g] : last_b[g]], return_counts=True)
        rows.append((np.full(len(x) * len(y), unit_of[g]), pair_of(x[:, None], y[None, :]).ravel(), np.outer(n, m).ravel()))
    unit, key, times = (np.concatenate(c) for c in zip(*rows))
    order = np.argsort(unit, kind="stable")
    return Aligned(
        exact, np.diff(a.at), np.diff(b.at), np.diff(group_at),
        np.bincount(unit_of, links, count).astype(np.int64) if len(links) else np.zeros(count, np.int64),
        groups, np.searchsorted(unit[order], np.arange(count + 1)), key[order], times[order],
    )


def _group_texts(pair: Pair, a: Tokens, b: Tokens, ends_a, ends_b, shared, last_a, last_b) -> list[str]:
    """``a1,a2|b1;a3|b2`` of every unit, put together from one list of ids and separators."""
    group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
    words = np.empty(len(a.ids) + len(b.ids), object)
    place_a = np.arange(len(a.ids)) + np.concatenate([[0], last_b])[group_a]
    place_b = np.arange(len(b.ids)) + last_a[group_b]
    words[place_a], words[place_b] = pair.a.listed[a.ids], pair.b.listed[b.ids]
    # The last id of a side of a group is followed by the mark instead of a comma.
    for ids, place, last, mark in ((a.ids, place_a, last_a, "|"), (b.ids, place_b, last_b, ";")):
        words[place[last - 1]] = [f"{i}{mark}" for i in ids[last - 1].tolist()]
    listed, at = words.tolist(), (a.at + b.at).tolist()
    return ["".join(listed[x:y])[:-1] for x, y in zip(at[:-1], at[1:])]


def planes_of(pair: np.ndarray, doc: np.ndarray, times: np.ndarray, docs: int) -> pa.RecordBatch:
    """Postings of a block: one row per pair with its planes, from rows sorted by pair, then document.

    A plane is its bit number (plus 256 if kept as bits), the number of 16-bit words that follow as two
    words, and these: sorted document numbers, or bits.
    """
    new = np.ones(len(pair), bool)
    new[1:] = pair[1:] != pair[:-1]
    of = np.cumsum(new) - 1
    depth = int(times.max(initial=0)).bit_length()
    parts = [np.flatnonzero(times >> k & 1) for k in range(depth)]
    row = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    plane = np.repeat(np.arange(depth), [len(p) for p in parts])
    order = np.lexsort((doc[row], plane, of[row]))
    row, plane = row[order], plane[order]
    first = np.ones(len(row), bool)
    first[1:] = (of[row][1:] != of[row][:-1]) | (plane[1:] != plane[:-1])
    head = np.flatnonzero(first)
    members = np.diff(np.concatenate([head, [len(row)]]))
    bit_words = -(-docs // 16)
    dense = members > bit_words
    payload = np.where(dense, bit_words, members)
    at = np.concatenate([[0], np.cumsum(payload + 3)])
    words = np.zeros(at[-1], np.uint16)
    words[at[:-1]] = plane[head] + 256 * dense
    words[at[:-1] + 1], words[at[:-1] + 2] = payload & 0xFFFF, payload >> 16
    entry = np.cumsum(first) - 1
    own = doc[row]
    sparse = ~dense[entry]
    words[(at[entry] + 3 + np.arange(len(row)) - head[entry])[sparse]] = own[sparse]
    full = ~sparse
    np.bitwise_or.at(words, (at[entry] + 3 + (own >> 4))[full], (1 << (own[full] & 15)).astype(np.uint16))
    pairs = np.flatnonzero(new)
    bounds = np.concatenate([at[np.searchsorted(of[row[head]], np.arange(len(pairs)))], at[-1:]]) * 2
    held = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(pairs), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(words)]
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array(pair[pairs]), pa.array(np.diff(np.concatenate([pairs, [len(pair)]]))),
            pa.array(np.add.reduceat(times, pairs) if len(pairs) else np.zeros(0, np.int64)), held.cast(pa.binary()),
        ],
        ["pair", "n_docs", "n_pair_links", "planes"],
    )


def read_planes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, doc, part of its number of links)`` of all planes; a document is in several planes of a row."""
    held = column.cast(pa.large_binary())
    offsets = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + len(held) + 1] // 2
    words = np.frombuffer(held.buffers()[2], np.uint16).astype(np.int64) if len(held) else np.zeros(0, np.int64)
    rows, docs, parts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    open_rows, at = np.flatnonzero(np.diff(offsets)), offsets[:-1][np.diff(offsets) > 0]
    while len(open_rows):  # the first plane of all rows, then the second, ..
        mark, size = words[at], words[at + 1] | words[at + 2] << 16
        value = np.int64(1) << (mark & 255)
        inner = np.repeat(at + 3, size) + _expand(size)
        owner = np.repeat(np.arange(len(at)), size)
        as_bits = mark[owner] >= 256
        rows.append(open_rows[owner[~as_bits]])
        docs.append(words[inner[~as_bits]])
        parts.append(value[owner[~as_bits]])
        if as_bits.any():
            bits = words[inner[as_bits], None] >> np.arange(16) & 1
            which, bit = np.nonzero(bits)
            rows.append(open_rows[owner[as_bits][which]])
            docs.append(_expand(size)[as_bits][which] * 16 + bit)
            parts.append(value[owner[as_bits][which]])
        at = at + 3 + size
        more = at < offsets[open_rows + 1]
        open_rows, at = open_rows[more], at[more]
    return np.concatenate(rows), np.concatenate(docs), np.concatenate(parts)


class _Block:
    """Documents of a block so far, and their pairs."""

    def __init__(self, number: int):
        self.number, self.docs, self.rows, self.entries = number, 0, [], 0

    def add(self, doc: np.ndarray, pair: np.ndarray, times: np.ndarray) -> None:
        self.rows.append((doc, pair, times))
        self.entries += len(doc)

    def postings(self) -> pa.RecordBatch:
        doc, pair, times = (np.concatenate(c) for c in zip(*self.rows))
        return planes_of(*_summed(pair, doc, times), self.docs)


def _summed(pair: np.ndarray, doc: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of equal ``(pair, doc)`` added up, sorted. Ids have fewer than 24 bits, documents fewer than 16."""
    key = ((pair >> 32) << 40 | (pair & 0xFFFFFF) << 16 | doc).astype(np.uint64)
    order = np.argsort(key)
    key, times = key[order], times[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    key = key[first].astype(np.int64)
    pair = ((key >> 40) & 0xFFFFFF) << 32 | key >> 16 & 0xFFFFFF
    return pair, key & 0xFFFF, np.add.reduceat(times, first) if len(first) else times


def _columns(schema: pa.Schema, n: int, values: dict[str, object]) -> pa.RecordBatch:
    """A batch of the staged layout; columns not given are NULL."""
    arrays = [values[f.name] if f.name in values else pa.nulls(n, f.type) for f in schema]
    return pa.RecordBatch.from_arrays([x.cast(f.type) if x.type != f.type else x for x, f in zip(arrays, schema)], schema=schema)


def _aligner(files, as_text: bool, schema: pa.Schema, block_docs: int):
    def align_slice(pair: Pair, part: pa.RecordBatch, block: _Block) -> pa.RecordBatch:
        units, unit_at = cut_units(part.column("_text"), pair.cuts)
        coded = units.dictionary_encode()
        distinct, place = arrange(coded.dictionary)
        found = align_units(pair, distinct)
        code = place[coded.indices.to_numpy()]
        n = part.num_rows
        per_doc = np.diff(unit_at)
        home = np.repeat(np.arange(n), per_doc)
        whole = np.bincount(home, ~found.exact[code], n) == 0 if len(code) else np.ones(n, bool)
        whole &= per_doc > 0
        counts = {
            c: np.bincount(home, getattr(found, c)[code], n).astype(np.int64) * whole if len(code) else np.zeros(n, np.int64)
            for c in ("n_a", "n_b", "n_groups", "n_links")
        }
        listed, bounds, texts = code.tolist(), unit_at.tolist(), []
        for i in range(n):
            text = ";".join([found.groups[c] for c in listed[bounds[i] : bounds[i + 1]]]) if whole[i] else ""
            texts.append(text if as_text or not text else hashlib.sha256(text.encode()).hexdigest())
        # Units of whole documents, each once per document with how often it occurs there.
        if len(code):
            both = np.sort((home * len(found.exact) + code)[whole[home]])
            first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])[: len(both)])
            both, times = both[first], np.diff(np.concatenate([first, [len(both)]]))
            doc, unit = both // len(found.exact), both % len(found.exact)
            size = np.diff(found.pair_at)[unit]
            inner = np.repeat(found.pair_at[unit], size) + _expand(size)
            linked, doc, number = _summed(found.pairs[inner], np.repeat(doc, size), found.times[inner] * np.repeat(times, size))
            block.add(block.docs + doc, linked, number)
        batch = _columns(schema, n, {
            "_row": part.column("_row"), "block": pa.array(np.full(n, block.number)),
            "doc": pa.array(np.arange(block.docs, block.docs + n)), "groups": pa.array(texts),
            **{c: pa.array(v) for c, v in counts.items()},
        })
        block.docs += n
        return batch

    def closed(block: _Block) -> Iterator[pa.RecordBatch]:
        if block.rows:
            made = block.postings()
            for part in [made.slice(i, 2**16) for i in range(0, made.num_rows, 2**16)]:
                yield _columns(schema, part.num_rows, {
                    "block": pa.array(np.full(part.num_rows, block.number)), **{c: part.column(c) for c in part.schema.names}
                })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(*files.value)
        block = _Block(TaskContext.get().partitionId() << PLACE_BITS)
        for batch in batches:
            for few in (batch.slice(i, block_docs) for i in range(0, batch.num_rows, block_docs)):
                for part in slices(few, "_text", SLICE_BYTES):
                    if block.docs + part.num_rows > block_docs or block.entries >= BLOCK_ENTRIES:
                        yield from closed(block)
                        block = _Block(block.number + 1)
                    yield align_slice(pair, part, block)
        yield from closed(block)

    return run


SCORED = "block long, doc int, count_sum long, n_best long"


def _return_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores of pairs, added up over each document's postings; two numbers per document are held."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        block = batch.column("block").to_numpy()
        score = np.stack([batch.column("n_docs").to_numpy(), batch.column("best").to_numpy()]).astype(np.int64)
        row, doc, part = read_planes(batch.column("planes"))
        for number in np.unique(block):
            here = block[row] == number
            d, p, r = doc[here], part[here], row[here]
            held = sums.get(number)
            size = int(d.max(initial=-1)) + 1
            if held is None or held.shape[1] < size:
                grown = np.zeros((2, max(size, 0 if held is None else 2 * held.shape[1])), np.int64)
                if held is not None:
                    grown[:, : held.shape[1]] = held
                held = sums[number] = grown
            for k in range(2):
                np.add.at(held[k], d, p * score[k, r])
    for number, held in sums.items():
        docs = np.flatnonzero(held[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(docs), number)), pa.array(docs.astype(np.int32)), pa.array(held[0][docs]), pa.array(held[1][docs])],
            ["block", "doc", "count_sum", "n_best"],
        )


@dataclass(frozen=True)
class Alignment:
    """``documents``: one row per input row. ``pairs``: ``a, b, n_docs, n_links, best`` of all linked ids."""

    documents: DataFrame
    pairs: DataFrame


def align(
    docs: DataFrame, a_file: str, b_file: str, text: str = "text", columns: Sequence[str] | None = None,
    groups: str = "text", block_docs: int = BLOCK_DOCS,
) -> Alignment:
    """Both tokenizers' tokens of each text, aligned, and how common the linked pairs of ids are.

    Documents get ``n_a, n_b`` (tokens), ``n_groups``, ``n_links``, ``groups`` (``a1,a2|b1;a3|b2,b3``, or with
    ``groups="sha256"`` the SHA-256 of that in hex), ``n_best`` (links whose pair is in as many documents as
    any pair of that id of A) and ``count_sum`` (documents of the pair, added up over links).

    A encodes space + text without special tokens, B the text, which its model puts a space before.

    * A NULL or empty text, or one that the tokens of A or B do not spell byte for byte, has zeros and ''.
    * One row per input row; repeated rows count as documents of their own; ids may be NULL.
    * ``columns`` (default: all) are carried along, but those named like an output.
    * Texts are taken whole. A group with very many links is counted by its distinct ids.
    * The tokenizers' files need to be readable on the driver only.
    """
    spark = docs.sparkSession
    with open(a_file, "rb") as a, open(b_file, "rb") as b:
        a_json, b_model = a.read(), b.read()
    names = [c for c in (docs.columns if columns is None else columns) if c.lower() not in OUTPUTS]
    packed = row_and_text(docs, text, names)
    layout = StructType([*packed.select("_row").schema.fields, *StructType.fromDDL(STAGED).fields])
    for field in layout.fields:
        field.nullable = True  # postings have no row
    files = spark.sparkContext.broadcast((a_json, b_model))
    arrow_layout = to_arrow_schema(layout, prefers_large_types=False)
    staged = cut_lineage(packed.mapInArrow(_aligner(files, groups == "text", arrow_layout, block_docs), layout))
    postings = staged.filter("pair IS NOT NULL").withColumn(
        "shared", F.shiftright("block", PLACE_BITS + SHARED_PARTITION_BITS)
    )
    # A frequent pair is in every block: its score goes back by (pair, some partitions), a few postings each.
    local = postings.groupBy("pair", "shared").agg(F.sum("n_docs").alias("n"), F.sum("n_pair_links").alias("links"))
    total = cut_lineage(
        local.groupBy("pair").agg(
            F.sum("n").alias("n_docs"), F.sum("links").alias("n_links"), F.collect_list("shared").alias("shared")
        ).withColumn("a", F.shiftright("pair", 32))
    )
    highest = total.groupBy("a").agg(F.max("n_docs").alias("most"))
    if len(json.loads(a_json)["model"]["vocab"]) <= BROADCAST_IDS:  # a row per id
        highest = F.broadcast(highest)
    scored = total.join(highest, "a").withColumn("best", (F.col("n_docs") == F.col("most")).cast("long"))
    pairs = scored.select(
        F.col("a"), F.col("pair").bitwiseAND(2**32 - 1).alias("b"), "n_docs", "n_links", F.col("best").cast("boolean").alias("best")
    )
    back = scored.select("pair", F.explode("shared").alias("shared"), "n_docs", "best")
    returned = (
        postings.select("pair", "shared", "block", "planes").join(back, ["pair", "shared"])
        .select("block", "n_docs", "best", "planes").repartition("block")
        .mapInArrow(_return_scores, SCORED)
    )
    zero = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")}
    documents = (
        staged.filter("doc IS NOT NULL").drop("pair", "n_docs", "n_pair_links", "planes")
        .join(returned, ["block", "doc"], "left")
        .select(*unpacked(names), "n_a", "n_b", "n_groups", "n_links", "groups", *zero.values())
    )
    return Alignment(documents, pairs)
