"""SentencePiece BPE encoding by suffix-array matching, and decoding.

A batch's texts are cut where no piece can reach across (before spaces and around control characters),
and the distinct units are concatenated. Their suffixes, to the length of the longest piece, are sorted
once; a binary search per piece gives the range of its occurrences; these are the edges of a lattice,
sorted by position, over which tokens are relaxed for all units in step.

BPE has no additive score to relax by. What holds instead: the tokens of a text are, for every prefix,
followed by exactly one token that fits the last token of the prefix before it, and two neighbours fit
if no merge across their border would have come before a merge that made them. So every position has
one valid incoming edge, found by trying the longest first.

Pieces whose merges do not come in the order of their scores (runs of spaces, in practice) do not obey
this; units that contain one are merged directly, once per distinct unit.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.staging import without
from fieldgauge.llm.words import slices, text_bytes

SPACE_MARK = "▁"
SLICE_BYTES = 3 * 2**20
#: Bytes of distinct units that are indexed and matched together.
BLOCK_BYTES = 2**17
#: Units longer than this are cut again, between characters that stand side by side in no piece.
LONG_UNIT = 48
CHUNK = 8


@dataclass
class Vocabulary:
    """The pieces of a BPE model; ids index all arrays. ``size`` stands for an unknown character."""

    size: int
    piece_bytes: list[bytes]  # spaces for space marks; what the id decodes to
    searched: np.ndarray  # ids that a text can be cut into, bytes and controls excluded
    rank: np.ndarray  # order of merging; -1 for single characters
    left: np.ndarray
    right: np.ndarray  # parts of the last merge; -1 for single characters
    irregular: np.ndarray
    pair_keys: np.ndarray
    pair_merged: np.ndarray
    byte_ids: np.ndarray
    isolated: np.ndarray  # by byte: an ASCII control character that is part of no piece
    neighbours: np.ndarray  # pairs of characters that stand side by side in some piece
    by_bytes: dict[bytes, int]
    merge_rank: dict[bytes, int]


def _merges(text: str, rank: dict[str, int]) -> tuple[list[str], list[tuple[int, str, str]]]:
    """BPE of one string, as the model defines it: the best merge first, the leftmost of equals."""
    parts = list(text)
    following = list(range(1, len(parts) + 1))
    before = list(range(-1, len(parts) - 1))
    queue = []

    def offer(i):
        if i >= 0 and following[i] < len(parts):
            merged = parts[i] + parts[following[i]]
            if merged in rank:
                heapq.heappush(queue, (rank[merged], i, merged))

    for i in range(len(parts) - 1):
        offer(i)
    made = []
    while queue:
        order, i, merged = heapq.heappop(queue)
        if parts[i] is None or following[i] >= len(parts) or parts[i] + parts[following[i]] != merged:
            continue
        j = following[i]
        made.append((order, parts[i], parts[j]))
        parts[i], parts[j] = merged, None
        following[i] = following[j]
        if following[j] < len(parts):
            before[following[j]] = i
        offer(before[i])
        offer(i)
    return [p for p in parts if p is not None], made


def load_vocabulary(model_file: str) -> Vocabulary:
    """Read a SentencePiece BPE model with byte fallback, on the driver."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    size = model.vocab_size()
    plain = [
        i for i in range(size)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    text_of = {i: model.id_to_piece(i).replace(SPACE_MARK, " ") for i in plain}
    ids = {t: i for i, t in text_of.items()}
    scores = np.array([model.get_score(i) for i in plain])
    ranks = np.searchsorted(np.unique(-scores), -scores)
    rank_of = {text_of[i]: int(r) for i, r in zip(plain, ranks)}
    rank, left, right = (np.full(size + 1, -1, np.int64) for _ in range(3))
    irregular, reachable = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
    for i in plain:
        text = text_of[i]
        if len(text) == 1:
            reachable[i] = True
            continue
        rank[i] = rank_of[text]
        parts, made = _merges(text, rank_of)
        if len(parts) == 1:
            reachable[i] = True
            left[i], right[i] = ids[made[-1][1]], ids[made[-1][2]]
            orders = [m[0] for m in made]
            irregular[i] = any(a >= b for a, b in zip(orders[:-1], orders[1:])) and not _in_order(text, made, rank_of)
    keys, merged = [], []
    for i in plain:
        text = text_of[i]
        for cut in range(1, len(text)):
            a, b = ids.get(text[:cut]), ids.get(text[cut:])
            if a is not None and b is not None:
                keys.append(a * (size + 1) + b)
                merged.append(i)
    order = np.argsort(keys)
    decoded = [b""] * (size + 1)
    for i in range(size):
        if i in text_of:
            decoded[i] = text_of[i].encode()
        elif model.is_byte(i):
            decoded[i] = bytes([int(model.id_to_piece(i)[3:5], 16)])
        elif model.is_unknown(i):
            decoded[i] = " ⁇ ".encode()
    pairs = {(ord(a), ord(b)) for t in text_of.values() for a, b in zip(t[:-1], t[1:])}
    return Vocabulary(
        size=size, piece_bytes=decoded, searched=np.array([i for i in plain if reachable[i]]),
        rank=rank, left=left, right=right, irregular=irregular,
        pair_keys=np.array(keys)[order], pair_merged=np.array(merged)[order],
        isolated=np.array([b < 0x20 and not any(chr(b) in t for t in ids) for b in range(256)]),
        byte_ids=np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]),
        neighbours=np.array(sorted(a * 0x110000 + b for a, b in pairs), np.int64),
        by_bytes={t.encode(): i for t, i in ids.items()}, merge_rank=rank_of,
    )


def _in_order(text: str, made: list, rank_of: dict[str, int]) -> bool:
    """Whether each piece was made after its parts, by rank: then its merges can be undone by rank."""
    own = {a + b: order for order, a, b in made}
    return all(own.get(a, -1) < order and own.get(b, -1) < order for order, a, b in made)


def fitting(vocabulary: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of tokens can be neighbours.

    Undo, latest first, the merges that made the two, on the side of their border. A merge across the
    border that ranks before the merge just undone would have come first. Among equal ranks the left
    one does.
    """
    v = vocabulary
    fits = np.ones(len(left), bool)
    at = np.arange(len(left))
    left, right = left.astype(np.int64), right.astype(np.int64)
    limit = np.full(len(left), np.iinfo(np.int64).max)  # twice the rank, one more if a tie is lost
    while len(at):
        key = left * (v.size + 1) + right
        place = np.minimum(np.searchsorted(v.pair_keys, key), len(v.pair_keys) - 1)
        crossing = v.pair_keys[place] == key
        crossing &= 2 * v.rank[v.pair_merged[place]] < limit
        fits[at[crossing]] = False
        rank_left, rank_right = v.rank[left], v.rank[right]
        going = ~crossing & ((rank_left >= 0) | (rank_right >= 0))
        at, left, right, rank_left, rank_right = (x[going] for x in (at, left, right, rank_left, rank_right))
        undo_left = rank_left > rank_right
        limit = np.where(undo_left, 2 * rank_left, 2 * rank_right + 1)
        left, right = np.where(undo_left, v.right[left], left), np.where(undo_left, right, v.left[right])
    return fits


def _windows(data: np.ndarray, left: np.ndarray, first: int) -> np.ndarray:
    """Eight bytes from ``first`` on after every position as a number, zero past the unit's end."""
    out = np.zeros(len(data), np.uint64)
    padded = np.concatenate([data, np.zeros(first + CHUNK, np.uint8)])
    for i in range(CHUNK):
        byte = np.where(left > first + i, padded[first + i : first + i + len(data)], 0).astype(np.uint64)
        out |= byte << np.uint64(8 * (CHUNK - 1 - i))
    return out


class Matcher:
    """Pieces prepared for binary search in sorted suffixes."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        pieces = [vocabulary.piece_bytes[i] for i in vocabulary.searched]
        lengths = np.array([len(p) for p in pieces])
        self.short = vocabulary.searched[lengths <= CHUNK]
        self.short_length = lengths[lengths <= CHUNK]
        heads = np.array([int.from_bytes(p[:CHUNK].ljust(CHUNK, b"\0"), "big") for p in pieces], np.uint64)
        self.low = heads[lengths <= CHUNK]
        rest = (8 * (CHUNK - self.short_length)).astype(np.uint64)
        spread = np.where(rest > 0, (np.uint64(1) << np.minimum(rest, np.uint64(63))) - np.uint64(1), np.uint64(0))
        self.high = self.low | spread
        self.width = max(1, int(lengths.max(initial=1)))
        self.long = vocabulary.searched[lengths > CHUNK]
        self.long_length = lengths[lengths > CHUNK]
        self.long_heads = np.unique(heads[lengths > CHUNK])
        self.long_bytes = np.array([p for p in pieces if len(p) > CHUNK], f"S{self.width}")
        self.long_last = np.array([p + b"\xff" * (self.width - len(p)) for p in pieces if len(p) > CHUNK], f"S{self.width}")

    def edges(self, data: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, token and length of every occurrence of a piece; ``left``: bytes left in the unit."""
        keys = _windows(data, left, 0)
        suffixes = np.argsort(keys)
        ordered = keys[suffixes]
        first, last = np.searchsorted(ordered, self.low, "left"), np.searchsorted(ordered, self.high, "right")
        found = [self._ranges(suffixes, first, last, self.short, self.short_length)]
        if len(self.long):
            at = np.minimum(np.searchsorted(self.long_heads, keys), len(self.long_heads) - 1)
            deeper = np.flatnonzero(self.long_heads[at] == keys)
            padded = np.concatenate([data, np.zeros(self.width, np.uint8)])
            window = padded[deeper[:, None] + np.arange(self.width)]
            window[np.arange(self.width)[None, :] >= left[deeper][:, None]] = 0
            texts = np.ascontiguousarray(window).view(f"S{self.width}").ravel()
            order = np.argsort(texts)
            texts = texts[order]
            first, last = np.searchsorted(texts, self.long_bytes, "left"), np.searchsorted(texts, self.long_last, "right")
            found.append(self._ranges(deeper[order], first, last, self.long, self.long_length))
        start, token, length = (np.concatenate(x) for x in zip(*found))
        inside = length <= left[start]  # a text may hold zero bytes, which look like the padding
        return start[inside], token[inside], length[inside]

    @staticmethod
    def _ranges(suffixes, first, last, tokens, lengths):
        n = np.maximum(last - first, 0)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return suffixes[np.repeat(first, n) + within], np.repeat(tokens, n), np.repeat(lengths, n)

    def encode_units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of concatenated units, and where those of each unit start."""
        v = self.v
        total, units = len(data), len(offsets) - 1
        unit_of = np.repeat(np.arange(units), np.diff(offsets))
        left = offsets[unit_of + 1] - np.arange(total)
        start, token, length = self.edges(data, left)
        # Characters that are no piece: an edge each, to become bytes.
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        char_length = np.diff(np.concatenate([lead, [total]]))
        known = np.zeros(total, bool)
        known[start[length == self._char_bytes(data, start)]] = True
        strange = ~known[lead]
        start = np.concatenate([start, lead[strange]])
        token = np.concatenate([token, np.full(strange.sum(), v.size)])
        length = np.concatenate([length, char_length[strange]])
        direct = np.zeros(units, bool)
        direct[unit_of[start[v.irregular[token]]]] = True

        end = start + length  # in 1 .. total
        order = np.argsort(end * (self.width + 8) - length)  # by end, longest first
        start, token, end = start[order], token[order], end[order]
        first = np.searchsorted(end, np.arange(total + 2))
        best = np.full(total + 1, -1)  # the token that ends at a position
        came = np.full(total + 1, -1)
        sizes = np.diff(offsets)
        by_size = np.argsort(-sizes, kind="stable")
        by_size = by_size[~direct[by_size]]
        sorted_sizes = -sizes[by_size]
        for step in range(1, int(sizes[by_size[0]]) + 1 if len(by_size) else 1):
            ends = offsets[by_size[: np.searchsorted(sorted_sizes, -step, "right")]] + step
            edge = first[ends]
            open_ = edge < first[ends + 1]
            ends, edge = ends[open_], edge[open_]
            begin = ends - step  # the unit's start
            while len(ends):
                origin, candidate = start[edge], token[edge]
                at_start = origin == begin
                fits = at_start.copy()
                inner = np.flatnonzero(~at_start & (best[origin] >= 0))
                fits[inner] = fitting(v, best[origin[inner]], candidate[inner])
                best[ends[fits]], came[ends[fits]] = candidate[fits], origin[fits]
                edge, ends, begin = (x[~fits] for x in (edge + 1, ends, begin))
                more = edge < first[ends + 1]
                edge, ends, begin = edge[more], ends[more], begin[more]
            # ``best`` is indexed by end position; a unit's end is the next one's start, but a start is
            # never read through ``best``.
        failed = ~direct & (sizes > 0) & (best[offsets[1:]] < 0)
        direct |= failed
        return self._collect(data, offsets, best, came, direct)

    @staticmethod
    def _char_bytes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
        byte = data[at]
        return 1 + (byte >= 0xC0).astype(int) + (byte >= 0xE0) + (byte >= 0xF0)

    def _collect(self, data, offsets, best, came, direct):
        """Walk back from all units' ends at once; then ids in order of position."""
        v = self.v
        units = len(offsets) - 1
        chosen = np.zeros(len(data) + 1, bool)
        cursor = offsets[1:][~direct & (np.diff(offsets) > 0)]
        begin = offsets[:-1][~direct & (np.diff(offsets) > 0)]
        while len(cursor):
            chosen[cursor] = True
            cursor = came[cursor]
            going = cursor > begin
            cursor, begin = cursor[going], begin[going]
        ends = np.flatnonzero(chosen)
        ids, widths = best[ends], ends - came[ends]
        strange = ids == v.size
        n = np.where(strange, widths, 1)
        out = np.repeat(ids, n)
        raw = np.repeat(came[ends], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        as_bytes = np.repeat(strange, n)
        out[as_bytes] = v.byte_ids[data[raw[as_bytes]]]
        unit_of_end = np.searchsorted(offsets, ends, "left") - 1
        counts = np.bincount(unit_of_end, n, minlength=units).astype(np.int64)
        if direct.any():
            own = {u: self._direct(bytes(data[offsets[u] : offsets[u + 1]])) for u in np.flatnonzero(direct)}
            at = np.concatenate([[0], np.cumsum(counts)])
            parts, last = [], 0
            for u, ids_of in own.items():
                parts += [out[last : at[u]], np.array(ids_of, np.int64)]
                last = at[u]
                counts[u] = len(ids_of)
            out = np.concatenate([*parts, out[last:]])
        return out.astype(np.int32), np.concatenate([[0], np.cumsum(counts)])

    def _direct(self, unit: bytes) -> list[int]:
        ids = []
        for part in _merges(unit.decode(), self.v.merge_rank)[0]:
            known = self.v.by_bytes.get(part.encode())
            ids += [known] if known is not None else self.v.byte_ids[list(part.encode())].tolist()
        return ids


def _cut(data: np.ndarray, offsets: np.ndarray, isolated: np.ndarray) -> np.ndarray:
    """Starts of units: texts, spaces after something else, isolated characters and what follows them."""
    control = isolated[data]
    space = data == 0x20
    new = np.zeros(len(data) + 1, bool)
    new[offsets] = True
    new[1:-1] |= (space[1:] & ~space[:-1]) | control[1:] | control[:-1]
    new[-1] = False
    return np.flatnonzero(new)


def _cut_long(text: str, neighbours: np.ndarray) -> list[str]:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    pair = points[:-1] * 0x110000 + points[1:]
    at = np.minimum(np.searchsorted(neighbours, pair), len(neighbours) - 1)
    cuts = np.flatnonzero(neighbours[at] != pair) + 1
    edges = [0, *cuts.tolist(), len(points)]
    return [text[a:b] for a, b in zip(edges[:-1], edges[1:])]


def encode_batch(matcher: Matcher, column: pa.Array) -> pa.Array:
    """Ids of each text; NULL stays NULL."""
    import pyarrow.compute as pc

    marked = pc.replace_substring(pc.fill_null(column, ""), SPACE_MARK, " ")
    # The model puts a space before every text that is not empty.
    dummy = pc.if_else(pc.equal(pc.binary_length(marked), 0), "", pc.binary_join_element_wise("", marked, " "))
    data, offsets = text_bytes(dummy)
    starts = _cut(data, offsets, matcher.v.isolated)
    bounds = np.concatenate([starts, [len(data)]]).astype(np.int64)
    units = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]
    ).dictionary_encode()
    distinct = units.dictionary
    lengths = pc.binary_length(distinct).to_numpy()
    # Long units are cut again; their parts join the others.
    parts, part_count = distinct, np.ones(len(distinct), np.int64)
    if (lengths > LONG_UNIT).any():
        pieces = [
            [p.encode() for p in _cut_long(u.decode(), matcher.v.neighbours)] if n > LONG_UNIT else [u]
            for u, n in zip(distinct.to_pylist(), lengths)
        ]
        part_count = np.array([len(p) for p in pieces])
        parts = pa.array([x for p in pieces for x in p], pa.large_binary())
    parts = parts.dictionary_encode()
    part_data, part_offsets = text_bytes(parts.dictionary.cast(pa.large_string()))
    ids, at = encode_blocks(matcher, part_data, part_offsets)
    # Parts of the distinct units, then units of the texts: two gathers.
    ids, at = _gather(ids, at, parts.indices.to_numpy())
    part_at = np.concatenate([[0], np.cumsum(part_count)])
    ids, at = _gather(ids, at[part_at], units.indices.to_numpy())
    of_text = at[np.searchsorted(starts, offsets)]
    mask = pa.array(np.concatenate([column.is_null().to_numpy(zero_copy_only=False), [False]])) if column.null_count else None
    flat = pa.array(ids)
    if mask is None:
        return pa.ListArray.from_arrays(pa.array(of_text, pa.int32()), flat)
    where = pa.array([None if m else o for m, o in zip(mask.to_pylist(), of_text.tolist())], pa.int32())
    return pa.ListArray.from_arrays(where, flat)


def encode_blocks(matcher: Matcher, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units block by block: arrays of this size stay in the processor's cache."""
    cut = offsets[:-1] // BLOCK_BYTES
    edges = np.concatenate([[0], np.flatnonzero(np.diff(cut)) + 1, [len(cut)]])
    ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            own, at = matcher.encode_units(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            ids.append(own)
            counts.append(np.diff(at))
    return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def _gather(values: np.ndarray, at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate groups ``which`` of ``values``; returns them and their new starts."""
    n = np.diff(at)[which]
    ends = np.cumsum(n)
    index = np.arange(n.sum()) + np.repeat(at[:-1][which] - (ends - n), n)
    return values[index], np.concatenate([[0], ends])


def _encode(shared, text: str, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                ids = encode_batch(matcher, part.column(text))
                yield pa.RecordBatch.from_arrays([*(part.column(f) for f in fields), ids], [*fields, "ids"])

    return run


def encode(docs: DataFrame, model_file: str, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """Every row, or its given columns, with ``ids array<int>``, as the model's own library gives them.

    * A NULL text has NULL ids, an empty one none. Repeated rows are encoded alike.
    * Characters without a piece become their UTF-8 bytes' tokens. Texts are encoded whole.
    * A space mark (U+2581) in a text is read as a space, as the library does.
    * An input column named ``ids`` is replaced.
    """
    kept = without(docs, "ids")
    fields = kept.columns if columns is None else list(columns)
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model_file))
    schema = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in fields) + ", ids array<int>"
    shipped = kept.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*fields, text])])
    return shipped.mapInArrow(_encode(shared, text, fields), schema)


def decode_batch(vocabulary: Vocabulary, column: pa.Array) -> pa.Array:
    """Texts of lists of ids; bytes that are no UTF-8 become U+FFFD."""
    sizes = np.array([len(p) for p in vocabulary.piece_bytes])
    table = np.frombuffer(b"".join(vocabulary.piece_bytes), np.uint8)
    at = np.concatenate([[0], np.cumsum(sizes)])
    ids = column.flatten().to_numpy()
    counts = column.value_lengths().fill_null(0).to_numpy()
    data, byte_at = _gather(table, at, ids)
    of_text = byte_at[np.concatenate([[0], np.cumsum(counts)])]
    # Drop the space that encoding put in front.
    first = of_text[:-1][(np.diff(of_text) > 0)]
    drop = first[data[first] == 0x20]
    kept = np.ones(len(data), bool)
    kept[drop] = False
    offsets = of_text - np.searchsorted(drop, of_text, "left")
    data = np.ascontiguousarray(data[kept])
    texts = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(column), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    )
    try:
        out = texts.cast(pa.large_string())
    except pa.ArrowInvalid:
        out = pa.array([t.decode(errors="replace") for t in texts.to_pylist()], pa.large_string())
    if column.null_count:
        import pyarrow.compute as pc

        out = pc.if_else(column.is_valid(), out, None)
    return out.cast(pa.string())


def _decode(shared, ids: str, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * SLICE_BYTES // max(1, 4 * batch.column(ids).nbytes))
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                text = decode_batch(shared.value, part.column(ids))
                yield pa.RecordBatch.from_arrays([*(part.column(f) for f in fields), text], [*fields, "decoded"])

    return run


def decode(rows: DataFrame, model_file: str, ids: str = "ids") -> DataFrame:
    """Every row with ``decoded``, the text of its ids; NULL ids have none.

    Encoding and decoding returns the text, with spaces for space marks. An input column named
    ``decoded`` is replaced.
    """
    kept = without(rows, "decoded")
    shared = rows.sparkSession.sparkContext.broadcast(load_vocabulary(model_file))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + ", decoded string"
    return kept.mapInArrow(_decode(shared, ids, kept.columns), schema)
