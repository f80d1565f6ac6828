"""Chat formatting by columnar byte assembly.

Turns are dealt by ranges of ``(conversation, turn)``, so a conversation of any length is formatted by
many tasks. In a task numpy computes the length of every segment (marker, role, text, marker), their
cumulative offsets and the scatter indices, and copies all of them into one preallocated buffer, which
becomes the Arrow column as it is.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts every ``<``, followed by
any number of backslashes and a ``|``, gets one backslash more, so control strings occur as marks only,
and reading back takes that backslash away again. In roles, backslashes and line feeds are escaped
before, as ``\\\\`` and ``\\n``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: A block of formatted turns is closed when it holds this many bytes.
BLOCK_BYTES = 2 * 2**20
#: Segments longer than this are copied as slices; index arrays are built for the others.
LONG_SEGMENT = 4096

FORMATTED = (
    "conv_id long, block long, n_turns long, formatted string, "
    "loss_spans array<struct<start: long, end: long>>"
)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its values; NULL is empty."""
    filled = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(offsets) else raw, offsets - offsets[0]


def _escaped(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control strings escaped in all values at once: a backslash before each ``|`` that closes one."""
    bars = np.flatnonzero(data == ord("|"))
    bars = bars[bars > 0]
    if not len(bars):
        return data, offsets
    # The last byte before each bar that is no backslash; it must be a "<" of the same value.
    if (data == ord("\\")).any():
        solid = np.maximum.accumulate(np.where(data != ord("\\"), np.arange(len(data)), -1))
        before = solid[bars - 1]
    else:
        before = bars - 1
    value_start = offsets[np.searchsorted(offsets, bars, "right") - 1]
    hit = bars[(before >= value_start) & (data[np.maximum(before, 0)] == ord("<"))]
    if not len(hit):
        return data, offsets
    return np.insert(data, hit, ord("\\")), offsets + np.searchsorted(hit, offsets, "left")


def _scatter(out: np.ndarray, to: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy each value of a column to its place in ``out``."""
    lengths = np.diff(offsets)
    for i in np.flatnonzero(lengths > LONG_SEGMENT):
        out[to[i] : to[i] + lengths[i]] = data[offsets[i] : offsets[i + 1]]
    short = np.flatnonzero((lengths <= LONG_SEGMENT) & (lengths > 0))
    if len(short):
        n = lengths[short]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(to[short], n) + within] = data[np.repeat(offsets[short], n) + within]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Buffer, np.ndarray, np.ndarray, np.ndarray]:
    """All turns as one buffer, with the byte offsets of turns and of the texts in them."""
    role_data, role_at = _escaped(*_bytes_of(roles))
    text_data, text_at = _escaped(*_bytes_of(texts))
    n = len(role_at) - 1
    pieces = [(np.frombuffer(s.encode(), np.uint8)) for s in (START, "\n", END + "\n")]
    role_len, text_len = np.diff(role_at), np.diff(text_at)
    turn_len = role_len + text_len + sum(len(p) for p in pieces)
    turn_at = np.concatenate([[0], np.cumsum(turn_len)])
    buffer = pa.allocate_buffer(int(turn_at[-1]))
    out = np.frombuffer(buffer, np.uint8)
    role_to = turn_at[:-1] + len(pieces[0])
    text_to = role_to + role_len + len(pieces[1])
    for piece, to in zip(pieces, (turn_at[:-1], role_to + role_len, text_to + text_len)):
        out[to[:, None] + np.arange(len(piece))] = piece
    _scatter(out, role_to, role_data, role_at)
    _scatter(out, text_to, text_data, text_at)
    return buffer, turn_at, text_to, text_to + text_len if n else text_to


def _format_slice(batch: pa.Table, loss_roles: pa.Array) -> pa.RecordBatch:
    """Consecutive rows, each run of one conversation as one row."""
    conv, block = batch.column("conv_id").combine_chunks(), batch.column("block").combine_chunks()
    roles, texts = batch.column("role").combine_chunks(), batch.column("text").combine_chunks()
    buffer, turn_at, text_from, text_to = assemble(roles, texts)
    ids, valid = pc.fill_null(conv, 0).to_numpy(), conv.is_valid().to_numpy(zero_copy_only=False)
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (valid[1:] != valid[:-1])
    first = np.flatnonzero(new)
    bounds = np.concatenate([first, [len(ids)]])
    # Offsets in code points: bytes that do not continue a character.
    points = np.concatenate([[0], np.cumsum((np.frombuffer(buffer, np.uint8) & 0xC0) != 0x80)])
    row_of = np.cumsum(new) - 1
    masked = pc.fill_null(pc.is_in(roles, value_set=loss_roles), False).to_numpy(zero_copy_only=False)
    masked &= text_to > text_from
    base = points[turn_at[bounds[row_of]]]
    spans = pa.StructArray.from_arrays(
        [pa.array((points[x] - base)[masked]) for x in (text_from, text_to)], ["start", "end"]
    )
    span_at = np.concatenate([[0], np.cumsum(np.bincount(row_of[masked], minlength=len(first)))])
    text = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(turn_at[bounds].astype(np.int64)), buffer)
    return pa.RecordBatch.from_arrays(
        [
            conv.take(pa.array(first)), block.take(pa.array(first)), pa.array(np.diff(bounds)),
            text.cast(pa.string()), pa.ListArray.from_arrays(pa.array(span_at, pa.int32()), spans),
        ],
        ["conv_id", "block", "n_turns", "formatted", "loss_spans"],
    )


def _formatter(loss_roles: tuple[str, ...], block_bytes: int):
    wanted = pa.array(list(loss_roles), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            weight = sum(
                pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy().astype(np.int64) for c in ("role", "text")
            )
            cut = np.cumsum(weight) // block_bytes
            edges = np.concatenate([[0], np.flatnonzero(np.diff(cut)) + 1, [len(cut)]])
            for a, b in zip(edges[:-1], edges[1:]):
                yield _format_slice(table.slice(a, b - a), wanted)

    return run


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    loss_roles: tuple[str, ...] = ("assistant",), block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Conversations as formatted blocks: ``conv_id, block, n_turns, formatted, loss_spans``.

    A conversation is the concatenation of its blocks in the order of ``block``; most have one.
    ``loss_spans`` are code-point ranges of ``formatted`` that hold the texts of ``loss_roles``, as they
    stand there, that is escaped; empty texts have none.

    * Turns are ordered by turn (NULL first), then role, then text; repeated rows all stay.
    * A NULL text or role is empty. Rows with a NULL conv_id form one conversation.
    * Columns besides these four are left out. An empty table gives no rows.
    """
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    rows = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # Partitions are in order, and so are the numbers within each.
    numbered = dealt.withColumn("block", F.monotonically_increasing_id()).select("conv_id", "block", "role", "text")
    return numbered.mapInArrow(_formatter(tuple(loss_roles), block_bytes), FORMATTED)


TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def read_back(formatted: str, spans) -> tuple[list[tuple[str, str]], list[str]]:
    """Turns of a block, and the texts under the loss mask, unescaped."""
    turns, at = [], 0
    while at < len(formatted):
        found = TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at {at}: {formatted[at : at + 40]!r}")
        turns.append((unescape_role(found[1]), unescape(found[2])))
        at = found.end()
    return turns, [unescape(formatted[s["start"] : s["end"]]) for s in spans]


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose blocks arrive in order; holds one block and two hash states."""
    state, done = None, []

    def finished():
        conv, turns, turn_hash, chars, loss_hash, length = state
        return (conv, turns, turn_hash.hexdigest(), chars, loss_hash.hexdigest(), length)

    def out():
        columns = [pa.array(c, t) for c, t in zip(zip(*done), (
            pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in DIGESTS.split(", ")])

    for batch in batches:
        for row in range(batch.num_rows):
            conv, formatted, spans = (batch.column(c)[row].as_py() for c in ("conv_id", "formatted", "loss_spans"))
            if state is None or state[0] != conv:
                if state is not None:
                    done.append(finished())
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            turns, losses = read_back(formatted, spans)
            state[1] += len(turns)
            for role, text in turns:
                state[2].update(f"{role}\n{text}\n".encode())
            for text in losses:
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(formatted)
        if done:
            yield out()
            done = []
    if state is not None:
        done.append(finished())
        yield out()


def chat_digests(blocks: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted blocks, which pass through one by one."""
    ordered = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return ordered.select("conv_id", "formatted", "loss_spans").mapInArrow(_digest, DIGESTS)
