"""Words of Arrow text columns as flat arrays, without a Python object per word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its values; NULL is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = column.cast(pa.large_string())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of a batch: ``of_text[i]:of_text[i + 1]`` are those of text ``i``.

    ``starts`` and ``ends`` are byte positions in ``data``; ``codes`` number the distinct words, whose
    bytes are in ``distinct``.
    """

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    of_text: np.ndarray
    codes: np.ndarray
    distinct: pa.Array


def split_words(column: pa.Array, lower: bool = False) -> Words:
    """Split at ASCII white space; with ``lower``, letters A to Z are lower-cased."""
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    solid = ~SEPARATORS[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], solid[:-1]]) if len(data) else solid
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.concatenate([solid[1:], [False]]) if len(data) else solid
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    of_text = np.searchsorted(starts, offsets)
    packed = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(packed), pa.py_buffer(np.ascontiguousarray(data[solid]))]
    )
    encoded = words.dictionary_encode()
    return Words(data, offsets, starts, ends, of_text, encoded.indices.to_numpy(), encoded.dictionary)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 2 * 2**20):
    """Slices of a batch with about this many bytes of text; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)
    cut = np.cumsum(sizes) // most_bytes
    edges = np.concatenate([[0], np.flatnonzero(np.diff(cut)) + 1, [len(cut)]]) if len(cut) else []
    for a, b in zip(edges[:-1], edges[1:]):
        yield batch.slice(a, b - a)
