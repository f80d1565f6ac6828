"""Periodic runs of words, found with suffix trees, and texts with runs collapsed to one period.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal) that no
neighbouring word extends. By the runs theorem every run contains, at one of its Lyndon roots, the longest
Lyndon word that begins there, in one of the two orders of the alphabet. So each position gives two
candidates, and each candidate is extended in both directions by longest common extensions:

* Ukkonen's algorithm builds a suffix tree of the words and one of their reversal.
* An Euler tour, kept to the returns between two children, with the string depth of the node returned to,
  turns the lowest common ancestor of two leaves into a range minimum, answered in constant time from a
  sparse table.
* The order of leaves is the order of suffixes; the next smaller (next greater) suffix ends the longest
  Lyndon word of the first (second) order.

A task takes slices of whole documents. Of a document only stretches go into a tree in which every window
of a few words occurs twice in that document: each window inside a long enough run repeats one period
further on, so no run is lost or cut (``window_words``). Stretches of a slice share one tree, ended by marks of
their own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from fieldgauge.llm.staging import row_and_text, unpacked
from fieldgauge.llm.words import Words, slices, split_words

FOUND = "runs array<struct<start: long, length: long, period: long>>, collapsed string"
SLICE_BYTES = 2 * 2**20


def suffix_tree(text: Sequence[int]) -> tuple[dict[int, int], list[int], list[int], list[int], int]:
    """Ukkonen's suffix tree of a text whose last symbol occurs once.

    Returns ``(child, start, end, suffix, symbols)``: ``child[node * symbols + first symbol]``, the label
    ``text[start:end]`` of the edge into each node, and each leaf's suffix (-1 for inner nodes). Node 0 is
    the root.
    """
    n = len(text)
    symbols = max(text, default=0) + 1
    child: dict[int, int] = {}
    find = child.get
    start, end, link, suffix = [0], [0], [0], [-1]
    node = edge = length = pending = 0
    for i, symbol in enumerate(text):
        pending += 1
        unlinked = 0
        while pending:
            if not length:
                edge = i
            key = node * symbols + text[edge]
            below = find(key)
            if below is None:
                child[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                suffix.append(i - pending + 1)
                if unlinked:
                    link[unlinked] = node
                    unlinked = 0
            else:
                first = start[below]
                span = end[below] - first
                if length >= span:  # walk down
                    edge += span
                    length -= span
                    node = below
                    continue
                if text[first + length] == symbol:  # already there: the rest of this step is implicit
                    length += 1
                    if unlinked:
                        link[unlinked] = node
                    break
                split = len(start)
                child[key] = split
                start += (first, i)
                end += (first + length, n)
                link += (0, 0)
                suffix += (-1, i - pending + 1)
                start[below] = first + length
                child[split * symbols + text[first + length]] = below
                child[split * symbols + symbol] = split + 1
                if unlinked:
                    link[unlinked] = split
                unlinked = split
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - pending + 1
    return child, start, end, suffix, symbols


class Extensions:
    """Longest common extensions of suffixes of a text, by lowest common ancestors in its suffix tree."""

    def __init__(self, text: Sequence[int]):
        child, start, end, suffix, symbols = suffix_tree(text)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        nodes = np.fromiter(child.values(), np.int64, len(child))
        order = np.argsort(keys)
        kids = nodes[order].tolist()
        first_kid = np.searchsorted(keys[order] // symbols, np.arange(len(start) + 1)).tolist()
        depth = [0] * len(start)
        leaves, returns = [], []
        stack = [(0, 0)]
        while stack:
            node, back = stack.pop()
            if suffix[node] >= 0:
                leaves.append(suffix[node])
                returns.append(back)
                continue
            a, b = first_kid[node], first_kid[node + 1]
            here = depth[node]
            for kid in kids[a:b]:
                depth[kid] = here + end[kid] - start[kid]
            stack += [(kid, here) for kid in reversed(kids[a + 1 : b])]
            stack.append((kids[a], back))
        self.rank = np.empty(len(text), np.int64)
        self.rank[leaves] = np.arange(len(text))
        self.minima = [np.array(returns, np.int32)]
        width = 1
        while 2 * width <= len(text):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``i`` and ``j``, which differ."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.zeros(len(low), np.int64)
        for at in np.unique(level).tolist():
            here = level == at
            table = self.minima[at]
            out[here] = np.minimum(table[low[here]], table[high[here] - (1 << at)])
        return out


def _next_lower(rank: list[int], stops: list[bool]) -> list[int]:
    """For each position the next one of lower rank, or the next stop."""
    n = len(rank)
    nearest = list(range(1, n + 1))
    for i in range(n - 2, -1, -1):
        j, mine = i + 1, rank[i]
        while not stops[j] and rank[j] > mine:
            j = nearest[j]
        nearest[i] = j
    return nearest


def runs_of(stretches: list[np.ndarray], min_length: int, min_exponent: float) -> np.ndarray:
    """Rows ``(stretch, start, length, period)`` of all runs of sequences of non-negative numbers."""
    count = len(stretches)
    sizes = np.array([len(s) for s in stretches], np.int64)
    if not sizes.sum():
        return np.zeros((0, 4), np.int64)
    # mark 0, stretch, mark 1, stretch, ..: marks occur once and are lower than all words.
    _, words = np.unique(np.concatenate(stretches), return_inverse=True)
    begin = np.cumsum(sizes) - sizes + np.arange(count) + 1
    of = np.repeat(np.arange(count), sizes)
    text = np.empty(sizes.sum() + count + 1, np.int64)
    marks = np.concatenate([begin - 1, [len(text) - 1]])
    text[marks] = np.arange(count + 1)
    at = np.arange(sizes.sum()) + of + 1
    text[at] = words + count + 1
    forward, backward = Extensions(text.tolist()), Extensions(text[::-1].tolist())

    stops = np.zeros(len(text), bool)
    stops[marks] = True
    listed = stops.tolist()
    found = []
    for rank, ends_at_mark in ((forward.rank, True), (-forward.rank, False)):
        until = np.array(_next_lower(rank.tolist(), listed))[at]
        period = until - at
        fits = period * min_exponent <= sizes[of]
        if not ends_at_mark:  # in the second order the end of a text ends no Lyndon word
            fits &= ~stops[until]
        i, p, home = at[fits], period[fits], of[fits]
        if not len(i):
            continue
        right = forward.common(i, i + p)
        left = backward.common(len(text) - i, len(text) - i - p)
        length = left + p + right
        long = length >= np.maximum(min_length, np.ceil(p * min_exponent))
        found.append(np.stack([home, i - left - begin[home], length, p], 1)[long])
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 4), np.int64)


def window_words(min_length: int, min_exponent: float) -> int:
    """Words in a row of which every such window inside a run occurs a second time inside it.

    A window of ``k`` words in a run of length ``L`` and period ``q`` has a copy ``q`` words before or after
    it if ``L - k >= 2q - 1``; ``L`` is at least ``max(min_length, min_exponent * q)``.
    """
    return min(max(min_length, ceil(min_exponent * q)) - 2 * q + 1 for q in range(1, min_length + 2))


def _repeated(words: Words, window: int) -> np.ndarray:
    """Starts of windows that occur again in their text; other windows may be among them by a clash of hashes."""
    n = len(words.codes)
    if n < window:
        return np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(words.of_text) - 1), np.diff(words.of_text)).astype(np.uint64)
    mixed = text[: n - window + 1] * np.uint64(0x9E3779B97F4A7C15)
    for k in range(window):
        mixed = (mixed ^ words.codes[k : n - window + 1 + k].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
    whole = text[: n - window + 1] == text[window - 1 :]
    starts = np.flatnonzero(whole)
    order = np.argsort(mixed[starts], kind="stable")
    values = mixed[starts][order]
    same = values[1:] == values[:-1]
    again = np.zeros(len(starts), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return starts[again]


def find_runs(words: Words, min_length: int, min_exponent: float, slice_words: int = 2**17) -> np.ndarray:
    """Rows ``(text, start, length, period)`` of all runs of a batch, in this order; starts are word numbers."""
    window = window_words(min_length, min_exponent)
    starts = _repeated(words, window)
    text = np.searchsorted(words.of_text, starts, "right") - 1
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] != starts[:-1] + 1) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(starts)]]) - 1 if len(first) else first
    begin, end, home = starts[first], starts[last] + window, text[first]
    long = end - begin >= min_length
    begin, end, home = begin[long], end[long], home[long]
    group = np.cumsum(end - begin) // slice_words
    out = [np.zeros((0, 4), np.int64)]
    for g in np.unique(group):
        here = np.flatnonzero(group == g)
        rows = runs_of([words.codes[begin[i] : end[i]] for i in here], min_length, min_exponent)
        which = here[rows[:, 0]]
        rows[:, 1] += begin[which] - words.of_text[home[which]]
        rows[:, 0] = home[which]
        out.append(rows)
    runs = np.concatenate(out)
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _joined(words: Words, kept: np.ndarray) -> pa.Array:
    """Kept words of each text, joined by one space."""
    at = np.flatnonzero(kept)
    length = words.ends[at] - words.starts[at]
    counts = np.concatenate([[0], np.cumsum(kept)])[words.of_text]
    # Every word brings a space, but the last one of its text.
    room = length + 1
    room[counts[1:][np.diff(counts) > 0] - 1] -= 1
    to = np.concatenate([[0], np.cumsum(room)])
    out = np.full(to[-1], 0x20, np.uint8)
    within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(to[:-1], length) + within] = words.data[np.repeat(words.starts[at], length) + within]
    return pa.LargeStringArray.from_buffers(
        len(counts) - 1, pa.py_buffer(to[counts].astype(np.int64)), pa.py_buffer(out)
    )


def _runner(text: str, min_length: int, min_exponent: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                words = split_words(part.column(text))
                runs = find_runs(words, min_length, min_exponent)
                steps = np.zeros(len(words.codes) + 1, np.int64)
                base = words.of_text[runs[:, 0]] + runs[:, 1]
                np.add.at(steps, base + runs[:, 3], 1)
                np.add.at(steps, base + runs[:, 2], -1)
                rows = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], ["start", "length", "period"])
                offsets = np.concatenate([[0], np.cumsum(np.bincount(runs[:, 0], minlength=part.num_rows))])
                listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)
                collapsed = _joined(words, np.cumsum(steps)[:-1] == 0).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column("_row"), listed, collapsed], ["_row", "runs", "collapsed"])

    return run


def periodic_runs(
    docs: DataFrame, text: str = "text", columns: Sequence[str] | None = None, min_length: int = 6, min_exponent: float = 4,
) -> DataFrame:
    """Runs of repeated words of each text, and the text with each run reduced to its first period.

    Adds ``runs`` (word number of the start, length in words, smallest period; by start, then period) and
    ``collapsed``: the words, joined by one space, without those that some run contains after its first
    period. Words are separated by ASCII white space. A run has at least ``min_length`` words and
    ``min_exponent`` (2 or more) periods.

    * One row per input row; repeated rows and NULL ids stay as they are.
    * A NULL or empty text, or one without words, has no runs and an empty ``collapsed``.
    * ``columns`` (default: all) are carried along, but those named like an output, which it replaces.
    * A text of any length is one row and taken whole; memory is in proportion to the longest stretch that
      repeats itself.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two words and two periods at least")
    names = [c for c in (docs.columns if columns is None else columns) if c.lower() not in ("runs", "collapsed")]
    packed = row_and_text(docs, text, names)
    schema = StructType([*packed.select("_row").schema.fields, *StructType.fromDDL(FOUND).fields])
    found = packed.mapInArrow(_runner("_text", min_length, min_exponent), schema)
    return found.select(*unpacked(names), "runs", "collapsed")

