"""Language identification of mixed-language text.

Each word's script narrows the languages it may belong to; hashed character n-grams score it under
each of those; a Viterbi pass over the words of a text, with a penalty for every switch, labels spans.
A batch's words are scored once per distinct word, and all its texts take their Viterbi steps together.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.staging import without
from fieldgauge.llm.words import Words, slices, split_words

UNKNOWN = "und"
#: Hash buckets of n-gram counts, and rows of each language that are learned from (expected number).
BUCKETS = 2**15
SAMPLE_ROWS = 5_000
SWITCH_PENALTY = 12.0
#: Bytes of text that are scored together; n-gram arrays take some dozen times as much.
SLICE_BYTES = 2 * 2**20
#: A word of one language is at most this much likelier than of another, so one odd word decides little.
WORD_LIMIT = 8.0
#: Languages a model may hold, one bucket row of counts each; more labels are an error.
MAX_LANGUAGES = 1_000

# First and last code point of scripts, in order.
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)
SCRIPT_NAMES = tuple(dict.fromkeys(name for name, _, _ in SCRIPTS)) + ("other",)
_FIRST = np.array([a for _, a, _ in SCRIPTS])
_LAST = np.array([b for _, _, b in SCRIPTS])
_NUMBER = np.array([SCRIPT_NAMES.index(name) for name, _, _ in SCRIPTS])


def scripts_of(points: np.ndarray) -> np.ndarray:
    """Script number of each code point."""
    at = np.searchsorted(_FIRST, points, "right") - 1
    inside = (at >= 0) & (points <= _LAST[np.maximum(at, 0)])
    return np.where(inside, _NUMBER[np.maximum(at, 0)], len(SCRIPT_NAMES) - 1)


@cache
def letter_table() -> np.ndarray:
    """Whether a code point is a letter, by Unicode category."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)], bool)


@dataclass
class Grams:
    """n-gram buckets of distinct words, size by size: those of word ``i`` are ``at[i]:at[i + 1]``."""

    by_size: list[tuple[np.ndarray, np.ndarray]]
    letters: np.ndarray
    script: np.ndarray


def grams_of(distinct: pa.Array, buckets: int) -> Grams:
    """Buckets of 1- to 4-grams of the lower-cased letters of each word, borders included."""
    lowered = pc.utf8_lower(distinct.cast(pa.large_string()))
    joined = "\n".join(lowered.to_pylist()) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    is_letter = letter_table()[points]
    border = points == 0x0A
    kept = is_letter | border
    points, border = points[kept], border[kept]
    word = np.cumsum(border) - border
    n = len(distinct)
    count = np.bincount(word[~border], minlength=n)
    # The script most letters of a word have.
    table = np.bincount(
        word[~border] * len(SCRIPT_NAMES) + scripts_of(points[~border]), minlength=n * len(SCRIPT_NAMES)
    ).reshape(n, len(SCRIPT_NAMES))
    padded = np.where(border, 0x20, points).astype(np.uint64)
    by_size = []
    multiplier, mask = np.uint64(0x9E3779B97F4A7C15), np.uint64(buckets - 1)
    before = np.concatenate([[0x20], padded[:-1]]).astype(np.uint64) if len(padded) else padded
    rolling = np.zeros(len(padded), np.uint64)
    # An n-gram starts at the border before the word, or at a letter, and ends within the word's border.
    shifted = before
    for size in range(1, 5):
        if size > 1:
            shifted = np.concatenate([shifted[1:], np.full(min(1, len(shifted)), 0x20, np.uint64)])
        rolling = (rolling + shifted + np.uint64(size)) * multiplier
        rolling ^= rolling >> np.uint64(29)
        last = np.arange(len(padded)) + size - 2
        fits = (last < len(padded)) & (count[word] > 0)
        fits &= word[np.clip(last, 0, max(len(padded) - 1, 0))] == word if len(padded) else fits
        if size == 1:
            fits &= before != 0x20
        # Words follow one another, so the n-grams of one size are in their order already.
        by_size.append(((rolling & mask)[fits].astype(np.int64), np.searchsorted(word[fits], np.arange(n + 1))))
    return Grams(by_size, count, table.argmax(axis=1))


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Row sums of consecutive groups, empty ones included."""
    total = np.zeros((len(at) - 1, values.shape[1]), np.float32)
    filled = np.flatnonzero(at[1:] > at[:-1])
    if len(filled):
        total[filled] = np.add.reduceat(values, at[:-1][filled], axis=0)
    return total


@dataclass
class Model:
    languages: list[str]
    log_prob: np.ndarray  # bucket, language
    by_script: np.ndarray  # script, language: may a word of this script be of this language


def _count_partition(languages: list[str], buckets: int):
    """Counts per language of n-gram buckets, and after these of letters per script."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), buckets + len(SCRIPT_NAMES)), np.int64)
        known = pa.array(languages, pa.string())
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words = split_words(part.column("text"))
                if not len(words.codes):
                    continue
                grams = grams_of(words.distinct, buckets)
                label = pc.index_in(part.column("lang"), value_set=known).to_numpy(zero_copy_only=False).astype(np.int64)
                of_word = np.repeat(label, np.diff(words.of_text))
                for number in np.unique(label):
                    times = np.bincount(words.codes[of_word == number], minlength=len(words.distinct))
                    for found, at in grams.by_size:
                        counts[number, :buckets] += np.bincount(
                            found, np.repeat(times, np.diff(at)), minlength=buckets
                        ).astype(np.int64)
                    counts[number, buckets:] += np.bincount(
                        grams.script, times * grams.letters, minlength=len(SCRIPT_NAMES)
                    ).astype(np.int64)
        lang, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang), pa.array(bucket), pa.array(counts[lang, bucket])], ["language", "bucket", "n"]
        )

    return run


def learn(
    docs: DataFrame, lang: str = "lang", text: str = "text", sample_key: str = "doc_id",
    sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS,
) -> Model | None:
    """A model of the languages in ``lang``, from about ``sample_rows`` rows of each, picked by hash.

    Whole texts are counted. What reaches the driver is at most one count per bucket and language.
    None if no row has both a text and a language; an error above ``MAX_LANGUAGES`` of them, as none is left out.
    """
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {
        r["lang"]: r["n"]
        for r in rows.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n"))
        .limit(MAX_LANGUAGES + 1).collect()
    }
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in {lang}: is it a column of language codes?")
    if not sizes:
        return None
    languages = sorted(sizes)
    share = F.element_at(
        F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, sample_rows / sizes[k])))]), F.col(lang)
    )
    drawn = F.pmod(F.xxhash64(F.col(sample_key)), F.lit(2**20)) < share * 2**20
    counted = (
        rows.filter(drawn).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
        .mapInArrow(_count_partition(languages, buckets), "language long, bucket long, n long")
        .groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
    )
    table = np.zeros((len(languages), buckets + len(SCRIPT_NAMES)))
    table[counted["language"], counted["bucket"]] = counted["n"]
    grams, by_script = table[:, :buckets], table[:, buckets:]
    smooth = grams + 0.2
    log_prob = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32)
    written = by_script / np.maximum(by_script.sum(axis=1, keepdims=True), 1)
    allowed = (written >= 0.01).T
    allowed[~allowed.any(axis=1)] = True  # a script no language is written in narrows nothing
    return Model(languages, np.ascontiguousarray(log_prob), allowed)


def word_scores(words: Words, model: Model, excluded: float) -> tuple[np.ndarray, np.ndarray]:
    """Scores (word, language) of distinct words, the best being 0, and their numbers of letters.

    A language that a word's script excludes costs ``excluded``, whatever the n-grams say.
    """
    grams = grams_of(words.distinct, len(model.log_prob))
    scores = sum(_sums(model.log_prob[found], at) for found, at in grams.by_size)
    allowed = model.by_script[grams.script]
    best = np.where(allowed, scores, -np.inf).max(axis=1, keepdims=True)
    scores = np.where(allowed, np.maximum(scores - best, -WORD_LIMIT), -excluded)
    scores[grams.letters == 0] = 0.0
    return scores.astype(np.float32), grams.letters


def viterbi(scores: np.ndarray, at: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word, for all texts in step. ``at``: where the words of each text start.

    Staying costs nothing and any switch the penalty, so the only rival of staying is the best label
    of the step before.
    """
    lengths = np.diff(at)
    order = np.argsort(-lengths, kind="stable")
    lengths, starts = lengths[order], at[:-1][order]
    labels = np.zeros(len(scores), np.int16)
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), "left")  # texts longer than the step
    stayed = np.zeros(scores.shape, bool)
    rival = np.zeros(len(scores), np.int16)
    best = np.zeros((len(lengths), scores.shape[1]), np.float32)
    for step in range(steps):
        n = active[step]
        here = starts[:n] + step
        if step == 0:
            best[:n] = scores[here]
            continue
        top = best[:n].argmax(axis=1)
        switched = best[np.arange(n), top] - penalty
        keep = best[:n] >= switched[:, None]
        stayed[here], rival[here] = keep, top
        moved = np.where(keep, best[:n], switched[:, None]) + scores[here]
        best[:n] = moved - moved.max(axis=1, keepdims=True)  # keeps long sums exact
    current = best.argmax(axis=1).astype(np.int16) if len(lengths) else np.zeros(0, np.int16)
    for step in range(steps - 1, -1, -1):
        n = active[step]
        here = starts[:n] + step
        labels[here] = current[:n]
        if step:
            current[:n] = np.where(stayed[here, current[:n]], current[:n], rival[here])
    return labels


def _predict(model: Model, penalty: float, with_spans: bool, text: str, fields: list[str]):
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    # More than switching to another language for one word and back.
    excluded = 2 * penalty + WORD_LIMIT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                yield label(part)

    def label(part: pa.RecordBatch) -> pa.RecordBatch:
        words = split_words(part.column(text))
        n, langs = part.num_rows, len(model.languages)
        if len(words.codes):
            scores, size = word_scores(words, model, excluded)
            count = size[words.codes]
            spoken = np.flatnonzero(count)  # words without a letter belong to no span
            text_of = np.repeat(np.arange(n), np.diff(words.of_text))[spoken]
            at = np.searchsorted(text_of, np.arange(n + 1))
            labels = viterbi(scores[words.codes[spoken]], at, penalty)
            mass = np.bincount(text_of * langs + labels, count[spoken], minlength=n * langs).reshape(n, langs)
        else:
            spoken, text_of, labels = (np.zeros(0, np.int64),) * 3
            mass = np.zeros((n, langs))
        total = mass.sum(axis=1)
        top = np.where(total > 0, mass.argmax(axis=1), langs)
        score = np.where(total > 0, mass.max(axis=1) / np.maximum(total, 1), 0.0)
        columns = [part.column(f) for f in fields] + [pa.array(names[top], pa.string()), pa.array(score)]
        out = [*fields, "lang_pred", "score"]
        if with_spans:
            columns.append(_spans(words, spoken, text_of, labels, n, names))
            out.append("spans")
        return pa.RecordBatch.from_arrays(columns, out)

    return run


def _spans(words: Words, spoken, text_of, labels, n: int, names) -> pa.Array:
    """Runs of equally labelled words of one text, as code-point ranges."""
    points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    new = np.ones(len(spoken), bool)
    new[1:] = (text_of[1:] != text_of[:-1]) | (labels[1:] != labels[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(spoken)]]) - 1 if len(first) else first
    base = points[words.offsets[text_of[first]]]
    runs = pa.StructArray.from_arrays(
        [
            pa.array(points[words.starts[spoken[first]]] - base), pa.array(points[words.ends[spoken[last]]] - base),
            pa.array(names[labels[first]], pa.string()),
        ],
        ["start", "end", "lang"],
    )
    at = np.searchsorted(text_of[first], np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), runs)


SPANS = "array<struct<start: long, end: long, lang: string>>"


def identify(
    docs: DataFrame, model: Model | None, text: str = "text", penalty: float = SWITCH_PENALTY, spans: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Every row, or its given columns, with ``lang_pred``, ``score`` and, unless told otherwise, ``spans``.

    ``score`` is the share of the text's letters that lie in spans of ``lang_pred``; ``spans`` are
    code-point ranges without gaps in labelling: words without letters belong to none.

    * A text that is NULL, empty or without a letter is ``und`` with score 0 and no spans.
    * Of languages with equal shares the first by name wins. Without a model all texts are ``und``.
    * Texts are read whole; a very long one is a slice of its own. Repeated rows are labelled alike.
    * Input columns named like an added one are replaced.
    """
    kept = without(docs, "lang_pred", "score", "spans")
    names = kept.columns if columns is None else list(columns)
    if model is None:
        plain = kept.select(*[F.col(f"`{c}`") for c in names]).withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
        return plain.withColumn("spans", F.array().cast(SPANS)) if spans else plain
    added = ", lang_pred string, score double" + (f", spans {SPANS}" if spans else "")
    schema = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in names) + added
    shipped = kept.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*names, text])])
    return shipped.mapInArrow(_predict(model, penalty, spans, text, names), schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learned from; a NULL id is not among them, nor among the learned."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(False))


def learn_documents(docs: DataFrame, doc_id: str = "doc_id", **options) -> Model | None:
    """The production model of ``documents``: from rows that are not held out."""
    rows = docs.filter(~held_out(doc_id) & F.col(doc_id).isNotNull())
    return learn(rows, sample_key=doc_id, **options)

