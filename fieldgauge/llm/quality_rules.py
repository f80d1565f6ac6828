"""Quality rules as a short-circuit cascade, with DataFrame functions only.

Measures of a text are expressions over it; rules are conditions over measures and the text. What each rule
costs and rejects is estimated on a bounded sample: its seconds by timing it there, its rejections by
counting which rules fail together. Rules are then chained greedily, at each place the one that rejects most
of what the earlier ones let pass, per second. In the chain a rule is evaluated for texts that passed all
before it. The order changes the time taken, never a verdict.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.staging import cut_lineage

#: Rows the order of rules is estimated on, and the longest text among them. They pass through the driver:
#: 60 MB at most, at three bytes a character.
SAMPLE_ROWS, SAMPLE_CHARS = 1_000, 20_000

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

LETTERS = r"length(regexp_replace(text, '[^\\p{L}]+', ''))"
CAPITALS = r"length(regexp_replace(text, '[^\\p{Lu}]+', ''))"

#: Rule: condition under which a text fails. NULL counts as not failed.
BASE_RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
}
RULES = {
    "symbols": "100 * n_symbols > 10 * n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 12 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "letters": f"100 * {LETTERS} < 55 * word_chars",
    "capitals": f"100 * {CAPITALS} > 60 * {LETTERS}",
    "list_items": r"100 * regexp_count(text, '(?m)^[ \\t]*[-*•]') > 90 * n_lines",
}


#: Bits of a window's key that hold its place; no text has as many words.
PLACE_BITS = 30

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _from(array: Column, place: int) -> Column:
    return F.slice(array, F.lit(place), F.size(array))


def _neighbours(array: Column, same, value) -> Column:
    """``value`` of both of all neighbours in an array that are the ``same``, in one array."""
    pairs = F.zip_with(array, _from(array, 2), lambda a, b: F.when(same(a, b), F.array(value(a), value(b))))
    return F.array_distinct(F.flatten(F.filter(pairs, lambda pair: pair.isNotNull())))


def measured(docs: DataFrame, text: str = "text", window: int = 3) -> DataFrame:
    """``row`` (all columns of ``docs``), ``text`` and whole-text measures as longs; zeros for a NULL text.

    ``n_words`` and ``word_chars`` (code points in words), ``n_symbols``, ``n_lines`` (lines with a word),
    ``n_dup_lines`` (those equal to an earlier one) and ``n_repeat_words`` (words in windows of three that
    occur twice or more).

    Windows are sorted as numbers, a hash in front and the place behind; only those whose hash has an equal
    neighbour are written out and sorted as text, which decides. Steps are projections of their own, as the
    optimizer does not merge one whose arrays the next uses more than once.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").cast("string").alias("text")
    )
    whole = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    split = packed.select(
        "row", "text", F.array_remove(F.split(F.translate(whole, SPACES, " " * len(SPACES)), " "), "").alias("_words"),
        lines.alias("_lines"),
    )
    words, mask = F.col("_words"), (1 << PLACE_BITS) - 1
    windows = F.arrays_zip(*[F.slice(words, F.lit(1 + k), F.size(words) - (window - 1)) for k in range(window)])
    keyed = split.select(
        "row", "text", "_words", "_lines",
        F.when(F.size(words) >= window, F.sort_array(F.transform(
            windows, lambda w, i: F.xxhash64(w).bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))
        ))).alias("_keys"),
    )
    again = _neighbours(F.col("_keys"), lambda a, b: a.bitwiseXOR(b) <= mask, lambda a: a.bitwiseAND(F.lit(mask)).cast("int"))
    hashed = keyed.select("row", "text", "_words", "_lines", again.alias("_again"))
    written = F.transform("_again", lambda i: F.struct(
        F.concat_ws(" ", *[F.get(words, i + k) for k in range(window)]).alias("text"), i.alias("at")
    ))
    ordered = hashed.select(
        "row", "text", "_words", "_lines", F.when(F.size("_again") > 0, F.sort_array(written)).alias("_again")
    )
    starts = _neighbours(F.col("_again"), lambda a, b: a["text"] == b["text"], lambda a: a["at"])
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.sequence(i, i + (window - 1)))))
    values = {
        "n_words": F.size("_words"), "word_chars": F.length(F.translate(whole, SPACES, "")),
        "n_symbols": F.length(whole) - F.length(F.translate(whole, SYMBOLS, "")),
        "n_lines": F.size("_lines"), "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.when(F.col("_again").isNull(), 0).otherwise(F.size(covered)),
    }
    # A struct in a lambda, so that what later conditions read is not worked out again for each.
    struct = F.struct(*[values[m].cast("long").alias(m) for m in MEASURES])
    counted = ordered.select("row", "text", F.transform(F.array(struct), lambda m: m)[0].alias("_m"))
    return counted.select("row", "text", *[F.col(f"_m.{m}").alias(m) for m in MEASURES])


def fails(condition: str) -> Column:
    return F.coalesce(F.expr(condition), F.lit(False))


def estimate(sample: DataFrame, rules: Mapping[str, str]) -> tuple[dict[str, float], dict[int, int]]:
    """Seconds each rule takes over a staged sample, and how many rows fail each set of rules (as bits)."""

    def seconds(column: Column) -> float:
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            sample.agg(F.count_if(column)).collect()
            best = min(best, time.perf_counter() - start)
        return best

    idle = seconds(F.lit(False))
    costs = {name: max(seconds(fails(rule)) - idle, 1e-3) for name, rule in rules.items()}
    bits = sum((F.when(fails(rule), 1 << i).otherwise(0) for i, rule in enumerate(rules.values())), F.lit(0))
    together = {r["bits"]: r["n"] for r in sample.groupBy(bits.alias("bits")).agg(F.count("*").alias("n")).collect()}
    return costs, together


def cascade_order(costs: Mapping[str, float], together: Mapping[int, int]) -> list[str]:
    """Rules by rejections per second among the rows that the rules before let pass."""
    place = {name: i for i, name in enumerate(costs)}
    left, passed, order = list(costs), dict(together), []
    while left:
        rejected = {r: sum(n for bits, n in passed.items() if bits >> place[r] & 1) for r in left}
        best = min(left, key=lambda r: (-rejected[r] / costs[r], costs[r], place[r]))
        passed = {bits: n for bits, n in passed.items() if not bits >> place[best] & 1}
        left.remove(best)
        order.append(best)
    return order


def cascade(rules: Mapping[str, str], order: Sequence[str]) -> Column:
    """True if no rule fails; a rule is evaluated only where those before it passed."""
    verdict = F.lit(True)
    for name in reversed(order):
        verdict = F.when(fails(rules[name]), False).otherwise(verdict)
    return verdict


def judge(
    docs: DataFrame, text: str = "text", base: Mapping[str, str] = BASE_RULES, rules: Mapping[str, str] = RULES,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct), the measures, ``base_failed`` and ``kept``.

    ``kept`` is true if neither a rule of ``base`` nor one of ``rules`` fails. Rules are SQL conditions over
    the measures and ``text``.

    * One row per input row; repeated rows, NULL ids and columns of any name stay in ``row``.
    * A NULL text has zero measures, as an empty one or one without words has.
    * A text is one row and taken whole; its windows are held by one task, about 100 bytes a word.
    * The order of rules is estimated on ``sample_rows`` rows of the first partitions (texts of up to
      ``SAMPLE_CHARS``); of an empty table it is the order of cost alone.
    """
    found = measured(docs, text)
    everything = {**base, **rules}
    texts = docs.select(F.col(f"`{text}`").cast("string").alias("text")).filter(F.length("text") <= SAMPLE_CHARS)
    # ``take`` reads as few partitions as it needs; a limit inside a job would gather some rows of every one.
    head = docs.sparkSession.createDataFrame(texts.take(sample_rows), texts.schema)
    sample = cut_lineage(measured(head).select("text", *MEASURES))
    order = cascade_order(*estimate(sample, everything))
    failed = F.lit(False)
    for rule in base.values():
        failed = failed | fails(rule)
    return found.select("row", *MEASURES, failed.alias("base_failed"), cascade(everything, order).alias("kept"))
