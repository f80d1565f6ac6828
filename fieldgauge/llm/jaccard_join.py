"""Exact n-gram Jaccard join by prefix trees.

1. Each text becomes the set of its distinct word n-grams (64-bit hashes), in a global order: n-grams
   that are frequent in a bounded sample last, the others by hash. Equal sets are one node from here.
2. Two sets this similar share an n-gram among the first ``n - ceil(t n) + 1`` of each. One row per
   such n-gram, sorted by it, brings the candidates together.
3. In a few rounds every set is compared with one leader it meets: the one that shares most in the first
   round, others later. Leaders and their members' sets meet in buckets of bounded size; a bucket stores
   its sets in a trie (as a sorted list with common prefix lengths), walks it once along the leader,
   shares the overlap of common paths, and cuts off what the remaining lengths can no longer save.
   Links give components, and members of the leader's component need no further comparison.
4. Pairs that meet in an n-gram but are still not in one component are compared in blocks by a short
   parity sketch, whose distance never exceeds the true difference, so no link is lost; what it cannot
   exclude goes through the tries too. Before any trie, a longer sketch of the same kind sorts out pairs.

Only nodes that have a candidate have their sets shuffled: a bit table of fixed size marks them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.components import components
from fieldgauge.llm.staging import cut_lineage, small_side
from fieldgauge.llm.streams import each_group, group_starts, whole_groups
from fieldgauge.llm.words import slices, split_words

NGRAM = 5
PERCENT = 80
#: Expected number of documents whose n-grams are counted to find frequent ones.
SAMPLE_DOCS = 16_000
#: Frequent n-grams that are collected and broadcast, at most (16 bytes each).
HEAVY_TOKENS = 2**21
#: Bits of a short parity sketch, bits per value of a long one, and bits of the table that marks nodes with candidates (8 MB).
SKETCH_BITS = 1024
BITS_PER_VALUE = 4
MARK_BITS = 2**26
MARK_PAGE = 2**15
#: Sets in one bucket, and rows of one block of a large candidate group.
BUCKET_SETS = 512
#: Rounds of comparison with leaders.
ROUNDS = 3
BLOCK_ROWS = 1024

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def ngram_sets(column: pa.Array, ngram: int = NGRAM) -> list[np.ndarray]:
    """The distinct n-gram hashes of each text, ascending; of a shorter text its words as one n-gram."""
    words = split_words(column, lower=True)
    known = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in words.distinct.to_pylist()), np.uint64, len(words.distinct)
    )
    hashes = known[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    rolled = hashes.copy()
    full = max(0, len(hashes) - ngram + 1)
    for step in range(1, ngram):
        rolled[:full] = _scramble(rolled[:full] + np.uint64(step)) + hashes[step : step + full]
    rolled = _scramble(rolled)
    sets = []
    for a, b in zip(words.of_text[:-1].tolist(), words.of_text[1:].tolist()):
        if b - a >= ngram:
            sets.append(np.unique(rolled[a : b - ngram + 1]))
        elif b > a:
            whole = xxhash.xxh3_64_intdigest(hashes[a:b].tobytes(), seed=b - a)
            sets.append(np.array([whole], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def needed(n: int, percent: int = PERCENT) -> int:
    """Least overlap of a set of ``n`` with any set similar to it."""
    return -(-percent * n // 100)


def parity_sketch(values: np.ndarray) -> bytes:
    """Each value flips one bit; two sketches differ in at most as many bits as the sets do in values.

    A sketch has a power of two of bits and some per value, so that few values share one.
    """
    bits = max(SKETCH_BITS, 1 << (BITS_PER_VALUE * len(values) - 1).bit_length())
    flips = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch, or sketches, of the same sets with fewer bits."""
    while sketch.shape[-1] > words:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def apart_at_most(n, m, percent: int):
    """Greatest difference of similar sets of these sizes."""
    return n + m - 2 * -(-percent * (n + m) // (100 + percent))


DESCRIBED = "doc_id long, n_shingles long, fp binary, short binary, long binary, prefix array<long>"


def _describe(ngram: int, percent: int, heavy):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = heavy.value
        for batch in batches:
            for part in slices(batch, "text"):
                yield describe(part, tokens, counts)

    def describe(part, tokens, counts):
        prints, shorts, longs, prefixes, sizes = [], [], [], [], []
        for values in ngram_sets(part.column("text"), ngram):
            n = len(values)
            sizes.append(n)
            if not n:
                prints.append(None), shorts.append(None), longs.append(None), prefixes.append(None)
                continue
            prints.append(xxhash.xxh3_128_digest(values.tobytes()))
            long = np.frombuffer(parity_sketch(values), np.uint64)
            longs.append(long.tobytes()), shorts.append(folded(long, SKETCH_BITS // 64).tobytes())
            first = n - needed(n, percent) + 1
            if len(tokens):
                at = np.minimum(np.searchsorted(tokens, values), len(tokens) - 1)
                seen = np.where(tokens[at] == values, counts[at], 0)
                values = values[np.argsort(seen, kind="stable")]
            # A set that only equal sets are similar to has no candidates.
            lone = percent * (n + 1) > 100 * n and needed(n, percent) == n
            prefixes.append(values[: 0 if lone else first].view(np.int64))
        lengths = [0 if p is None else len(p) for p in prefixes]
        flat = np.concatenate([p for p in prefixes if p is not None] or [np.zeros(0, np.int64)])
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                pa.array(shorts, pa.binary()), pa.array(longs, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
            ],
            ["doc_id", "n_shingles", "fp", "short", "long", "prefix"],
        )

    return run


def _tokens(ngram: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = ngram_sets(part.column("text"), ngram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sets or [np.zeros(0, np.uint64)]).view(np.int64))], ["token"]
                )

    return run


def frequent_tokens(docs: DataFrame, ngram: int, sample_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that most of the sampled documents hold, with their counts there.

    At most ``HEAVY_TOKENS``: all of as many documents or none, so counts of counts tell where to stop.
    The order they give is the same for all documents; that they come from a sample decides how many
    candidates there are, not which links are found.
    """
    rows = docs.count()
    drawn = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(2**20)) < 2**20 * min(1.0, sample_docs / max(rows, 1))
    counted = cut_lineage(
        docs.filter(drawn).select("text").mapInArrow(_tokens(ngram), "token long")
        .groupBy("token").agg(F.count("*").alias("n")).filter("n > 1")
    )
    # One row per count, which is at most the number of rows in the sample.
    least, kept = None, 0
    for r in counted.groupBy("n").agg(F.count("*").alias("tokens")).orderBy(F.desc("n")).toLocalIterator():
        kept += r["tokens"]
        if kept > HEAVY_TOKENS:
            break
        least = r["n"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    frequent = counted.filter(F.col("n") >= least).toPandas()
    tokens = frequent["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], frequent["n"].to_numpy(np.int64)[order]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token those whose token is not theirs alone; holds one row between batches."""
    held, shared_before = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        token = table.column("token").to_numpy()
        same = token[1:] == token[:-1]
        shared = np.concatenate([same, [False]]) | np.concatenate([[shared_before], same])
        held, shared_before = table.slice(len(token) - 1), bool(shared[-1])
        yield from table.slice(0, len(token) - 1).filter(pa.array(shared[:-1])).to_batches()
    if held is not None and shared_before:
        yield from held.to_batches()


def trie_overlaps(query: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Which sets are similar to ``query``; all are ascending arrays of distinct values.

    Sorted sets are the paths of a trie in depth-first order: what two neighbours have in common is the
    path to their branching node, where the overlap so far is known. Below it a set is walked in
    strides and dropped once its overlap can no longer suffice: at depth ``d`` with overlap ``o`` at
    most ``min(len(set) - d, query values not yet passed)`` more can match.
    """
    similar = np.zeros(len(sets), bool)
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    path = np.zeros(0, np.uint64)
    hits = np.zeros(1, np.int64)  # overlap at each depth of the path, as far as it was walked
    for i in order:
        values = sets[i]
        n, m = len(values), len(query)
        need = -(-percent * (n + m) // (100 + percent))
        shared = min(len(path), n, len(hits) - 1)
        differ = np.flatnonzero(path[:shared] != values[:shared])
        depth = int(differ[0]) if len(differ) else shared
        walked, overlap = [hits[: depth + 1]], int(hits[depth])
        stride = max(32, n // 8)
        passed = int(np.searchsorted(query, values[depth - 1], "right")) if depth else 0
        while depth < n and overlap + min(n - depth, m - passed) >= need:
            piece = values[depth : depth + stride]
            at = np.searchsorted(query, piece)
            found = np.cumsum((at < m) & (query[np.minimum(at, m - 1)] == piece)) + overlap
            walked.append(found)
            depth, overlap = depth + len(piece), int(found[-1])
            passed = int(np.searchsorted(query, piece[-1], "right"))
        similar[i] = depth == n and overlap >= need
        path, hits = values, np.concatenate(walked)
    return similar


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links between the sets of a bucket and its leader, whose own rows come along."""
        for bucket in each_group(batches, ["leader", "bucket"]):
            leader = bucket.column("leader")[0].as_py()
            # Rows of one document may come from several tasks.
            once = dict.fromkeys(zip(bucket.column("doc_id").to_pylist(), bucket.column("values").to_pylist()))
            members = [(k, np.frombuffer(v, np.uint64)) for k, v in once if k != leader]
            found = set()
            for key, value in once:
                if key == leader and members:
                    similar = trie_overlaps(np.frombuffer(value, np.uint64), [v for _, v in members], percent)
                    found.update(members[i][0] for i in np.flatnonzero(similar))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([leader] * len(found), pa.int64()), pa.array(sorted(found), pa.int64())], ["a", "b"]
                )

    return run


def _mark(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(MARK_BITS))


def marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is among ``ids``, and few others, without a shuffle.

    A table of ``MARK_BITS`` bits, in pages, is broadcast; its size does not depend on the data.
    """
    pages = cut_lineage(
        ids.select(_mark("id").alias("bit")).distinct().groupBy(F.expr(f"bit div {MARK_PAGE}").alias("_page")).agg(
            F.expr(f"bitmap_construct_agg(bit % {MARK_PAGE})").alias("_bits")
        )
    )
    placed = docs.withColumn("_bit", _mark("doc_id")).withColumn("_page", F.expr(f"_bit div {MARK_PAGE}"))
    byte = F.conv(F.hex(F.expr(f"substring(_bits, cast(_bit % {MARK_PAGE} div 8 as int) + 1, 1)")), 16, 10).cast("int")
    found = placed.join(F.broadcast(pages), "_page").withColumn("_byte", byte)
    return found.filter("shiftright(_byte, cast(_bit % 8 as int)) % 2 = 1").select(*docs.columns)


def _marked_sets(ngram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = ngram_sets(part.column("text"), ngram)
                once = dict.fromkeys(zip(part.column("doc_id").to_pylist(), (s.tobytes() for s in sets)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in once], pa.int64()), pa.array([v for _, v in once], pa.binary())],
                    ["doc_id", "values"],
                )

    return run


def similar_pairs(docs: DataFrame, pairs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """Those of ``pairs (leader, member)``, a staged table without repetitions, whose texts are similar.

    Members are dealt to buckets of about ``BUCKET_SETS`` per leader, so a leader with very many
    members is compared by many tasks; its set is repeated once per bucket.
    """
    ids = pairs.select(F.col("leader").alias("id")).unionByName(pairs.select(F.col("member").alias("id")))
    sets = marked(docs.select("doc_id", "text"), ids).mapInArrow(_marked_sets(ngram), "doc_id long, values binary")
    buckets = pairs.groupBy("leader").agg(F.ceil(F.count("*") / BUCKET_SETS).cast("int").alias("buckets"))
    wanted = pairs.join(buckets, "leader").select(
        "leader", F.pmod(F.xxhash64("member"), F.col("buckets")).cast("int").alias("bucket"),
        F.col("member").alias("doc_id"),
    ).unionByName(
        buckets.select(
            "leader", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"),
            F.col("leader").alias("doc_id"),
        )
    )
    together = wanted.join(sets, "doc_id").repartition("leader", "bucket").sortWithinPartitions("leader", "bucket")
    return together.mapInArrow(_compare(percent), "a long, b long")


def labelled(groups: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``groups`` with the component of each set, its own id where it has no link."""
    plain = groups.drop("component")
    if labels is None:
        return plain.withColumn("component", F.col("rep"))
    return plain.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )


def mixed(groups: DataFrame) -> DataFrame:
    """Labelled rows of the tokens that sets of more than one component share."""
    tokens = groups.groupBy("token").agg(F.min("component").alias("_least"), F.max("component").alias("_most"))
    return groups.join(tokens.filter("_least != _most").select("token"), "token", "left_semi")


def _not_excluded(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
            most = apart_at_most(n, m, percent)
            kept = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
            for i in np.flatnonzero(kept):
                a, b = (np.frombuffer(batch.column(c)[i].as_py(), np.uint64) for c in ("one", "other"))
                words = min(len(a), len(b))
                kept[i] = np.bitwise_count(folded(a, words) ^ folded(b, words)).sum(dtype=np.int64) <= most[i]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(kept)) for c in ("leader", "member")], ["leader", "member"]
            )

    return run


def possible_pairs(pairs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs that sizes and long sketches do not exclude."""
    leaders = nodes.select(F.col("rep").alias("leader"), "n", F.col("long").alias("one"))
    members = nodes.select(F.col("rep").alias("member"), F.col("n").alias("m"), F.col("long").alias("other"))
    return pairs.join(leaders, "leader").join(members, "member").select("leader", "member", "n", "m", "one", "other").mapInArrow(
        _not_excluded(percent), "leader long, member long"
    ).distinct()


def leader_pairs(groups: DataFrame, turn: int, percent: int = PERCENT) -> DataFrame:
    """``(leader, member)``: for every set the foremost leader it meets that is not of its component.

    A token has a leader for each class of sizes; classes are shifted in every other turn. In the first
    two turns the set that shares most goes first, then any.
    """
    order = F.col("weight") if turn < 2 else F.xxhash64(F.lit(turn), "rep")
    size_class = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent)) + 0.5 * (turn % 2)).cast("int")
    rows = groups.withColumn("size_class", size_class).withColumn("order", order)
    leaders = rows.groupBy("token", "size_class").agg(F.max(F.struct("order", "rep", "component")).alias("lead"))
    met = rows.join(leaders, ["token", "size_class"]).filter("component != lead.component")
    return met.groupBy(F.col("rep").alias("member")).agg(F.max(F.struct("lead.order", "lead.rep")).alias("lead")).select(
        F.col("lead.rep").alias("leader"), "member"
    )


def _block_pairs(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of two blocks (or within one) that may be similar, by size and sketch."""
        for table in whole_groups(batches, ["token", "i", "j"]):
            starts = group_starts(table, ["token", "i", "j"]).tolist() + [table.num_rows]
            found = [x for a, b in zip(starts[:-1], starts[1:]) for x in close_pairs(table.slice(a, b - a))]
            if found:
                pairs = np.unique(np.concatenate(found), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["leader", "member"])

    def close_pairs(block: pa.Table) -> Iterator[np.ndarray]:
        side = block.column("side").to_numpy()
        rep, comp, n = (block.column(c).to_numpy() for c in ("rep", "component", "n"))
        bits = np.stack([np.frombuffer(x, np.uint64) for x in block.column("short").to_pylist()])
        right = np.flatnonzero(side == 1)
        for i in np.flatnonzero(side == 0):
            others = right[(comp[right] != comp[i]) & (rep[right] > rep[i])]
            others = others[100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i])]
            if len(others):
                apart = np.bitwise_count(bits[others] ^ bits[i]).sum(axis=1, dtype=np.int64)
                close = others[apart <= apart_at_most(n[others], n[i], percent)]
                yield np.stack([np.full(len(close), rep[i]), rep[close]], axis=1)

    return run


def remaining_pairs(groups: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs of labelled, mixed rows that share a token, are not in one component, and may be similar.

    Of tokens that the same nodes share, as those of a common passage, one is looked at. A group is cut
    into blocks of ``BLOCK_ROWS``, and each pair of blocks is a group of its own.
    """
    shared_by = groups.groupBy("token").agg(
        F.count("*").alias("rows"), F.expr("bit_xor(xxhash64(rep))").alias("print_a"),
        F.expr("bit_xor(xxhash64('b', rep))").alias("print_b"),
    )
    once = cut_lineage(
        shared_by.groupBy("rows", "print_a", "print_b").agg(F.min("token").alias("token"))
        .select("token", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("blocks"))
    )
    rows = groups.join(once, "token").join(nodes.select("rep", "short"), "rep").withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    )
    # A row stands left in (its block, any) and right in (any, its block); pairs are taken in the order
    # of ids, so each is met once.
    wide = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    carried = ("rep", "component", "n", "short")
    left = wide.select("token", F.col("block").alias("i"), F.col("other").alias("j"), F.lit(0).alias("side"), *carried)
    right = wide.select("token", F.col("other").alias("i"), F.col("block").alias("j"), F.lit(1).alias("side"), *carried)
    return (
        left.unionByName(right).repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
        .mapInArrow(_block_pairs(percent), "leader long, member long").distinct()
    )


def jaccard_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ngram: int = NGRAM, percent: int = PERCENT,
    sample_docs: int = SAMPLE_DOCS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Letters A to Z are lower-cased, words are what ASCII white space separates, whole texts are read.
    Documents link if ``100 * intersection >= percent * union``; the component is named by the least id
    that links reach. No link is lost and no pair below the limit links (up to 64-bit hash collisions).

    * A NULL, empty or blank text has no n-grams and links with nothing.
    * A row with a NULL id links with nothing and has a NULL component.
    * Repeated rows stay, with the same component. Of rows with one id and different texts each takes
      the component of its own text.
    * Other columns are left out. An empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    context = docs.sparkSession.sparkContext
    heavy = context.broadcast(frequent_tokens(rows, ngram, sample_docs))
    described = cut_lineage(rows.mapInArrow(_describe(ngram, percent, heavy), DESCRIBED))
    nodes = cut_lineage(
        described.filter("fp IS NOT NULL AND doc_id IS NOT NULL").groupBy("fp").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("short").alias("short"), F.first("long").alias("long"),
            F.first("prefix").alias("prefix"),
        )
    )
    exploded = nodes.select(F.explode("prefix").alias("token"), "n", "rep")
    shared = cut_lineage(
        exploded.repartition("token").sortWithinPartitions("token").mapInArrow(_groups, "token long, n long, rep long")
    )
    sizes = shared.groupBy("token").agg(F.count("*").alias("size"))
    weights = shared.join(sizes, "token").groupBy("rep").agg(F.sum("size").alias("weight"))
    groups = labelled(shared.join(cut_lineage(weights), "rep"), None)
    links, labels, seen = None, None, None
    for turn in range(ROUNDS):
        pairs = cut_lineage(possible_pairs(leader_pairs(groups, turn, percent), nodes, percent))
        if not pairs.isEmpty():
            found = similar_pairs(rows, pairs, ngram, percent)
            links = cut_lineage(found if links is None else links.unionByName(found))
            seen = pairs if seen is None else seen.unionByName(pairs)
            labels = components(links)
        groups = cut_lineage(mixed(labelled(groups, labels)))
    # Whether or not a round found a pair to verify: leaders alone see only some of the pairs.
    rest = remaining_pairs(groups, nodes, percent)
    if seen is not None:
        met = seen.select(F.least("leader", "member").alias("leader"), F.greatest("leader", "member").alias("member"))
        rest = rest.join(met, ["leader", "member"], "left_anti")
    rest = cut_lineage(possible_pairs(rest, nodes, percent))
    if not rest.isEmpty():
        found = similar_pairs(rows, rest, ngram, percent)
        links = cut_lineage(found if links is None else links.unionByName(found))
        labels = components(links)
    if labels is None:
        labels = nodes.select(F.col("rep").alias("node"), F.col("rep").alias("component"))
    of_node = cut_lineage(
        nodes.select("fp", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("fp", F.coalesce("component", "rep").alias("component_id"))
    )
    return described.join(small_side(of_node), "fp", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group: the one that names it; rows with a NULL id all stay.

    Of repeated rows (id and text) one stays.
    """
    found = jaccard_components(docs, doc_id=doc_id, text=text, **options)
    named = cut_lineage(found.filter("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct())
    # Rows travel packed: no column of theirs can meet one used here.
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(f"`{doc_id}`").alias("_id"), F.xxhash64(F.col(f"`{text}`")).alias("_print"),
    )
    once = packed.join(small_side(named), F.col("_id") == F.col("_kept"), "left_semi").dropDuplicates(["_id", "_print"])
    kept = once.unionByName(packed.filter("_id IS NULL"))
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
