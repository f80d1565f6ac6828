"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.llm import (
    alignment, chat, jaccard_join, language, mixing, periodic, pivot_dedup, quality_rules, sentencepiece, sharding,
    surrogates, tree_search, url_filter,
)
from fieldgauge.llm.shipping import ship_code

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
EXTRA_TURNS = (
    (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"),
)


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship_code(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.pseudonymise(docs).select("doc_id", "text", "n_replaced")


def op3_sentencepiece(spark: SparkSession, sf_dir: str, model_file: str = PIECE_MODEL) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = sentencepiece.encode(
        docs.withColumn("_crc", F.crc32(F.replace("text", F.lit("▁"), F.lit(" ")))), model_file,
        columns=["doc_id", "_crc"],
    )
    decoded = sentencepiece.decode(encoded, model_file)
    return decoded.select(
        "doc_id", F.coalesce(F.size("ids"), F.lit(0)).alias("n_tokens"), "ids",
        F.crc32("decoded").eqNullSafe(F.col("_crc")).alias("round_trip"),
    )


def op4_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_dedup.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(list(EXTRA_TURNS), "conv_id long, turn long, role string, text string")
    return chat.chat_digests(chat.format_chats(turns.unionByName(extra)))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.learn_documents(docs)
    found = language.identify(docs.select("doc_id", "text"), model, columns=["doc_id"])
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "spans")


def op9_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return tree_search.search(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard_records(table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id", sharding.record_size("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("key").alias("law"),
        "shard", "slot", "grown_shard",
    )


def op11_token_alignment(
    spark: SparkSession, sf_dir: str, a_file: str = BYTE_BPE, b_file: str = PIECE_MODEL
) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = alignment.align(docs, a_file, b_file, columns=["doc_id"], groups="sha256").documents
    return aligned.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )


def planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where a tenth of the documents repeats a stretch of its own words to the end.

    With ``h`` the CRC-32 of the id as text and ``g = h div 10``, a document of ``n`` words with
    ``h % 10 = 0`` repeats, from word ``a = g % n`` on, the ``1 + (n - a) div (3 + g % 8)`` words from there.
    """
    words = "regexp_extract_all(text, '[^\\\\x20\\\\x09-\\\\x0D]+', 0)"
    chosen = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    placed = (
        chosen.withColumn("words", F.expr(f"CASE WHEN h % 10 = 0 THEN {words} END"))
        .withColumn("n", F.expr("CASE WHEN size(words) > 0 THEN size(words) END"))
        .withColumn("a", F.expr("(h div 10) % n"))
        .withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)"))
    )
    repeated = F.expr(
        "array_join(transform(sequence(0L, n - 1L), i -> get(words, int(if(i < a, i, a + (i - a) % p)))), ' ')"
    )
    return placed.select("doc_id", F.when(F.col("n").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest run of each text and digests of all its runs and of the collapsed text."""
    docs = planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.periodic_runs(docs, columns=["doc_id"])
    longest = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    listed = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"), F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


REGISTRY = {
    "op1_mix_sources": op1_mix_sources,
    "op2_pii_surrogates": op2_pii_surrogates,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_vector_dedup": op4_vector_dedup,
    "op5_url_rules": op5_url_rules,
    "op6_chat_format": op6_chat_format,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_language": op8_language,
    "op9_tree_search": op9_tree_search,
    "op10_shards": op10_shards,
    "op11_token_alignment": op11_token_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_quality_rules": op13_quality_rules,
}
