"""A corpus from raw documents: languages, near-duplicates, personal data, mixing, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.llm import jaccard_join, language, mixing, sentencepiece, surrogates
from fieldgauge.llm.queries import PIECE_MODEL
from fieldgauge.llm.shipping import ship_code
from fieldgauge.session import cut_lineage

#: Spans, trees and tokens are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language or in several; those without text or without a letter go."""
    ship_code(spark)
    model = language.learn_documents(docs)
    found = language.identify(docs, model, spans=False)
    return found.filter(F.col("lang_pred") != language.UNKNOWN).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship_code(spark)
    return jaccard_join.keep_one(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates for personal data; ``n_chars`` follows the text."""
    made = surrogates.pseudonymise(docs)
    return made.withColumn(
        "n_chars", F.when(F.col("n_replaced") > 0, F.length("text")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks."""
    return mixing.mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    ship_code(spark)
    encoded = sentencepiece.encode(docs, PIECE_MODEL, columns=["doc_id", "lang", "source", "n_chars"])
    return encoded.select("doc_id", "lang", "source", "n_chars", F.coalesce(F.size("ids"), F.lit(0)).alias("n_tokens"), "ids")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
