"""A training corpus from documents: each stage applies one operator to what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekeel.llm.best_fit import pack_pieces
from lakekeel.llm.bwt_dedup import bwt_dedup
from lakekeel.llm.ngram_jaccard import ngram_jaccard
from lakekeel.llm.shared import stored
from lakekeel.llm.stream_dedup import sha256, stream_dedup
from lakekeel.llm.tokens import token_pieces
from lakekeel.llm.toxicity import fit, score

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SEQUENCE_TOKENS, END_ID = 1024, 2


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5; NULL and empty texts stay."""
    voters, weights = fit(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, voters, weights, keep=COLUMNS).where("score < 0.5").select(*COLUMNS)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id."""
    kept = stream_dedup(spark, docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    marked = docs.withColumn("_key", sha256(F.coalesce(docs["text"].cast("binary"), F.lit(b""))))
    found = marked.join(kept, marked["doc_id"].eqNullSafe(kept["_id"]) & (marked["_key"] == kept["_digest"]), "left_semi")
    return found.dropDuplicates(["doc_id", "_key"]).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similarity, the one with the least id; documents without words stay."""
    first = ngram_jaccard(spark, docs).where("doc_id <=> component_id").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(first, docs["doc_id"].eqNullSafe(first["_id"]), "left_semi").select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a smaller document has; those of which nothing is left go.

    A character that loses some of its bytes becomes the replacement character.
    """
    cut = bwt_dedup(spark, docs, keep=("lang", "source"))
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    left = cut.where("n_bytes = 0 OR n_removed < n_bytes").withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return left.select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' token pieces in training sequences."""
    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE_TOKENS, END_ID)
    return pack_pieces(spark, pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), SEQUENCE_TOKENS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("ngram_jaccard", without_near_copies),
    ("suffix_array_dedup", without_repeats),
    ("best_fit_packing", packed),
]

#: A learned classifier, components, byte spans and packing can't be said in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
