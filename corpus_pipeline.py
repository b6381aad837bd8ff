"""Corpus pipeline: from all documents to the token ids of a clean, deduplicated, weighted mix.

Each stage takes ``(spark, docs, sf_dir)`` and works on everything its predecessor kept; its result is
written as Parquet and reread as the next stage's documents. All stages but the last return the
columns of ``documents``. No documents in, none out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import line_dedup, mixing, pieces, simhash, toxicity
from daybook.llm.shared import remove, scratch_path, scratch_scope


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of these documents, scores below 0.5."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of lines that occur earlier; a document of which nothing is left goes.

    ``n_chars``, where there is one, follows the text.
    """
    cleaned = line_dedup.dedup_lines(docs, removed_col="__removed").where("__removed = 0 or text <> ''")
    if "n_chars" in docs.columns:
        changed = F.when(F.col("__removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        cleaned = cleaned.withColumn("n_chars", F.coalesce(changed, "n_chars"))
    return cleaned.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.keep_one(docs, simhash.near_duplicates(docs, words_per_shingle=4, max_bits=4))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    encoded = pieces.encode(docs)
    return encoded.select(F.col("id").alias("doc_id"), F.size("token_ids").alias("n_tokens"), "token_ids", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

#: The classifier, the fingerprints and the tokens are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last, read back. What a stage wrote for itself is
    removed once its result is written, and so is the result before it: two copies of the corpus at most."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
