"""The registered queries ``opN_<name>``: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import alignment, cell_dedup, line_dedup, mixing, multi_index, phrases, pieces, pii, sharding, simhash, toxicity, url_rules, warc
from daybook.llm.shared import materialise

URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near-equal bytes."""
    placed = sharding.shard_by_size(_table(spark, sf_dir, "documents"), 16)
    return placed.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                         "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest of every 20th vector among all vectors, by inner product."""
    rows = _table(spark, sf_dir, "embeddings")
    return multi_index.search(rows, rows.where("vec_id % 20 = 0"), 20)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed 5 : 2 : 1 by source, three epochs at most."""
    mixture = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixture.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, looked up in their index and read back."""
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL by the given rules, else by association rules."""
    return url_rules.judge(_table(spark, sf_dir, "pages"), URL_RULES).withColumnRenamed("id", "page_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that occur earlier."""
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "lines_removed", "text")


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SentencePiece ids, and whether they decode to its text."""
    encoded = pieces.encode(_table(spark, sf_dir, "documents"))
    return encoded.select(F.col("id").alias("doc_id"), F.size("token_ids").alias("n_tokens"), "token_ids", "round_trip")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; fold 0 is held out."""
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select(F.col("id").alias("doc_id"), F.coalesce(toxicity.fold(F.col("id")) == 0, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_cell_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors of one label with cosine 0.93 or more."""
    return cell_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), 0.93).withColumnRenamed("id", "vec_id") \
        .withColumnRenamed("component", "component_id").select("vec_id", "n_links", "component_id", "kept")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), words_per_shingle=4, max_bits=4)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def alignment_digest(docs: DataFrame) -> DataFrame:
    """Alignment of every document in numbers, with the hash of its groups."""
    aligned = alignment.align(docs).withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)))
    scored = alignment.score(materialise(aligned.drop("groups"), "aligned"))
    return scored.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's byte-level BPE tokens aligned with its SentencePiece tokens."""
    return alignment_digest(_table(spark, sf_dir, "documents"))


def pii_digest(found: DataFrame) -> DataFrame:
    """Counts and hash of the patterns' spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("id").alias("doc_id"), *map(of_kind, pii.KINDS), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: the patterns' spans and those the network adds."""
    docs = _table(spark, sf_dir, "documents")
    return pii_digest(pii.find(docs, pii.fit(docs)))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 strongest collocations of two and three words."""
    return phrases.top_collocations(_table(spark, sf_dir, "documents"), top=2000)


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_multi_index": op2_multi_index,
    "op3_mixing": op3_mixing,
    "op4_warc": op4_warc,
    "op5_url_rules": op5_url_rules,
    "op6_line_dedup": op6_line_dedup,
    "op7_pieces": op7_pieces,
    "op8_toxicity": op8_toxicity,
    "op9_cell_dedup": op9_cell_dedup,
    "op10_simhash": op10_simhash,
    "op11_alignment": op11_alignment,
    "op12_pii": op12_pii,
    "op13_phrases": op13_phrases,
}
