"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlap.llm import byte_bpe, decontaminate, jaccard_join, quality, suffix_dedup
from gridlap.llm.common import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject; texts without content have nothing to reject and stay."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out_fold=(0, 5))
    rejected = quality.score(docs.where("text IS NOT NULL AND text != ''"), model).where(F.col("score") < quality.THRESHOLD)
    return docs.join(rejected.select("doc_id").distinct(), "doc_id", "left_anti").select(COLUMNS)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each class of near duplicates; of repeated rows of it, one. Rows that repeat a doc_id with other texts stay."""
    classes = jaccard_join.jaccard_classes(docs)
    gone = classes.where("doc_id != class_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(COLUMNS)
    with_id = kept.where("doc_id IS NOT NULL").withColumn("text_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "text_hash"])
    return with_id.select(COLUMNS).union(kept.where("doc_id IS NULL"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of earlier documents; a document of which nothing remains goes, and n_chars follows the text."""
    cut = suffix_dedup.deduplicated(docs.withColumn("no_text", F.isnull("text")), carry=["lang", "source", "n_chars", "no_text"])
    changed = F.col("n_removed") > 0
    length = F.when(changed, F.char_length("kept").cast("long")).otherwise(F.col("n_chars"))
    left = cut.where(~changed | (F.col("kept") != ""))
    return left.select("doc_id", F.when(~F.col("no_text"), F.col("kept")).alias("text"), "lang", "source", length.alias("n_chars"))


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    hits = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(hits.select("doc_id").distinct(), "doc_id", "left_anti").select(COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as token ids: doc_id, ids, n_tokens."""
    encoded = byte_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_class),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_leaks),
    ("byte-level BPE", token_ids),
]

# Compression, similarity joins and tokenization have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
