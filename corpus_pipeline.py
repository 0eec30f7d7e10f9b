"""A training-data pipeline over documents: each stage gets what its predecessor kept.

Every function takes (spark, docs, sf_dir); run() writes each stage's rows as Parquet in the shared
folder and reads them again. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import near_copies, packing, quality, suffix_dedup, toxicity
from leafmill.llm.shared import discard, documents, labels, materialize, release

#: Near copies in the pipeline: word shingles and least Jaccard similarity.
SHINGLE, SIMILARITY = 5, 0.8
#: Repeated passages of more than so many words go; the shortest, of one-byte words, has PASSAGE_BYTES.
PASSAGE_WORDS = 50
PASSAGE_BYTES = 2 * PASSAGE_WORDS + 1


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep(docs, labels(spark, sf_dir))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half; every label teaches."""
    return toxicity.reject(docs, labels(spark, sf_dir))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near copies."""
    return near_copies.deduplicate(docs, SHINGLE, SIMILARITY)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of repeated passages of over PASSAGE_WORDS words, however short their words are."""
    return suffix_dedup.remove(docs, PASSAGE_BYTES, over_words=PASSAGE_WORDS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [("quality", quality_stage), ("toxicity", toxicity_stage), ("simhash", near_dedup_stage), ("suffix_dedup", suffix_dedup_stage), ("packing", packing_stage)]

#: Hashes, learned models and token ids have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        out = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            discard(before)
        release(spark)
        docs = before = out
    return docs
