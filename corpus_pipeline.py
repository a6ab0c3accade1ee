"""A training corpus from raw documents in stages, each written as Parquet and reread as the next one's input.

All stages take null, empty and very long texts, null doc_ids, repeated rows,
empty tables and further columns of any name; what becomes of them is said at
each stage. All but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brothlake.llm import bpe, mixing, ngram_join, substrings, toxicity
from brothlake.llm.tables import written


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a network trained on the labels finds toxic go; null and empty texts have the score of no words, repeated rows are judged alike."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.clean_documents(docs, toxicity.fitted(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts with five-word shingles of a similarity of 0.8 or more stays, that of the smallest doc_id.

    Null and empty texts are alike to nothing and stay, once for each doc_id;
    of repeated rows one stays.
    """
    return ngram_join.representatives(docs, k=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document of smaller doc_id has are cut out; rows stay, null texts stay null, null doc_ids take and lose nothing."""
    cut = substrings.cut_documents(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, whole; one taken twice is there twice, null and empty texts have nothing to take and go, a null source is one of its own."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their digest and that of the text decoded from them; a null text is an empty one."""
    return bpe.encoded(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("source_mixing", source_mix),
    ("bpe_encoding", tokens),
]

#: SQL cannot express the trained stage and the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
