"""A training corpus from raw documents: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontam, near_copies, paragraph_dedup, sp_dropout, toxicity
from tessera.llm.shared import materialise, release


# Each stage keeps all columns of documents, also those whose names it uses itself, and gives an empty table for one.


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity comes from a grade over 0 that is at least as likely as not go.

    Null and empty texts have no toxic word and stay; rows without a key and repeated rows are judged one by one.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    release(spark)  # the driver's Python has held the words of the labelled documents
    return toxicity.keep_clean(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays whose five-word shingles have a Jaccard similarity of 0.8 or more.

    SimHash joins the nearest of them, the rest is found by shingles (``near_copies``). Null and empty texts are
    copies of each other; of rows that repeat the key that stays, the least stays; rows without a key all stay.
    """
    return near_copies.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has too are cut out; documents left without a word go.

    Null and empty texts and rows without a key stay as they are; of rows that repeat a key only those with the
    least of their texts are cut.
    """
    return paragraph_dedup.remove_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item occurs go, with all rows of their key; rows without a key stay, null and empty texts too."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document; they decode to its text exactly. Null and empty texts have none; repeated rows and rows without a key are encoded like others."""
    return sp_dropout.encode(docs, extra=[c for c in ("lang", "source") if c in docs.columns])


#: (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame.
STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece_encoding", tokenise),
]

#: SQL can't express the fingerprints, models and alignments of these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each over all that the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
