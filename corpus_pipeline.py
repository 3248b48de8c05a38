"""A corpus run of five stages: each works on what its predecessor kept, written as Parquet and read again.

Rows without a doc_id go through every stage like others.  Texts that are null count as empty and stay null; extra columns, of any
name, stay as they are; an empty table goes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.llm import exact_dedup, jaccard_join, packing, quality, queries, suffix_dedup
from factweave.llm.common import fresh, stash, table

#: Bytes from which a repeated passage goes: over 50 words reach them even where words are short (3 letters and a space).
PASSAGE, PASSAGE_STRIDE = 200, 50


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; only the text decides, so null and empty texts are judged alike."""
    return quality.keep(docs, queries.quality_voter(docs, table(spark, sf_dir, "labels")))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays; where no row has a doc_id, any one."""
    return exact_dedup.survivors(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingles of five words at 0.8 one stays: the smallest doc_id, rows without one last.

    Rows without a doc_id take part under a number made from their text, above all others.  Texts without words stay.
    """
    key = fresh(docs, "key")
    number = F.shiftrightunsigned(F.xxhash64("text"), 2).bitwiseOR(F.lit(1 << 62))
    named = docs.withColumn(key, F.col("doc_id")).withColumn("doc_id", F.coalesce("doc_id", number))
    return jaccard_join.keep_one(named).withColumn("doc_id", F.col(key)).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the passages of PASSAGE bytes or more that occur elsewhere too; documents that lose all stay, empty."""
    return suffix_dedup.clean(docs, PASSAGE, PASSAGE_STRIDE)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece, with its place in a sequence of 2048 tokens."""
    return packing.pack(docs, queries.tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", packed_sequences),
]

#: Training and packing can't be said in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
