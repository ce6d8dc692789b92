"""Corpus pipeline: documents that are good, single, unseen by benchmarks and private, packed.

Every stage works on all rows that its predecessor kept. All but the last return the
columns of ``documents``. Null ids, texts and other columns pass as the operators define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from touchline.llm import decontaminate, packing, pii, quality, simhash
from touchline.llm.common import table
from touchline.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from the labelled ones among them, accepts."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def single_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints (four-word shingles) link at 4 bits or fewer: the one with the smallest id."""
    return simhash.one_of_each(docs, radius=4, shingle=4)


def unseen_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def private_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data."""
    return pii.without_pii(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, with its place in a training sequence."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality_classifier", good_documents),
    ("simhash_near_dedup", single_documents),
    ("decontamination", unseen_documents),
    ("pii", private_documents),
    ("packing", packed_sequences),
]

#: The stages learn, hash and tokenise in ways that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last keeps is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
