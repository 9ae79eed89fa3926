"""Corpus pipeline: documents -> packed training sequences.

Each stage calls one operator of ``tidemark.llm``, gets all that the stage before it
kept (written as Parquet and read again) and returns the columns of ``documents``;
the last one returns the packed pieces.

1. toxicity: documents that score ``toxicity.REJECT`` or more go
2. exact dedup: of equal texts the row with the largest doc_id stays
3. SimHash near-dedup: of each component the row with the smallest doc_id stays
4. secret scan: found secrets are masked in the text, n_chars follows
5. packing: pieces of at most 2048 tokens and their places in the sequences
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, packing, secret_scan, simhash, toxicity
from tidemark.llm.common import stored, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.training_model(spark, docs, sf_dir)
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(spark, docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(spark, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs)


STAGES = [("toxicity", reject_toxic), ("exact_dedup", drop_copies), ("simhash", drop_near_copies),
          ("secret_scan", mask_secrets), ("packing", pack_sequences)]

#: the classifier, the fingerprints and the packing are beyond SQL; tests/llm tests the operators one by one, not run()
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
