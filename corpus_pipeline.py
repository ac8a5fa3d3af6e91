"""Cleaning a corpus in stages: each is written as Parquet and read again as the next one's documents.

Every stage takes (spark, docs, sf_dir), works on all rows that the one before it kept, and leaves the columns of
documents; the last one gives token ids. Stages that drop documents keep the rest unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm import bpe_tree, decontaminate, disclosure, fertility, jaccard
from kinfold.llm.shared import batches_of_bytes, cut_lineage, documents, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    batches_of_bytes(spark)
    return fertility.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least doc_id, once; documents without id or words stay."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any test phrase of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, entities replaced by their kind and terms that disclose them generalised or removed."""
    return disclosure.sanitise(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and what they decode to, of every document."""
    # Written in between: a task of both would keep two Python workers with a vocabulary each.
    decoded = bpe_tree.decode(cut_lineage(bpe_tree.encode(docs)))
    return decoded.select("doc_id", "n_tokens", "ids", F.decode("decoded", "UTF-8").alias("text"))


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontamination),
          ("PII", personal_data), ("byte-level BPE encoding and decoding", encoding)]

# Tokenisers and set similarity take part; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
