"""Corpus pipeline: documents pass through five stages, each written as Parquet and read again by the next one.

Quality classifier, exact deduplication, n-gram Jaccard join, benchmark decontamination, BPE. A stage works on all rows
that its predecessor kept and returns the documents' own columns; the last one returns token counts and digests.

Edge cases are those of the operators: null and empty texts stay unless the classifier rejects them or they are
copies (empty texts are copies of each other; they are near duplicates of nothing); repeated rows become one row;
rows with a null id are kept like others; extra columns pass unchanged; empty tables pass empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from leadscope.llm import bpe, decontam, exact, ngram_join, quality
from leadscope.llm.common import table
from leadscope.llm.queries import WORD_BPE, vocabulary
from leadscope.session import ensure_checkpoint_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the smallest id."""
    return exact.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return ngram_join.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage of weight."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of the documents left."""
    return bpe.digests(docs, vocabulary(WORD_BPE))


STAGES = [("quality_classifier", quality_classifier), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("bpe_encoding", bpe_encoding)]

#: Training, components and the vocabulary have no SQL form; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the tables between stages are written to the shared folder."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex[:12]}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
