"""The operators as queries over the tables of a folder: ``queries()`` and ``oracle_sql()``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, collocations, decontam, exact, html_extract, langid, linededup, ngram_join, quality, sharding, substring, tokencount,
               vectorcode)
from .common import table
from .oracle import ORACLE

#: Vocabulary files; a parameter, as they stay outside of the repository.
WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.scored(documents, quality.fit(documents, table(spark, sf_dir, "labels")))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(table(spark, sf_dir, "documents")).drop("row")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return langid.predicted(documents, langid.fit(documents))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(table(spark, sf_dir, "pages"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removed(table(spark, sf_dir, "documents")).drop("kept_text")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents")).drop("th")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.counted(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE))


def op11_vector_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcode.coded(table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digests(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_quality_classifier, op2_sharding, op3_exact_dedup, op4_decontamination, op5_language_id, op6_html_extraction,
             op7_bpe, op8_substring_dedup, op9_ngram_jaccard_join, op10_token_counts, op11_vector_code, op12_line_dedup, op13_collocations, pipeline)
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
