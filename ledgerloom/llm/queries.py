"""Registered queries of the subpackage; each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import pii
from ledgerloom.llm.common import table
from ledgerloom.llm.decontamination import decontaminate
from ledgerloom.llm.filter_audit import filter_audit
from ledgerloom.llm.interpolation import score_texts
from ledgerloom.llm.kmeans import clusters
from ledgerloom.llm.mixing import mix
from ledgerloom.llm.secrets import find_secrets
from ledgerloom.llm.shingle_join import similar_documents
from ledgerloom.llm.simhash import near_duplicates
from ledgerloom.llm.substrings import repeated_passages
from ledgerloom.llm.tokens import count_tokens
from ledgerloom.llm.topk import top_k
from ledgerloom.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return find_secrets(table(spark, sf, "documents"))


def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_tokens(table(spark, sf, "documents"))


def op3_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_passages(table(spark, sf, "documents"))


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op5_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf, "documents")))


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op7_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mix(table(spark, sf, "documents"))


def op8_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return score_texts(table(spark, sf, "documents"))


def op9_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(table(spark, sf, "embeddings"))


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))


def op11_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return similar_documents(table(spark, sf, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf: str) -> DataFrame:
    return clusters(table(spark, sf, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


def queries() -> dict[str, Query]:
    own = (
        op1_secret_scan, op2_token_counts, op3_substring_dedup, op4_toxicity, op5_pii,
        op6_decontamination, op7_source_mixing, op8_lm_scoring, op9_top_k, op10_simhash,
        op11_ngram_jaccard, op12_centroid_clustering, op13_filter_audit,
    )
    return {query.__name__: query for query in own}
