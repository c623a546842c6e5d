"""A corpus pipeline out of five operators: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import shared_table, table
from ledgerloom.llm.decontamination import clean_rows
from ledgerloom.llm.mixing import mixed_rows
from ledgerloom.llm.secrets import redact_column
from ledgerloom.llm.simhash import one_of_each
from ledgerloom.llm.toxicity import fit, score_column


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier scores 0.5 or more. Null and empty texts have the
    score of the bias; without labels nothing is dropped."""
    weights = fit(docs, table(spark, sf_dir, "labels"))
    row = docs.select(F.struct("*").alias("row"))
    scored = row.withColumn("score", score_column(spark, F.col("row.text"), weights))
    return scored.where("score < 0.5").select("row.*")


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates. Texts without
    words are one group; rows with a null id stay only if no other one is in their group."""
    return one_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that overlap a benchmark item; null and empty texts overlap none."""
    return clean_rows(docs, table(spark, sf_dir, "benchmark"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each secret by a mark and sets n_chars anew where there was one; every document
    stays, and one without secrets, or with a null text, stays as it was."""
    row = docs.select(F.struct("*").alias("row"))
    row = row.withColumn("clean", redact_column(F.col("row.text")))
    changed = ~F.col("row.text").eqNullSafe(F.col("clean"))
    new = F.when(changed, F.col("row").withField("text", F.col("clean"))).otherwise(F.col("row"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        size = F.length("clean").cast(kind)
        with_size = F.col("row").withField("text", F.col("clean")).withField("n_chars", size)
        new = F.when(changed, with_size).otherwise(F.col("row"))
    return row.select(new.alias("row")).select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words from, with size, source_size, target and taken (in
    place of columns of those names). Sources weigh 5, 2, 1, repeating, the null source last."""
    given = ["size", "source_size", "target", "taken"]
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in given]
    return mixed_rows(docs).select(*kept, *(f"mix.{c}" for c in given))


#: Name and function of each stage, in order.
STAGES = [
    ("toxicity", not_toxic),
    ("simhash_near_dedup", no_near_duplicates),
    ("decontamination", no_benchmark),
    ("secret_scan", no_secrets),
    ("mixing", mixed),
]

#: Hashes, a learned classifier and compressed sizes decide; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet to the shared folder and read
    again as the next stage's documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
