"""Grouped counts, sums and averages.

Each is one groupBy: Spark pre-aggregates inside every task, so a key that holds a large share of
the rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.integers import INTEGER
from ledgerloom.functions.labels import ratio

Keys = Sequence["str | Column"]


def group_count(df: DataFrame, keys: Keys, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def group_sum(df: DataFrame, keys: Keys, amount: str, name: str = "total") -> DataFrame:
    """Exact integer sum; more than 38 digits raise instead of wrapping."""
    return df.groupBy(*keys).agg(F.sum(F.col(amount).cast(INTEGER)).alias(name))


def known_sum(total: Column) -> Column:
    """A sum by try_sum where it is used: raises where it went beyond 38 digits."""
    beyond = F.raise_error(F.lit("ARITHMETIC_OVERFLOW: a sum exceeds 38 digits"))
    return F.when(total.isNull(), beyond.cast(INTEGER)).otherwise(total)


def whole_sum(total: str, has_rows: Column) -> Column:
    """Sum of sums by try_sum, NULL if one of those with rows is NULL, and never an error."""
    lost = F.max(F.when(has_rows & F.col(total).isNull(), 1))
    return F.when(lost.isNull(), F.try_sum(total))


def group_avg(
    df: DataFrame, keys: Keys, amount: str, name: str = "average", parts: bool = False
) -> DataFrame:
    """Average from the exact sum and count of one pass; ``parts`` keeps both beside it."""
    sums = df.groupBy(*keys).agg(
        F.sum(F.col(amount).cast(INTEGER)).alias("total"), F.count("*").alias("n")
    )
    averaged = sums.withColumn(name, ratio(F.col("total"), F.col("n")))
    return averaged if parts else averaged.drop("total", "n")
