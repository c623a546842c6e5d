"""Orders and limits. Ties go to the smaller key, so every result is deterministic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_key(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(F.asc(key))


def by_amount(df: DataFrame, amount: str, key: str) -> DataFrame:
    return df.orderBy(F.desc(amount), F.asc(key))


def top_k(df: DataFrame, amount: str, key: str, k: int) -> DataFrame:
    """The k largest amounts; a per-task heap merged once, without a global sort."""
    return by_amount(df, amount, key).limit(k)


def bounded(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first n rows by key."""
    return by_key(df, key).limit(n)
