"""Bag union of amounts with one marker row per listed key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_markers(amounts: DataFrame, listed: DataFrame, key: str, amount: str) -> DataFrame:
    """Rows of ``amounts`` plus an amount of 1 for every row of ``listed``; duplicates stay."""
    kind = amounts.schema[amount].dataType
    markers = listed.select(key, F.lit(1).cast(kind).alias(amount))
    return amounts.select(key, amount).unionByName(markers)
