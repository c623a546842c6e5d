"""Miners by total block size."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom.operators.grouping import group_sum
from ledgerloom.operators.ordering import top_k
from ledgerloom.sources.tables import BLOCKS, pick


def top_miners_by_size(blocks: DataFrame, k: int = 10) -> DataFrame:
    """The k miners with the largest ``total_size``."""
    sizes = group_sum(pick(blocks, BLOCKS, "miner", "size"), ["miner"], "size", "total_size")
    return top_k(sizes, "total_size", "miner", k)
