"""Rows that are stored in buckets of a key, with the keys too large for a bucket kept apart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class BucketedRows:
    """Rows in buckets of ``key``, the rows of hot keys, and those keys, each once.

    There are fewer hot keys than buckets, so a list of them is small whatever the data.
    """

    key: str
    buckets: DataFrame
    hot: DataFrame
    hot_keys: DataFrame

    def each(self, change: Callable[[DataFrame], DataFrame]) -> BucketedRows:
        """Both kinds of rows changed alike; ``change`` must keep the key and move no row."""
        return BucketedRows(self.key, change(self.buckets), change(self.hot), self.hot_keys)

    def all(self) -> DataFrame:
        return self.buckets.unionByName(self.hot)


Rows = "DataFrame | BucketedRows"


def each(rows: Rows, change: Callable[[DataFrame], DataFrame]) -> Rows:
    return rows.each(change) if isinstance(rows, BucketedRows) else change(rows)


def all_rows(rows: Rows) -> DataFrame:
    """The rows as one frame, for what asks for no key."""
    return rows.all() if isinstance(rows, BucketedRows) else rows
