"""Relational building blocks; columns are passed by name."""

from ledgerloom.operators.grouping import group_avg, group_count, group_sum
from ledgerloom.operators.joins import list_size, matched_totals, only_listed, ratio_join
from ledgerloom.operators.ordering import bounded, by_amount, by_key, top_k
from ledgerloom.operators.unions import add_markers

__all__ = [
    "add_markers",
    "bounded",
    "by_amount",
    "by_key",
    "group_avg",
    "group_count",
    "group_sum",
    "list_size",
    "matched_totals",
    "only_listed",
    "ratio_join",
    "top_k",
]
