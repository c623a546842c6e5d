"""Value received by flagged addresses, by category, id and month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.labels import MONTH_SHORT_YEAR, month_start, start_label
from ledgerloom.operators.buckets import Rows, each
from ledgerloom.operators.grouping import group_sum
from ledgerloom.operators.joins import matched_totals
from ledgerloom.operators.ordering import by_key, top_k
from ledgerloom.sources.tables import SCAMS, TRANSACTIONS, pick

# The categories that have a monthly series, in their exact spelling.
SERIES_CATEGORIES = ("Scamming", "Phishing", "Fake ICO")


def _received(transactions: Rows, monthly: bool) -> Rows:
    # Fields that are only checked: a line with a malformed one takes no part.
    if not monthly:
        return pick(transactions, TRANSACTIONS, "address", "value", checked=["gas_used", "ts"])
    rows = pick(transactions, TRANSACTIONS, "address", "value", "ts", checked=["gas_used"])
    start = month_start(F.col("ts")).alias("start")
    return each(rows, lambda r: r.select("address", "value", start))


def scam_totals(
    transactions: Rows,
    scams: DataFrame,
    by: Sequence[str] = ("month", "category", "id"),
    category: str | None = None,
) -> DataFrame:
    """``total`` received per combination of ``by`` (any of month, category, id).

    The finest combination rolls up to every other, so a run with several reports can share it.
    """
    listed = pick(scams, SCAMS, "id", "category", "address")
    if category is not None:
        listed = listed.where(F.col("category") == category)
    monthly = ["start"] if "month" in by else []
    flagged = [c for c in by if c != "month"]
    rows = _received(transactions, bool(monthly))
    totals = matched_totals(rows, listed, "address", "value", monthly, flagged).drop("n")
    if not monthly:
        return totals
    month = start_label(F.col("start"), MONTH_SHORT_YEAR).alias("month")
    return group_sum(totals, [month, *flagged], "total")


def top_scam_categories(transactions: Rows, scams: DataFrame, k: int = 3) -> DataFrame:
    """The k categories that received most: ``category``, ``total``."""
    return top_k(scam_totals(transactions, scams, ["category"]), "total", "category", k)


def top_scam_ids(transactions: Rows, scams: DataFrame, k: int = 10) -> DataFrame:
    """The k scam ids that received most: ``id``, ``total``."""
    return top_k(scam_totals(transactions, scams, ["id"]), "total", "id", k)


def scam_series(transactions: Rows, scams: DataFrame, category: str) -> DataFrame:
    """``month`` (MM yy), ``total`` of one category, in label order."""
    return by_key(scam_totals(transactions, scams, ["month"], category), "month")


def roll_up(totals: DataFrame, key: str, category: str | None = None) -> DataFrame:
    """Totals per ``key`` out of finer ``scam_totals``."""
    if category is not None:
        totals = totals.where(F.col("category") == category)
    return group_sum(totals, [key], "total")
