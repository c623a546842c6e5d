"""Monthly counts and averages over all transactions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.integers import INTEGER
from ledgerloom.functions.labels import (
    MONTH_SLASH_YEAR,
    MONTH_YEAR,
    month_start,
    ratio,
    start_label,
)
from ledgerloom.operators.buckets import Rows, all_rows
from ledgerloom.operators.grouping import group_count, known_sum, whole_sum
from ledgerloom.sources.tables import TRANSACTIONS, pick


def _start():
    return month_start(F.col("ts")).alias("start")


def _month(pattern: str):
    return start_label(F.col("start"), pattern).alias("month")


def _average(rows: DataFrame, amount: str, parts: bool) -> DataFrame:
    """Sums per month of the calendar, then per label: rows are grouped by a date, and only the few
    groups get a label (labels of different years can coincide before year 1)."""
    sums = rows.groupBy(_start()).agg(F.sum(F.col(amount).cast(INTEGER)).alias("total"), F.count("*").alias("n"))
    sums = sums.groupBy(_month(MONTH_YEAR)).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    sums = sums.withColumn(f"avg_{amount}", ratio(F.col("total"), F.col("n")))
    return sums if parts else sums.drop("total", "n")


def monthly_count(transactions: Rows) -> DataFrame:
    """``month`` (MM/yyyy), ``n``."""
    counts = group_count(all_rows(pick(transactions, TRANSACTIONS, "ts")), [_start()])
    return counts.groupBy(_month(MONTH_SLASH_YEAR)).agg(F.sum("n").alias("n"))


def monthly_avg_value(transactions: Rows, parts: bool = False) -> DataFrame:
    """``month`` (MM yyyy), ``avg_value``; ``parts`` adds the exact ``total`` and ``n``."""
    return _average(all_rows(pick(transactions, TRANSACTIONS, "value", "ts")), "value", parts)


def monthly_avg_gas_price(transactions: Rows, parts: bool = False) -> DataFrame:
    """``month`` (MM yyyy), ``avg_gas_price``; ``parts`` adds the exact ``total`` and ``n``."""
    return _average(all_rows(pick(transactions, TRANSACTIONS, "gas_price", "ts")), "gas_price", parts)


@dataclass(frozen=True)
class MonthlySummary:
    count: DataFrame
    avg_value: DataFrame | None
    avg_gas_price: DataFrame | None


def monthly_totals(
    transactions: DataFrame, amounts: Sequence[str] = ("value", "gas_price")
) -> DataFrame:
    """Sums of the ``amounts`` and counts behind the three monthly reports, from one scan.

    A malformed value or price is NULL in ``transactions`` and is skipped by its own sum and
    count only, which is what dropping the line does in the single reports. A sum beyond 38 digits
    is NULL here and raises in the report that uses it, not in the others.
    """
    rows = transactions.where(F.col("ts").isNotNull()).groupBy(_start())
    sums = rows.agg(
        F.count("*").alias("n"),
        *(F.try_sum(a).alias(a) for a in amounts),
        *(F.count(a).alias(f"n_{a}") for a in amounts),
    )
    return sums.groupBy(_month(MONTH_YEAR)).agg(
        F.sum("n").alias("n"),
        *(whole_sum(a, F.col(f"n_{a}") > 0).alias(a) for a in amounts),
        *(F.sum(f"n_{a}").alias(f"n_{a}") for a in amounts),
    )


def monthly_summary(totals: DataFrame) -> MonthlySummary:
    """The three monthly reports out of ``monthly_totals``; those whose sums it lacks are None."""

    def average(amount: str) -> DataFrame | None:
        if amount not in totals.columns:
            return None
        some = totals.where(F.col(f"n_{amount}") > 0)
        total = known_sum(F.col(amount))
        return some.select("month", ratio(total, F.col(f"n_{amount}")).alias(f"avg_{amount}"))

    slashed = F.translate("month", " ", "/").alias("month")
    return MonthlySummary(
        totals.select(slashed, "n"), average("value"), average("gas_price")
    )
