"""Gas used on contract addresses, and the addresses that received most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.labels import MONTH_SHORT_YEAR, month_start, ratio, start_label
from ledgerloom.operators.buckets import Rows, all_rows, each
from ledgerloom.operators.grouping import group_sum
from ledgerloom.operators.joins import matched_totals, only_listed
from ledgerloom.operators.ordering import top_k
from ledgerloom.operators.unions import add_markers
from ledgerloom.sources.tables import CONTRACTS, TRANSACTIONS, pick


def monthly_avg_contract_gas(transactions: Rows, contracts: DataFrame) -> DataFrame:
    """``month`` (MM yy), ``avg_gas`` over the join of transactions with contracts; a contract
    listed twice counts twice."""
    start = month_start(F.col("ts")).alias("start")
    rows = pick(transactions, TRANSACTIONS, "address", "gas_used", "ts")
    rows = each(rows, lambda r: r.select("address", "gas_used", start))
    listed = pick(contracts, CONTRACTS, "address")
    totals = matched_totals(rows, listed, "address", "gas_used", fact_keys=["start"])
    # Two-digit years: months of different centuries have one label.
    month = start_label(F.col("start"), MONTH_SHORT_YEAR).alias("month")
    totals = totals.groupBy(month).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return totals.select("month", ratio(F.col("total"), F.col("n")).alias("avg_gas"))


def top_gas_months(transactions: Rows, contracts: DataFrame, k: int = 10) -> DataFrame:
    """The k months with the highest average gas on contracts."""
    return top_k(monthly_avg_contract_gas(transactions, contracts), "avg_gas", "month", k)


def top_addresses_by_value(
    transactions: Rows, contracts: DataFrame, k: int = 10, contracts_only: bool = False
) -> DataFrame:
    """The k addresses with the highest ``total``: received value plus one per contract line.

    All addresses take part; ``contracts_only`` keeps those that are contracts, after the sums,
    when one row per address is left.
    """
    listed = pick(contracts, CONTRACTS, "address")
    values = all_rows(pick(transactions, TRANSACTIONS, "address", "value", checked=["c3"]))
    totals = group_sum(add_markers(values, listed, "address", "value"), ["address"], "value")
    if contracts_only:
        totals = only_listed(totals, listed, "address")
    return top_k(totals, "total", "address", k)
