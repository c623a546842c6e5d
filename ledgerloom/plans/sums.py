"""Sums per address and month: one scan of the transactions, out of which every report can be made.

Sums and counts of two exports add up to those of both, so they can be saved for each export and
merged; a new export costs its own scan only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.labels import MONTH_SHORT_YEAR, MONTH_YEAR, SECONDS_PER_DAY, month_start, ratio, start_label
from ledgerloom.operators.buckets import Rows
from ledgerloom.operators.grouping import group_sum, known_sum, whole_sum
from ledgerloom.operators.joins import matched_sums
from ledgerloom.operators.ordering import top_k
from ledgerloom.operators.unions import add_markers
from ledgerloom.sources.tables import CONTRACTS, SCAMS, TRANSACTIONS, flagged, pick

#: Measure: the amount that is summed, and the other fields that must be integers.
MEASURES = {
    "value": ("value", ["ts"]),
    "gas_price": ("gas_price", ["ts"]),
    "gas_used": ("gas_used", ["ts"]),
    "received": ("value", ["gas_used", "ts"]),
    "placed": ("value", ["c3"]),
}
KEYS = ["address", "start"]
# Days that a date can hold.
FIRST_DAY, LAST_DAY = -(2**31) + 31, 2**31 - 32


def _form(*columns: str):
    return reduce(lambda a, b: a & b, [F.col(f"{c}_form") for c in columns])


def ledger_sums(
    transactions: Rows, measures: Sequence[str] = tuple(MEASURES), keys: Sequence[str] = KEYS
) -> DataFrame:
    """``address``, ``start`` (first day of the month), ``n`` (lines with a valid time) and, for each
    measure, its sum and ``n_<measure>``, the lines in it.

    A line takes part in a measure as it does in the report of that amount. ``start`` is NULL for lines
    without a valid time (which only ``placed`` has) and for times that a date cannot hold. A sum that
    exceeds 38 digits, or has an amount that does, is NULL beside a count that is not 0; it raises
    in the reports that use it and in no other. A third of all lines with one address is a row per
    month and task at the shuffle. ``keys`` may leave out the address.
    """
    needed = {"ts"}.union(*({MEASURES[m][0], *MEASURES[m][1]} for m in measures))
    columns = [c for c in TRANSACTIONS.columns if c in needed or c in keys]
    rows = flagged(transactions, TRANSACTIONS, columns)
    day = F.floor(F.col("ts") / SECONDS_PER_DAY)
    start = F.when(day.between(FIRST_DAY, LAST_DAY), month_start(F.col("ts")))
    sums = [F.count_if(_form("ts")).alias("n")]
    for name in measures:
        amount, others = MEASURES[name]
        taken = _form(amount, *others)
        lost = F.count_if(taken & F.col(amount).isNull())
        sums.append(F.when(lost == 0, F.try_sum(F.when(taken, F.col(amount)))).alias(name))
        sums.append(F.count_if(taken).alias(f"n_{name}"))
    return rows.withColumn("start", start).groupBy(*keys).agg(*sums)


def _measures(sums: DataFrame) -> list[str]:
    return [m for m in MEASURES if m in sums.columns]


def rolled(sums: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sums of sums per ``keys``."""
    return sums.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        *(whole_sum(m, F.col(f"n_{m}") > 0).alias(m) for m in measures),
        *(F.sum(f"n_{m}").alias(f"n_{m}") for m in measures),
    )


def merged_sums(parts: DataFrame) -> DataFrame:
    """One row per address and month out of the sums of several exports, all in one frame."""
    return rolled(parts, KEYS, _measures(parts))


def save_sums(transactions: Rows, folder: str, export: str) -> None:
    """All sums of one export, as Parquet beside those of others; a name that is taken raises, so no
    export counts twice."""
    ledger_sums(transactions).write.parquet(f"{folder.rstrip('/')}/export={export}")


def load_sums(spark: SparkSession, folder: str) -> DataFrame:
    """The sums over all exports that were saved in ``folder``."""
    return merged_sums(spark.read.parquet(folder))


def known_month(month: Column) -> Column:
    """The month, and an error where the seconds were too many for one."""
    beyond = F.raise_error(F.lit("NUMERIC_VALUE_OUT_OF_RANGE: a date cannot hold the seconds of a line"))
    return F.when(month.isNull(), beyond.cast("string")).otherwise(month)


def monthly_from_sums(sums: DataFrame) -> DataFrame:
    """What ``monthly_totals`` gives: the monthly reports come out of it by ``monthly_summary``."""
    measures = [m for m in ("value", "gas_price") if m in sums.columns]
    months = rolled(sums.where("n > 0"), ["start"], measures)
    month = known_month(start_label(F.col("start"), MONTH_YEAR)).alias("month")
    return rolled(months, [month], measures)


def contract_gas_from_sums(sums: DataFrame, contracts: DataFrame) -> DataFrame:
    """``monthly_avg_contract_gas``."""
    listed = pick(contracts, CONTRACTS, "address")
    rows = sums.where("n_gas_used > 0")
    totals = matched_sums(rows, listed, "address", "gas_used", "n_gas_used", ["start"])
    month = known_month(start_label(F.col("start"), MONTH_SHORT_YEAR)).alias("month")
    totals = totals.groupBy(month).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return totals.select("month", ratio(F.col("total"), F.col("n")).alias("avg_gas"))


def scams_from_sums(sums: DataFrame, scams: DataFrame) -> DataFrame:
    """``scam_totals`` by month, category and id; a month is NULL where a date can't hold it."""
    listed = pick(scams, SCAMS, "id", "category", "address")
    rows = sums.where("n_received > 0")
    totals = matched_sums(
        rows, listed, "address", "received", "n_received", ["start"], ["category", "id"]
    )
    month = start_label(F.col("start"), MONTH_SHORT_YEAR).alias("month")
    return group_sum(totals, [month, "category", "id"], "total")


def addresses_from_sums(sums: DataFrame, contracts: DataFrame, k: int = 10) -> DataFrame:
    """``top_addresses_by_value``."""
    rows = sums.where("n_placed > 0").select("address", known_sum(F.col("placed")).alias("value"))
    marked = add_markers(rows, pick(contracts, CONTRACTS, "address"), "address", "value")
    return top_k(group_sum(marked, ["address"], "value"), "total", "address", k)
