"""The saved reports of a run.

Reports that read the same rows share one aggregate: the three monthly reports come out of one
scan of the transactions, the five scam reports out of one scan and join. From text, where a scan
and its parsing cost most, reports of several such groups all come out of one scan, by sums per
address and month; a typed copy is scanned for each group, which reads only its own columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.buckets import BucketedRows
from ledgerloom.operators.ordering import by_key, top_k
from ledgerloom.plans.blocks import top_miners_by_size
from ledgerloom.plans.contracts import monthly_avg_contract_gas, top_addresses_by_value
from ledgerloom.plans.monthly import monthly_summary, monthly_totals
from ledgerloom.plans.scams import SERIES_CATEGORIES, roll_up, scam_totals
from ledgerloom.plans.sums import (
    addresses_from_sums, contract_gas_from_sums, known_month, ledger_sums, monthly_from_sums, scams_from_sums,
)
from ledgerloom.sources.lines import LINE
from ledgerloom.sources.results import write_result
from ledgerloom.sources.tables import BEYOND, TRANSACTIONS, parse

Inputs = dict[str, "DataFrame | BucketedRows"]


def _monthly_base(inputs: Inputs, wanted: Sequence[str]) -> DataFrame:
    """Sums of the amounts that the asked reports use, and of no others."""
    transactions = inputs["transactions"]
    amounts = [a for a in ("value", "gas_price") if f"monthly_avg_{a}" in wanted]
    if isinstance(transactions, BucketedRows) or BEYOND in transactions.columns:
        return monthly_from_sums(ledger_sums(transactions, amounts, ["start"]))
    if transactions.columns == [LINE]:
        transactions = parse(transactions, TRANSACTIONS, [*amounts, "ts"])
    return monthly_totals(transactions, amounts)


def _gas_base(inputs: Inputs, wanted: Sequence[str]) -> DataFrame:
    return monthly_avg_contract_gas(inputs["transactions"], inputs["contracts"])


def _scam_base(inputs: Inputs, wanted: Sequence[str]) -> DataFrame:
    return scam_totals(inputs["transactions"], inputs["scams"])


def _addresses(inputs: Inputs, wanted: Sequence[str]) -> DataFrame:
    return top_addresses_by_value(inputs["transactions"], inputs["contracts"])


def _miners(inputs: Inputs, wanted: Sequence[str]) -> DataFrame:
    return top_miners_by_size(inputs["blocks"])


def _series(category: str) -> Callable[[DataFrame], DataFrame]:
    def step(base: DataFrame) -> DataFrame:
        months = roll_up(base, "month", category).withColumn("month", known_month(F.col("month")))
        return by_key(months, "month")

    return step


Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Group:
    """Reports that come out of one aggregate, and the tables it reads."""

    tables: tuple[str, ...]
    base: Callable[[Inputs, Sequence[str]], DataFrame]
    steps: dict[str, Step]
    from_sums: Callable[[Inputs, DataFrame], DataFrame] | None = None
    measures: tuple[str, ...] = ()


GROUPS = [
    Group(
        ("transactions",),
        _monthly_base,
        {
            "monthly_count": lambda base: by_key(monthly_summary(base).count, "month"),
            "monthly_avg_value": lambda base: by_key(monthly_summary(base).avg_value, "month"),
            "monthly_avg_gas_price": lambda base: by_key(
                monthly_summary(base).avg_gas_price, "month"
            ),
        },
        lambda inputs, sums: monthly_from_sums(sums),
        ("value", "gas_price"),
    ),
    Group(
        ("transactions", "contracts"),
        _gas_base,
        {
            "monthly_avg_contract_gas": lambda base: by_key(base, "month"),
            "top_gas_months": lambda base: top_k(base, "avg_gas", "month", 10),
        },
        lambda inputs, sums: contract_gas_from_sums(sums, inputs["contracts"]),
        ("gas_used",),
    ),
    Group(
        ("transactions", "scams"),
        _scam_base,
        {
            "top_scam_categories": lambda base: top_k(
                roll_up(base, "category"), "total", "category", 3
            ),
            "top_scam_ids": lambda base: top_k(roll_up(base, "id"), "total", "id", 10),
            **{
                "scam_series_" + category.lower().replace(" ", "_"): _series(category)
                for category in SERIES_CATEGORIES
            },
        },
        lambda inputs, sums: scams_from_sums(sums, inputs["scams"]),
        ("received",),
    ),
    Group(
        ("transactions", "contracts"),
        _addresses,
        {"top_addresses_by_value": lambda base: base},
        lambda inputs, sums: addresses_from_sums(sums, inputs["contracts"]),
        ("placed",),
    ),
    Group(("blocks",), _miners, {"top_miners_by_size": lambda base: base}),
]

NAMES = [name for group in GROUPS for name in group.steps]


def tables_of(names: Iterable[str] = ()) -> set[str]:
    """Tables the named reports (all by default) read."""
    chosen = list(names) or NAMES
    unknown = [name for name in chosen if name not in NAMES]
    if unknown:
        raise ValueError(f"unknown reports: {', '.join(unknown)}")
    return {t for g in GROUPS if any(name in chosen for name in g.steps) for t in g.tables}


SUMS = "sums"


def _shared_sums(inputs: Inputs, chosen: Sequence[str]) -> DataFrame | None:
    """The sums that the groups of the chosen reports share: given ones, or those of one scan of text
    where at least two groups read the transactions."""
    if SUMS in inputs:
        return inputs[SUMS]
    groups = [g for g in GROUPS if g.from_sums and any(name in chosen for name in g.steps)]
    transactions = inputs.get("transactions")
    if len(groups) < 2 or isinstance(transactions, BucketedRows) or transactions.columns != [LINE]:
        return None
    unused = {f"monthly_avg_{m}": m for m in ("value", "gas_price") if f"monthly_avg_{m}" not in chosen}
    measures = [m for g in groups for m in g.measures if m not in unused.values()]
    return ledger_sums(transactions, measures)


def write_reports(
    inputs: Inputs, out: str, names: Iterable[str] = (), now: datetime | None = None
) -> dict[str, str]:
    """Writes the named reports (all by default) under ``out``; returns name -> directory.

    ``inputs`` maps table names to raw lines or typed tables; ``sums`` (of ``load_sums``) may stand
    in place of the transactions.
    """
    chosen = list(names) or NAMES
    given = set(inputs) | ({"transactions"} if SUMS in inputs else set())
    missing = sorted(tables_of(chosen) - given)
    if missing:
        raise ValueError(f"tables missing: {', '.join(missing)}")
    sums = _shared_sums(inputs, chosen)
    if sums is not None:
        sums = sums.persist()
    written = {}
    for group in GROUPS:
        wanted = [name for name in group.steps if name in chosen]
        if not wanted:
            continue
        summed = sums is not None and group.from_sums is not None
        base = group.from_sums(inputs, sums) if summed else group.base(inputs, wanted)
        # One row per month, or per month and flagged id; recomputed if an executor is lost.
        shared = len(wanted) > 1
        if shared:
            base = base.persist()
        for name in wanted:
            written[name] = write_result(group.steps[name](base), out, name, now=now)
        if shared:
            base.unpersist()
    if sums is not None:
        sums.unpersist()
    return written
