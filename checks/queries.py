"""Registered queries: each reads whole driver tables through the ledger exports, or directly."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.exports import EXPORTS, long_transactions
from checks.scratch import scratch
from ledgerloom import operators as ops
from ledgerloom import plans
from ledgerloom.functions import month_label, ratio, relabel, to_integer
from ledgerloom.functions.labels import (
    MONTH_SHORT_YEAR,
    MONTH_SLASH_YEAR,
    MONTH_YEAR,
    month_start,
    start_label,
)
from ledgerloom.operators.buckets import each
from ledgerloom.plans.monthly import monthly_summary, monthly_totals
from ledgerloom.plans.scams import roll_up, scam_totals
from ledgerloom.plans.sums import (
    MEASURES,
    addresses_from_sums,
    contract_gas_from_sums,
    ledger_sums,
    load_sums,
    monthly_from_sums,
    save_sums,
    scams_from_sums,
)
from ledgerloom.sources import (
    BLOCKS,
    CONTRACTS,
    SCAMS,
    TRANSACTIONS,
    load_bucketed,
    load_table,
    parse,
    pick,
    read_lines,
    read_pairs,
    save_bucketed,
    save_table,
    valid_lines,
    write_result,
)
from ledgerloom.sources.lines import ARITY, field, fields
from ledgerloom.sources.tables import BEYOND

Query = Callable[[SparkSession, str], DataFrame]


def _lines(name: str) -> Query:
    return EXPORTS[name]


tx, ct, sc, bl = (_lines(n) for n in ("transactions", "contracts", "scams", "blocks"))


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _as_bigint(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("bigint") for name in names})


def _as_int(df: DataFrame, name: str = "id") -> DataFrame:
    return df.withColumn(name, F.col(name).cast("int"))


def _total(df: DataFrame) -> DataFrame:
    return _as_bigint(df, "total")


def _cents(name: str):
    return F.round(F.col(name) * 100).cast("bigint")


def _epoch(name: str):
    """Seconds of a zone-less timestamp, whatever the session zone."""
    stamp = F.col(name)
    day = F.unix_date(stamp.cast("date")).cast("bigint")
    return day * 86400 + F.hour(stamp) * 3600 + F.minute(stamp) * 60 + F.second(stamp)


# --- end queries -----------------------------------------------------------------------------


def _series(category: str) -> Query:
    return lambda s, d: _total(plans.scam_series(tx(s, d), sc(s, d), category))


def _saved(spark: SparkSession, df: DataFrame, name: str) -> str:
    return write_result(df, scratch(spark), name)


def _sorted_average(spark: SparkSession, sf: str) -> DataFrame:
    averages = plans.monthly_avg_value(tx(spark, sf))
    return plans.sorted_series(read_pairs(spark, _saved(spark, averages, "average")))


def _sorted_count(spark: SparkSession, sf: str) -> DataFrame:
    counts = plans.monthly_count(tx(spark, sf))
    return plans.sorted_series(read_pairs(spark, _saved(spark, counts, "count")), commas=True)


QUERIES: dict[str, Query] = {
    "monthly_count": lambda s, d: plans.monthly_count(tx(s, d)),
    "monthly_avg_value": lambda s, d: plans.monthly_avg_value(tx(s, d)),
    "monthly_avg_gas_price": lambda s, d: plans.monthly_avg_gas_price(tx(s, d)),
    "monthly_avg_contract_gas": lambda s, d: plans.monthly_avg_contract_gas(tx(s, d), ct(s, d)),
    "top_gas_months": lambda s, d: plans.top_gas_months(tx(s, d), ct(s, d)),
    "top_addresses_by_value": lambda s, d: _total(
        plans.top_addresses_by_value(tx(s, d), ct(s, d))
    ),
    "top_contracts_by_value": lambda s, d: _total(
        plans.top_addresses_by_value(tx(s, d), ct(s, d), contracts_only=True)
    ),
    "top_miners_by_size": lambda s, d: _as_bigint(plans.top_miners_by_size(bl(s, d)), "total_size"),
    "top_scam_categories": lambda s, d: _total(plans.top_scam_categories(tx(s, d), sc(s, d))),
    "top_scam_ids": lambda s, d: _as_int(_total(plans.top_scam_ids(tx(s, d), sc(s, d)))),
    "scam_series_scamming": _series("Scamming"),
    "scam_series_phishing": _series("Phishing"),
    "scam_series_fake_ico": _series("Fake ICO"),
    "sorted_series_average": _sorted_average,
    "sorted_series_count": _sorted_count,
}

# --- sources and sinks -----------------------------------------------------------------------


def _read_back(name: str) -> Query:
    """Writes an export as text files, reads it and counts lines by number of fields."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = scratch(spark)
        EXPORTS[name](spark, sf).write.text(path)
        return ops.group_count(fields(read_lines(spark, path), {}), [ARITY])

    return run


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    save_table(tx(spark, sf), TRANSACTIONS, path)
    return load_table(spark, TRANSACTIONS, path)


def _typed_counts(spark: SparkSession, sf: str) -> DataFrame:
    integers = [c for c in TRANSACTIONS.columns if c != "address"]
    return _typed(spark, sf).groupBy("address").agg(
        F.count("*").alias("lines"), *[F.count(c).alias(c) for c in integers]
    )


def _saved_price(spark: SparkSession, sf: str) -> DataFrame:
    averages = plans.monthly_avg_gas_price(tx(spark, sf))
    return read_pairs(spark, _saved(spark, averages, "price"))


def _saved_miners(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    top = plans.top_miners_by_size(bl(spark, sf), 100)
    return read_pairs(spark, _saved(spark, top, "miners"), kind)


def _saved_customers(spark: SparkSession, sf: str) -> DataFrame:
    """A result of one row per customer, all of them written and read back."""
    orders = _table(spark, sf, "orders").groupBy(F.col("o_custkey").cast("string").alias("key"))
    return read_pairs(spark, _saved(spark, orders.agg(F.count("*").alias("value")), "orders"), "bigint")


SOURCES: dict[str, Query] = {
    "source_transactions": _read_back("transactions"),
    "source_contracts": _read_back("contracts"),
    "source_scams": _read_back("scams"),
    "source_blocks": _read_back("blocks"),
    "source_typed_transactions": _typed_counts,
    "source_pairs": _saved_price,
    "sink_pairs": lambda s, d: _saved_miners(s, d, "bigint"),
    "sink_all_pairs": _saved_customers,
}

# --- filters ---------------------------------------------------------------------------------


def _kept(*int_fields: int) -> Query:
    """Valid transaction lines counted per address."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        kept = valid_lines(tx(spark, sf), TRANSACTIONS.arity, int_fields)
        return ops.group_count(parse(kept, TRANSACTIONS, ["address"]), ["address"])

    return run


def _kept_contracts(spark: SparkSession, sf: str) -> DataFrame:
    kept = valid_lines(ct(spark, sf), CONTRACTS.arity)
    return ops.group_count(parse(kept, CONTRACTS, ["address"]), ["address"])


def _kept_scams(spark: SparkSession, sf: str) -> DataFrame:
    kept = valid_lines(sc(spark, sf), SCAMS.arity, [0])
    return _as_int(parse(kept, SCAMS, ["id", "category", "address"]))


def _kept_blocks(spark: SparkSession, sf: str) -> DataFrame:
    kept = valid_lines(bl(spark, sf), BLOCKS.arity, [12])
    return _as_bigint(parse(kept, BLOCKS, ["miner", "size"]), "size")


def _by_category(spark: SparkSession, sf: str) -> DataFrame:
    scams = pick(sc(spark, sf), SCAMS, "id", "category", "address")
    return _as_int(scams.where(F.col("category").isin(*plans.SERIES_CATEGORIES)))


FILTERS: dict[str, Query] = {
    "filter_count_form": _kept(11),
    "filter_value_form": _kept(7, 11),
    "filter_gas_price_form": _kept(11, 9),
    "filter_gas_used_form": _kept(11, 8),
    "filter_field_3_form": _kept(3),
    "filter_contracts": _kept_contracts,
    "filter_scams": _kept_scams,
    "filter_blocks": _kept_blocks,
    "filter_category": _by_category,
}

# --- projections -----------------------------------------------------------------------------


def _picked_fields(spark: SparkSession, sf: str) -> DataFrame:
    texts = {"address": field(6), "c3": field(3), "gas_used": field(8)}
    rows = fields(tx(spark, sf), texts)
    return rows.where(F.col(ARITY) == TRANSACTIONS.arity).drop(ARITY)


def _integers(spark: SparkSession, sf: str) -> DataFrame:
    rows = fields(tx(spark, sf), {"address": field(6), "value": to_integer(field(7))})
    valid = rows.where((F.col(ARITY) == TRANSACTIONS.arity) & F.col("value").isNotNull())
    return _as_bigint(valid.drop(ARITY), "value")


def _months(table: str, key: str, stamp: str, pattern: str) -> Query:
    return lambda s, d: _table(s, d, table).select(
        key, month_label(_epoch(stamp), pattern).alias("month")
    )


def _ratios(spark: SparkSession, sf: str) -> DataFrame:
    sums = _table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("total"), F.count("*").alias("n")
    )
    average = ratio(F.col("total"), F.col("n")).alias("average")
    return sums.select("l_returnflag", "l_linestatus", average)


PROJECTIONS: dict[str, Query] = {
    "project_fields": _picked_fields,
    "project_integer": _integers,
    "project_month_year": _months("orders", "o_orderkey", "o_orderdate", MONTH_YEAR),
    "project_month_slash_year": _months("orders", "o_orderkey", "o_orderdate", MONTH_SLASH_YEAR),
    "project_month_short_year": _months("events", "event_id", "ts", MONTH_SHORT_YEAR),
    "project_marker": lambda s, d: pick(ct(s, d), CONTRACTS, "address").withColumn(
        "marker", F.lit(1)
    ),
    "project_rekey": lambda s, d: _as_int(_total(scam_totals(tx(s, d), sc(s, d)))),
    "project_ratio": _ratios,
    "project_relabel": lambda s, d: plans.monthly_count(tx(s, d)).withColumn(
        "month", relabel(F.col("month"))
    ),
    "project_saved_numbers": lambda s, d: _saved_miners(s, d, "double"),
}

# --- joins -----------------------------------------------------------------------------------


def _join_contracts(broadcast_bytes: int | None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _gas_per_month(tx(spark, sf), ct(spark, sf), broadcast_bytes)

    return run


def _gas_per_month(transactions, contracts: DataFrame, broadcast_bytes: int | None) -> DataFrame:
    start = month_start(F.col("ts")).alias("start")
    rows = pick(transactions, TRANSACTIONS, "address", "gas_used", "ts")
    rows = each(rows, lambda r: r.select("address", "gas_used", start))
    listed = pick(contracts, CONTRACTS, "address")
    totals = ops.matched_totals(
        rows, listed, "address", "gas_used", ["start"], broadcast_bytes=broadcast_bytes
    )
    month = start_label(F.col("start"), MONTH_SHORT_YEAR).alias("month")
    totals = totals.groupBy(month).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return _as_bigint(totals, "total", "n")


def _buckets(spark: SparkSession, sf: str):
    path = scratch(spark)
    save_bucketed(_typed(spark, sf), TRANSACTIONS, path, buckets=16)
    return load_bucketed(spark, TRANSACTIONS, path)


def _join_contracts_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    return _gas_per_month(_buckets(spark, sf), ct(spark, sf), 0)


def _join_scams_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    rows = pick(_buckets(spark, sf), TRANSACTIONS, "address", "value", checked=["gas_used", "ts"])
    listed = pick(sc(spark, sf), SCAMS, "id", "category", "address")
    totals = ops.matched_totals(rows, listed, "address", "value", [], ["id", "category"], 0)
    return _as_int(_as_bigint(totals, "total", "n"))


def _join_scams(broadcast_bytes: int | None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = pick(tx(spark, sf), TRANSACTIONS, "address", "value", "gas_used", "ts")
        listed = pick(sc(spark, sf), SCAMS, "id", "category", "address")
        totals = ops.matched_totals(
            rows, listed, "address", "value", [], ["id", "category"], broadcast_bytes
        )
        return _as_int(_as_bigint(totals, "total", "n"))

    return run


def _join_many_labels(broadcast_bytes: int | None) -> Query:
    """Quantities of each supplier, once for every part that lists the supplier: most have many."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        lines = _table(spark, sf, "lineitem")
        rows = lines.select("l_suppkey", F.round("l_quantity").cast("bigint").alias("quantity"))
        listed = lines.select("l_suppkey", "l_partkey")
        totals = ops.matched_totals(
            rows, listed, "l_suppkey", "quantity", [], ["l_partkey"], broadcast_bytes
        )
        return _as_bigint(totals, "total", "n")

    return run


def _join_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of one month each, and the counts they are divided by, out of one parse of the lines."""
    base = monthly_totals(parse(tx(spark, sf), TRANSACTIONS, ["value", "ts"]), ["value"]).persist()
    base = base.where(F.col("n_value") > 0)
    totals = base.select("month", F.col("value").alias("total"))
    return ops.ratio_join(totals, base.select("month", F.col("n_value").alias("n")), "month")


JOINS: dict[str, Query] = {
    "join_contracts": _join_contracts(None),
    "join_contracts_shuffled": _join_contracts(0),
    "join_scams": _join_scams(None),
    "join_scams_shuffled": _join_scams(0),
    "join_many_labels": _join_many_labels(None),
    "join_many_labels_shuffled": _join_many_labels(0),
    "join_counts": _join_counts,
    "join_contracts_bucketed": _join_contracts_bucketed,
    "join_scams_bucketed": _join_scams_bucketed,
}

# --- aggregations ----------------------------------------------------------------------------


def _orders(spark: SparkSession, sf: str, pattern: str) -> DataFrame:
    return _table(spark, sf, "orders").select(
        month_label(_epoch("o_orderdate"), pattern).alias("month"),
        _cents("o_totalprice").alias("price"),
    )


def _address_totals(spark: SparkSession, sf: str) -> DataFrame:
    return _total(ops.group_sum(_marked(spark, sf), ["address"], "value"))


def _marked(spark: SparkSession, sf: str) -> DataFrame:
    values = pick(tx(spark, sf), TRANSACTIONS, "address", "c3", "value")
    return ops.add_markers(values, pick(ct(spark, sf), CONTRACTS, "address"), "address", "value")


def _miner_totals(spark: SparkSession, sf: str) -> DataFrame:
    sizes = pick(bl(spark, sf), BLOCKS, "miner", "size")
    return _total(ops.group_sum(sizes, ["miner"], "size"))


def _long_sums(spark: SparkSession, sf: str) -> DataFrame:
    rows = pick(tx(spark, sf), TRANSACTIONS, "address", "value")
    scaled = rows.withColumn("value", F.col("value") * F.lit(10**16))
    return ops.group_sum(scaled, ["address"], "value").withColumn(
        "total", F.col("total").cast("string")
    )


AGGREGATIONS: dict[str, Query] = {
    "count_per_key": lambda s, d: ops.group_count(_table(s, d, "lineitem"), ["l_partkey"]),
    "count_per_month": lambda s, d: ops.group_count(_orders(s, d, MONTH_SLASH_YEAR), ["month"]),
    "sum_per_month": lambda s, d: _total(
        ops.group_sum(_orders(s, d, MONTH_SHORT_YEAR), ["month"], "price")
    ),
    "average_per_month": lambda s, d: _total(
        ops.group_avg(_orders(s, d, MONTH_YEAR), ["month"], "price", parts=True)
    ),
    "sum_per_address": _address_totals,
    "sum_per_miner": _miner_totals,
    "sum_per_category": lambda s, d: _total(scam_totals(tx(s, d), sc(s, d), ["category"])),
    "sum_per_id": lambda s, d: _as_int(_total(scam_totals(tx(s, d), sc(s, d), ["id"]))),
    "sum_beyond_64_bits": _long_sums,
}

# --- orders, limits, union -------------------------------------------------------------------


def _saved_order_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = ops.group_count(_orders(spark, sf, MONTH_SLASH_YEAR), ["month"])
    path = _saved(spark, counts, "orders")
    return plans.sorted_series(read_pairs(spark, path))


def _part_totals(spark: SparkSession, sf: str) -> DataFrame:
    prices = _table(spark, sf, "lineitem").select(
        "l_partkey", _cents("l_extendedprice").alias("price")
    )
    return ops.group_sum(prices, ["l_partkey"], "price")


def _nation_balances(spark: SparkSession, sf: str) -> DataFrame:
    balances = _table(spark, sf, "customer").select(
        "c_nationkey", _cents("c_acctbal").alias("balance")
    )
    return ops.group_sum(balances, ["c_nationkey"], "balance")


ORDERS: dict[str, Query] = {
    "sort_by_amount": lambda s, d: ops.by_amount(_miner_totals(s, d), "total", "miner"),
    "sort_by_key": lambda s, d: ops.by_key(
        _total(scam_totals(tx(s, d), sc(s, d), ["month"])), "month"
    ),
    "sort_saved_series": _saved_order_counts,
    "top_k_amount": lambda s, d: _total(ops.top_k(_part_totals(s, d), "total", "l_partkey", 10)),
    "first_of_sorted": lambda s, d: ops.by_key(
        ops.group_count(_table(s, d, "orders"), ["o_custkey"]), "o_custkey"
    ).limit(100),
    "bounded_result": lambda s, d: _total(ops.bounded(_nation_balances(s, d), "c_nationkey", 10)),
    "union_markers": lambda s, d: _as_bigint(_marked(s, d), "value"),
}

# --- several reports out of one aggregate ----------------------------------------------------


def _summary(spark: SparkSession, sf: str):
    return monthly_summary(monthly_totals(_typed(spark, sf)))


SHARED: dict[str, Query] = {
    "shared_monthly_count": lambda s, d: _summary(s, d).count,
    "shared_monthly_avg_value": lambda s, d: _summary(s, d).avg_value,
    "shared_monthly_avg_gas_price": lambda s, d: _summary(s, d).avg_gas_price,
    "shared_scam_categories": lambda s, d: _total(
        roll_up(scam_totals(tx(s, d), sc(s, d)), "category")
    ),
}


# --- sums per address and month, whole and merged out of two exports --------------------------


def _sums(spark: SparkSession, sf: str) -> DataFrame:
    return ledger_sums(tx(spark, sf))


def _halves(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Two exports, the lines up to 60 characters and the longer ones.

    Through inline each line is put together once. A filter right above the export would be pushed
    below it, and the line worked out again in it: one method too large for the compiler.
    """
    lines = tx(spark, sf).select(F.inline(F.array(F.struct("line"))))
    short = F.length("line") <= 60
    return {"short": lines.where(short), "long": lines.where(~short)}


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    """Sums of the two exports, saved and merged."""
    path = scratch(spark)
    for name, lines in _halves(spark, sf).items():
        save_sums(lines, path, name)
    return load_sums(spark, path)


def _sum_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The saved sums themselves."""
    sums = _merged(spark, sf).withColumn("start", F.date_format("start", "yyyy-MM-dd"))
    counts = [f"n_{m}" for m in MEASURES]
    return sums.select(
        "address", "start", "n", *(F.col(m).cast("bigint").alias(m) for m in MEASURES), *counts
    )


SUMS: dict[str, Query] = {
    "sums_per_address_and_month": _sum_counts,
    "sums_monthly_count": lambda s, d: monthly_summary(monthly_from_sums(_merged(s, d))).count,
    "sums_monthly_avg_value": lambda s, d: monthly_summary(monthly_from_sums(_sums(s, d))).avg_value,
    "sums_monthly_avg_gas_price": lambda s, d: monthly_summary(
        monthly_from_sums(_merged(s, d))
    ).avg_gas_price,
    "sums_monthly_avg_contract_gas": lambda s, d: contract_gas_from_sums(_merged(s, d), ct(s, d)),
    "sums_scam_totals": lambda s, d: _as_int(_total(scams_from_sums(_merged(s, d), sc(s, d)))),
    "sums_top_addresses_by_value": lambda s, d: _total(
        addresses_from_sums(_merged(s, d), ct(s, d))
    ),
}

# --- a typed copy of lines with integers too long for their type ------------------------------


def _long_copy(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    save_table(long_transactions(spark, sf), TRANSACTIONS, path)
    return load_table(spark, TRANSACTIONS, path)


LONG: dict[str, Query] = {
    "long_typed_counts": lambda s, d: _long_copy(s, d).groupBy(BEYOND).agg(
        F.count("*").alias("lines"), F.count("c3").alias("c3"), F.count("gas_used").alias("gas_used")
    ),
    "long_top_addresses_by_value": lambda s, d: _total(
        plans.top_addresses_by_value(_long_copy(s, d), ct(s, d))
    ),
    "long_top_scam_categories": lambda s, d: _total(
        plans.top_scam_categories(_long_copy(s, d), sc(s, d))
    ),
    "long_monthly_avg_value": lambda s, d: plans.monthly_avg_value(_long_copy(s, d)),
}


def queries() -> dict[str, Query]:
    return {
        **SUMS,
        **LONG,
        **QUERIES,
        **SOURCES,
        **FILTERS,
        **PROJECTIONS,
        **JOINS,
        **AGGREGATIONS,
        **ORDERS,
        **SHARED,
    }
