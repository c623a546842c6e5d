"""DuckDB SQL per query.

The common table expressions list the rows of each export that must survive, straight from the
driver tables: no line is built or parsed here. ok3 to ok11 say which integer fields are valid.
"""

from __future__ import annotations

CLEAN = """
with tx as (
  select case l_returnflag when 'N' then '' when 'A' then concat('0xp', l_partkey)
              else concat('0xs', l_suppkey) end as address,
    cast(l_orderkey as varchar) as c3_text,
    case l_linenumber when 3 then -cast(round(l_extendedprice * 100) as bigint)
                      when 4 then 10 * cast(round(l_extendedprice * 100) as bigint)
                      else cast(round(l_extendedprice * 100) as bigint) end as value,
    cast(l_quantity as bigint) as gas_used,
    cast(round(l_discount * 100) as bigint) as gas_price,
    l_shipdate as ts,
    l_tax <> 0.08 as ok3,
    not (l_tax = 0.0 or (l_tax = 0.01 and l_linenumber = 6)) as ok7,
    l_discount <> 0.1 as ok8,
    l_discount <> 0.0 as ok9,
    not (l_tax = 0.04 and l_linenumber = 7) as ok11
  from lineitem where l_quantity not in (49, 50)),
ct as (
  select concat('0xp', p_partkey) as address from part where p_size not in (49, 50)
  union all select concat('0xp', p_partkey) from part where p_type = 'PROMO'
  union all select 'address'
  union all select ''),
sc as (
  select s_nationkey as id,
    case when s_acctbal < 2500 then 'Scamming' when s_acctbal < 5000 then 'Phishing'
         when s_acctbal < 7500 then 'Fake ICO' else 'Scam' end as category,
    concat('0xs', s_suppkey) as address
  from supplier where s_acctbal >= 0
  union all select 100 + s_nationkey, 'Phishing', concat('0xs', s_suppkey)
    from supplier where s_acctbal >= 8000
  union all select 777, 'Fake ICO', ''
  union all select 778, 'phishing', ''),
bl as (
  select case when o_orderstatus = 'P' then 'pool' else concat('m', o_custkey) end as miner,
    cast(round(o_totalprice * 100) as bigint) as size
  from orders
  where not (o_orderstatus = 'F' and o_orderpriority = '4-NOT SPECIFIED')
    and not (o_orderstatus = 'O' and o_orderpriority = '5-LOW'))
"""

_AVG = "cast(sum({0}) as double) / cast(count(*) as double)"
_TOTAL = "cast(sum(value) as bigint) as total"
_SCAM_JOIN = "from tx join sc using (address) where ok7 and ok8 and ok11"
_SERIES = (
    f"select strftime(ts, '%m %y') as month, {_TOTAL} {_SCAM_JOIN} and category = '{{}}'"
    " group by 1 order by 1"
)
_GAS = (
    f"select strftime(ts, '%m %y') as month, {_AVG.format('gas_used')} as avg_gas"
    " from tx join ct using (address) where ok8 and ok11 group by 1"
)
_ADDRESSES = """(select address, cast(sum(v) as bigint) as total from (
  select address, value as v from tx where ok3 and ok7 union all select address, 1 from ct) u
  group by 1)"""

QUERIES = {
    "monthly_count": "select strftime(ts, '%m/%Y') as month, count(*) as n from tx where ok11 group by 1",
    "monthly_avg_value": f"select strftime(ts, '%m %Y') as month, {_AVG.format('value')} as avg_value from tx where ok7 and ok11 group by 1",
    "monthly_avg_gas_price": f"select strftime(ts, '%m %Y') as month, {_AVG.format('gas_price')} as avg_gas_price from tx where ok9 and ok11 group by 1",
    "monthly_avg_contract_gas": _GAS,
    "top_gas_months": f"{_GAS} order by 2 desc, 1 limit 10",
    "top_addresses_by_value": f"select * from {_ADDRESSES} order by 2 desc, 1 limit 10",
    "top_contracts_by_value": f"select * from {_ADDRESSES} where address in (select address from ct) order by 2 desc, 1 limit 10",
    "top_miners_by_size": "select miner, cast(sum(size) as bigint) as total_size from bl group by 1 order by 2 desc, 1 limit 10",
    "top_scam_categories": f"select category, {_TOTAL} {_SCAM_JOIN} group by 1 order by 2 desc, 1 limit 3",
    "top_scam_ids": f"select id, {_TOTAL} {_SCAM_JOIN} group by 1 order by 2 desc, 1 limit 10",
    "scam_series_scamming": _SERIES.format("Scamming"),
    "scam_series_phishing": _SERIES.format("Phishing"),
    "scam_series_fake_ico": _SERIES.format("Fake ICO"),
    "sorted_series_average": f"select strftime(ts, '%m %Y') as label, {_AVG.format('value')} as value from tx where ok7 and ok11 group by 1 order by 1",
    "sorted_series_count": "select strftime(ts, '%m,%Y') as label, cast(count(*) as double) as value from tx where ok11 group by 1 order by 1",
}

OPERATORS = {
    "source_transactions": "select case l_quantity when 50 then 14 when 49 then 16 else 15 end as arity, count(*) + case when arity = 15 then 1 else 0 end as n from lineitem group by 1",
    "source_contracts": "select arity, cast(sum(n) as bigint) as n from (select case p_size when 50 then 5 when 49 then 7 else 6 end as arity, count(*) as n from part group by 1 union all select 6, count(*) + 2 from part where p_type = 'PROMO') u group by 1",
    "source_scams": "select 8 as arity, (select count(*) from supplier) + (select count(*) from supplier where s_acctbal >= 8000) + 3 as n",
    "source_blocks": "select case when o_orderstatus = 'O' and o_orderpriority = '5-LOW' then 18 else 19 end as arity, count(*) + case when arity = 19 then 1 else 0 end as n from orders group by 1",
    "source_typed_transactions": "select address, count(*) as lines, count(*) filter (ok3) as c3, count(*) filter (ok7) as value, count(*) filter (ok8) as gas_used, count(*) filter (ok9) as gas_price, count(*) filter (ok11) as ts from tx group by 1 union all select 'address', 1, 0, 0, 0, 0, 0",  # the header has 15 fields
    "source_pairs": f"select strftime(ts, '%m %Y') as key, {_AVG.format('gas_price')} as value from tx where ok9 and ok11 group by 1",
    "sink_all_pairs": "select cast(o_custkey as varchar) as key, count(*) as value from orders group by 1",
    "sink_pairs": "select miner as key, cast(sum(size) as bigint) as value from bl group by 1 order by 2 desc, 1 limit 100",
    "filter_count_form": "select address, count(*) as n from tx where ok11 group by 1",
    "filter_value_form": "select address, count(*) as n from tx where ok7 and ok11 group by 1",
    "filter_gas_price_form": "select address, count(*) as n from tx where ok9 and ok11 group by 1",
    "filter_gas_used_form": "select address, count(*) as n from tx where ok8 and ok11 group by 1",
    "filter_field_3_form": "select address, count(*) as n from tx where ok3 group by 1",
    "filter_contracts": "select address, count(*) as n from ct group by 1",
    "filter_scams": "select id, category, address from sc",
    "filter_blocks": "select miner, size from bl",
    "filter_category": "select id, category, address from sc where category in ('Scamming', 'Phishing', 'Fake ICO')",
    "project_fields": "select address, case when ok3 then c3_text else 'x' end as c3, case when ok8 then cast(gas_used as varchar) else 'bad' end as gas_used from tx union all select 'address', 'c3', 'gas'",  # the header too
    "project_integer": "select address, value from tx where ok7",
    "project_month_year": "select o_orderkey, strftime(o_orderdate, '%m %Y') as month from orders",
    "project_month_slash_year": "select o_orderkey, strftime(o_orderdate, '%m/%Y') as month from orders",
    "project_month_short_year": "select event_id, strftime(ts, '%m %y') as month from events",
    "project_marker": "select address, 1 as marker from ct",
    "project_rekey": f"select strftime(ts, '%m %y') as month, category, id, {_TOTAL} {_SCAM_JOIN} group by 1, 2, 3",
    "project_ratio": "select l_returnflag, l_linestatus, cast(sum(cast(l_quantity as bigint)) as double) / cast(count(*) as double) as average from lineitem group by 1, 2",
    "project_relabel": "select strftime(ts, '%m,%Y') as month, count(*) as n from tx where ok11 group by 1",
    "project_saved_numbers": "select miner as key, cast(sum(size) as double) as value from bl group by 1 order by 2 desc, 1 limit 100",
    "join_contracts": "select strftime(ts, '%m %y') as month, cast(sum(gas_used) as bigint) as total, count(*) as n from tx join ct using (address) where ok8 and ok11 group by 1",
    "join_contracts_shuffled": "select strftime(ts, '%m %y') as month, cast(sum(gas_used) as bigint) as total, count(*) as n from tx join ct using (address) where ok8 and ok11 group by 1",
    "join_scams": f"select id, category, {_TOTAL}, count(*) as n {_SCAM_JOIN} group by 1, 2",
    "join_scams_shuffled": f"select id, category, {_TOTAL}, count(*) as n {_SCAM_JOIN} group by 1, 2",
    "join_many_labels": "select l.l_partkey, cast(sum(cast(round(f.l_quantity) as bigint)) as bigint) as total, count(*) as n from lineitem f join lineitem l using (l_suppkey) group by 1",
    "join_many_labels_shuffled": "select l.l_partkey, cast(sum(cast(round(f.l_quantity) as bigint)) as bigint) as total, count(*) as n from lineitem f join lineitem l using (l_suppkey) group by 1",
    "join_counts": f"select strftime(ts, '%m %Y') as month, {_AVG.format('value')} as average from tx where ok7 and ok11 group by 1",
    "count_per_key": "select l_partkey, count(*) as n from lineitem group by 1",
    "count_per_month": "select strftime(o_orderdate, '%m/%Y') as month, count(*) as n from orders group by 1",
    "sum_per_month": "select strftime(o_orderdate, '%m %y') as month, cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as total from orders group by 1",
    "average_per_month": f"select strftime(o_orderdate, '%m %Y') as month, cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as total, count(*) as n, {_AVG.format('cast(round(o_totalprice * 100) as bigint)')} as average from orders group by 1",
    "sum_per_address": f"select * from {_ADDRESSES} a",
    "sum_per_miner": "select miner, cast(sum(size) as bigint) as total from bl group by 1",
    "sum_per_category": f"select category, {_TOTAL} {_SCAM_JOIN} group by 1",
    "sum_per_id": f"select id, {_TOTAL} {_SCAM_JOIN} group by 1",
    "sum_beyond_64_bits": "select address, cast(sum(cast(value as hugeint) * 10000000000000000) as varchar) as total from tx where ok7 group by 1",
    "sort_by_amount": "select miner, cast(sum(size) as bigint) as total from bl group by 1 order by 2 desc, 1",
    "sort_by_key": f"select strftime(ts, '%m %y') as month, {_TOTAL} {_SCAM_JOIN} group by 1 order by 1",
    "sort_saved_series": "select strftime(o_orderdate, '%m/%Y') as label, cast(count(*) as double) as value from orders group by 1 order by 1",
    "top_k_amount": "select l_partkey, cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) as total from lineitem group by 1 order by 2 desc, 1 limit 10",
    "first_of_sorted": "select o_custkey, count(*) as n from orders group by 1 order by 1 limit 100",
    "bounded_result": "select c_nationkey, cast(sum(cast(round(c_acctbal * 100) as bigint)) as bigint) as total from customer group by 1 order by 1 limit 10",
    "union_markers": "select address, value from tx where ok3 and ok7 union all select address, 1 from ct",
    "shared_monthly_count": "select strftime(ts, '%m/%Y') as month, count(*) as n from tx where ok11 group by 1",
    "shared_monthly_avg_value": f"select strftime(ts, '%m %Y') as month, {_AVG.format('value')} as avg_value from tx where ok7 and ok11 group by 1",
    "shared_monthly_avg_gas_price": f"select strftime(ts, '%m %Y') as month, {_AVG.format('gas_price')} as avg_gas_price from tx where ok9 and ok11 group by 1",
    "shared_scam_categories": f"select category, {_TOTAL} {_SCAM_JOIN} group by 1",
}

_START = "cast(date_trunc('month', ts) as date)"
_MEASURES = {"value": "ok7 and ok11", "gas_price": "ok9 and ok11", "gas_used": "ok8 and ok11", "received": "ok7 and ok8 and ok11", "placed": "ok3 and ok7"}
_AMOUNTS = {"received": "value", "placed": "value"}
_SUMS = ", ".join(f"cast(sum({_AMOUNTS.get(m, m)}) filter ({ok}) as bigint) as {m}, count(*) filter ({ok}) as n_{m}" for m, ok in _MEASURES.items())

SHARED = {
    # The header line has 15 fields and no valid integer: a row of an address without any sum.
    "sums_per_address_and_month": f"select address, case when ok11 then strftime({_START}, '%Y-%m-%d') end as start, count(*) filter (ok11) as n, {_SUMS} from tx group by 1, 2 union all select 'address', null, 0, null, 0, null, 0, null, 0, null, 0, null, 0",
    "sums_monthly_count": QUERIES["monthly_count"],
    "sums_monthly_avg_value": QUERIES["monthly_avg_value"],
    "sums_monthly_avg_gas_price": QUERIES["monthly_avg_gas_price"],
    "sums_monthly_avg_contract_gas": QUERIES["monthly_avg_contract_gas"],
    "sums_scam_totals": OPERATORS["project_rekey"],
    "sums_top_addresses_by_value": QUERIES["top_addresses_by_value"],
    "join_contracts_bucketed": OPERATORS["join_contracts"],
    "join_scams_bucketed": OPERATORS["join_scams"],
    "long_typed_counts": """select case when long3 and long8 then 'c3-gas_used' when long3 then 'c3' when long8 then 'gas_used' else 'none' end as beyond,
      count(*) as lines, count(*) filter (ok3 and not long3) as c3, count(*) filter (ok8 and not long8) as gas_used
      from (select l_tax in (0.05, 0.06) as long3, l_discount in (0.06, 0.07) as long8, l_tax <> 0.08 as ok3, l_discount <> 0.1 as ok8
            from lineitem where l_quantity not in (49, 50)) t group by 1""",
    "long_top_addresses_by_value": QUERIES["top_addresses_by_value"],
    "long_top_scam_categories": QUERIES["top_scam_categories"],
    "long_monthly_avg_value": QUERIES["monthly_avg_value"],
}


def oracle_sql() -> dict[str, str]:
    return {name: CLEAN + sql for name, sql in {**QUERIES, **OPERATORS, **SHARED}.items()}
