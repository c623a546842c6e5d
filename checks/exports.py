"""Comma-text ledger exports derived from the driver tables.

Every row of the source table becomes a line. Some lines are malformed, chosen by what the row
says (tax, discount, quantity, balance), so the parsers meet every rule on the whole table:
wrong arity, quoted commas, text and fractions for integers, the odd integer forms, empty and
repeated addresses, header lines. A third of the transactions share the empty address, and a
third of the blocks one miner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CENTS = "cast(round({} * 100) as bigint)"
_EPOCH = (
    "cast(unix_date(cast({0} as date)) as bigint) * 86400"
    " + hour({0}) * 3600 + minute({0}) * 60 + cast(second({0}) as int)"
)

TX_ADDRESS = """case l_returnflag when 'N' then '' when 'A' then concat('0xp', l_partkey)
 else concat('0xs', l_suppkey) end"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with(lines: DataFrame, *extra: str) -> DataFrame:
    """Adds single lines, such as a header, to an export."""
    more = lines.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(line) for line in extra])).alias("line")
    )
    return lines.unionByName(more)


_LINE_CENTS = _CENTS.format("l_extendedprice")
_TRANSACTION = f"""concat_ws(',', 'h', 'n', 'b',
          case when l_tax = 0.08 then 'x' else cast(l_orderkey as string) end,
          '0', 'f', {TX_ADDRESS},
          case when l_tax = 0.0 then ''
               when l_tax = 0.01 and l_linenumber = 6 then '1e5'
               when l_linenumber = 1 then concat(' ', {_LINE_CENTS}, '  ')
               when l_linenumber = 2 then concat('+', {_LINE_CENTS})
               when l_linenumber = 3 then concat('-00', {_LINE_CENTS})
               when l_linenumber = 4 then concat({_LINE_CENTS}, '_0')
               else cast({_LINE_CENTS} as string) end,
          case when l_discount = 0.1 then 'bad' else cast(cast(l_quantity as bigint) as string) end,
          case when l_discount = 0.0 then '1.5' else cast({_CENTS.format('l_discount')} as string) end,
          case when l_quantity = 49 then '"a,b"' else '0x' end,
          case when l_tax = 0.04 and l_linenumber = 7 then 'bad'
               else cast({_EPOCH.format('l_shipdate')} as string) end,
          '',
          case when l_quantity = 50 then '0' else '0,' end)"""


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").selectExpr(f"{_TRANSACTION} as line")
    return _with(lines, "h,n,b,c3,i,f,address,value,gas,price,input,ts,x,y,z")


def long_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines, but some fields that are integers have 39 digits and more: ``c3`` at tax 0.05
    or 0.06, gas used at discount 0.06 or 0.07."""
    rows = _table(spark, sf_dir, "lineitem").withColumns(
        {
            "c3": F.expr("case when l_tax in (0.05, 0.06) then repeat('7', 39) end"),
            "gas": F.expr("case when l_discount in (0.06, 0.07) then concat('+', repeat('9', 60)) end"),
        }
    )
    lines = rows.selectExpr(f"{_TRANSACTION} as line", "c3", "gas")
    part = F.split("line", ",")
    changed = F.transform(
        part,
        lambda text, i: F.when(i == 3, F.coalesce("c3", text))
        .when(i == 8, F.coalesce("gas", text))
        .otherwise(text),
    )
    return lines.select(F.array_join(changed, ",").alias("line"))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    lines = part.selectExpr(
        """concat('0xp', p_partkey, ',', p_name, ',,f,f',
          case p_size when 50 then '' when 49 then ',0,0' else ',0' end) as line"""
    )
    again = part.where("p_type = 'PROMO'").selectExpr(
        "concat('0xp', p_partkey, ',', p_name, ',,f,f,1') as line"
    )
    return _with(lines.unionByName(again), "address,byte,c,d,e,f", ",0x,,f,f,0")


def scams(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier")
    lines = supplier.selectExpr(
        """concat(case when s_acctbal < 0 then 'bad' else cast(s_nationkey as string) end, ',n,u,c,',
          case when s_acctbal < 2500 then 'Scamming' when s_acctbal < 5000 then 'Phishing'
               when s_acctbal < 7500 then 'Fake ICO' else 'Scam' end,
          ',s,0xs', s_suppkey, ',x') as line"""
    )
    again = supplier.where("s_acctbal >= 8000").selectExpr(
        "concat(100 + s_nationkey, ',n,u,c,Phishing,s,0xs', s_suppkey, ',x') as line"
    )
    return _with(
        lines.unionByName(again),
        "id,name,url,coin,category,sub,address,status",
        "777,n,u,c,Fake ICO,s,,x",
        "778,n,u,c,phishing,s,,x",
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "orders").selectExpr(
        f"""concat_ws(',', '0', '1', '2', '3', '4', '5', '6', '7', '8',
          case when o_orderstatus = 'P' then 'pool' else concat('m', o_custkey) end,
          '10', '11',
          case when o_orderstatus = 'F' and o_orderpriority = '4-NOT SPECIFIED' then 'bad'
               else cast({_CENTS.format('o_totalprice')} as string) end,
          '13', '14', '15', '16',
          case when o_orderstatus = 'O' and o_orderpriority = '5-LOW' then '17' else '17,18' end
        ) as line"""
    )
    return _with(lines, "a,b,c,d,e,f,g,h,i,miner,k,l,size,n,o,p,q,r,s")


EXPORTS = {
    "transactions": transactions,
    "contracts": contracts,
    "scams": scams,
    "blocks": blocks,
}
