"""Runs every registered query beside its SQL and compares names, types and rows.

    python -m checks.compare [folder of the tables] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import oracle_sql
from checks.queries import queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


SPARK_TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double",
    "DECIMAL(38,0)": "decimal(38,0)",
}


def rows_of(names: list[str], rows) -> list[tuple]:
    """Rows with columns by name and sorted, for an order-free comparison."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    frame = queries()[name](spark, sf_dir)
    ours = rows_of(frame.columns, frame.collect())
    result = connection.execute(oracle_sql()[name])
    names = [column[0] for column in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {frame.columns} != {names}"
    types = {c[0]: SPARK_TYPES.get(str(c[1]), str(c[1])) for c in result.description}
    if types != dict(frame.dtypes):
        return f"types {dict(frame.dtypes)} != {types}"
    if not theirs:
        return "the SQL gives no row"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if repr(mine) != repr(other):
            return f"{mine} != {other}"
    return None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    connection = oracle_connection(sf_dir)
    wrong = 0
    for name in sys.argv[2:] or queries():
        start = time.time()
        try:
            found = difference(spark, connection, sf_dir, name)
        except Exception as error:  # keep going: the list of all failures is the result
            found = f"{type(error).__name__}: {str(error)[:600]}"
        wrong += found is not None
        print(f"{name}: {found or 'equal'} ({time.time() - start:.2f} s)", flush=True)
    print(f"{wrong} differ")
    spark.stop()


if __name__ == "__main__":
    main()
