"""Times the end queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs from raw comma text and from the typed Parquet copy; a time is the best of three
warm runs, planning and the size check of a list included. $BENCH_COPIES repeats the transactions to see how a
time grows with the data.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.exports import EXPORTS  # noqa: E402
from checks.scratch import scratch  # noqa: E402
from ledgerloom import plans  # noqa: E402
from ledgerloom.sources import (  # noqa: E402
    BLOCKS,
    CONTRACTS,
    SCAMS,
    TRANSACTIONS,
    load_table,
    read_lines,
    save_table,
)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
RUNS = 3

TABLES = {t.name: t for t in (TRANSACTIONS, CONTRACTS, SCAMS, BLOCKS)}

QUERIES = {
    "monthly_count": lambda t: plans.monthly_count(t["transactions"]),
    "monthly_avg_value": lambda t: plans.monthly_avg_value(t["transactions"]),
    "monthly_avg_gas_price": lambda t: plans.monthly_avg_gas_price(t["transactions"]),
    "monthly_avg_contract_gas": lambda t: plans.monthly_avg_contract_gas(
        t["transactions"], t["contracts"]
    ),
    "top_gas_months": lambda t: plans.top_gas_months(t["transactions"], t["contracts"]),
    "top_addresses_by_value": lambda t: plans.top_addresses_by_value(
        t["transactions"], t["contracts"]
    ),
    "top_miners_by_size": lambda t: plans.top_miners_by_size(t["blocks"]),
    "top_scam_categories": lambda t: plans.top_scam_categories(t["transactions"], t["scams"]),
    "top_scam_ids": lambda t: plans.top_scam_ids(t["transactions"], t["scams"]),
    **{
        "scam_series_" + c.lower().replace(" ", "_"): (
            lambda t, c=c: plans.scam_series(t["transactions"], t["scams"], c)
        )
        for c in plans.SERIES_CATEGORIES
    },
}


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("ledgerloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> dict[str, dict]:
    """Writes the exports as text and as typed Parquet, once and untimed."""
    inputs: dict[str, dict] = {"text": {}, "parquet": {}}
    for name, export in EXPORTS.items():
        lines = export(spark, SF_DIR)
        if name == "transactions" and COPIES > 1:
            lines = lines.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
        text, parquet = scratch(spark), scratch(spark)
        lines.select("line").repartition(int(CPUS)).write.text(text)
        inputs["text"][name] = read_lines(spark, text)
        save_table(inputs["text"][name], TABLES[name], parquet)
        inputs["parquet"][name] = load_table(spark, TABLES[name], parquet)
    return inputs


def timed(query, tables) -> float:
    best = float("inf")
    for _ in range(RUNS + 1):  # the first run warms up
        start = time.perf_counter()
        query(tables).collect()
        best = min(best, time.perf_counter() - start)
    return round(best, 4)


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    inputs = prepare(spark)
    seconds = {
        f"{name}_{source}": timed(query, tables)
        for source, tables in inputs.items()
        for name, query in QUERIES.items()
    }
    found = re.search(r"sf([\d.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total warm time of the end queries, from text and from Parquet",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
                "cpus": int(CPUS),
                "copies": COPIES,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
