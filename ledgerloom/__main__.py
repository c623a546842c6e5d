"""spark-submit entry: reads the exports and writes the asked reports."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans.reports import NAMES, SUMS, tables_of, write_reports
from ledgerloom.plans.series import sorted_series
from ledgerloom.plans.sums import load_sums, save_sums
from ledgerloom.session import build_session
from ledgerloom.sources import (
    BLOCKS,
    CONTRACTS,
    SCAMS,
    TRANSACTIONS,
    load_table,
    read_lines,
    read_pairs,
    save_table,
    write_result,
)

TABLES = {table.name: table for table in (TRANSACTIONS, CONTRACTS, SCAMS, BLOCKS)}


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ledgerloom")
    for name in TABLES:
        parser.add_argument(f"--{name}", help=f"comma text of {name}")
    parser.add_argument(
        "--typed",
        help="directory of typed copies: written anew from the exports given, read for the others",
    )
    parser.add_argument(
        "--sums",
        metavar="FOLDER",
        help="folder of saved sums: those of --transactions are added as --export, and the reports"
        " cover every export in it",
    )
    parser.add_argument("--export", metavar="NAME", help="name of the export that --sums adds")
    parser.add_argument("--out", required=True, help="directory for the results")
    parser.add_argument(
        "--series",
        action="append",
        default=[],
        metavar="RESULT",
        help="a saved result in --out to write as a label-sorted series; labels of counts get a comma",
    )
    parser.add_argument("reports", nargs="*", help=f"default: all of {', '.join(NAMES)}")
    args = parser.parse_args(argv)
    if args.sums and bool(args.transactions) != bool(args.export):
        parser.error("--sums takes --transactions and --export together, or neither")
    return args


def read_input(spark: SparkSession, name: str, text: str | None, typed: str | None) -> DataFrame:
    if typed is None:
        return read_lines(spark, text)
    path = f"{typed.rstrip('/')}/{name}"
    if text:
        save_table(read_lines(spark, text), TABLES[name], path, replace=True)
    return load_table(spark, TABLES[name], path)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session()
    if args.reports or not args.series:
        write_all(spark, args)
    for name in args.series:
        pairs = read_pairs(spark, f"{args.out.rstrip('/')}/{name}")
        series = sorted_series(pairs, commas=name.startswith("monthly_count"))
        print("series", write_result(series, args.out, f"series_{name}_"))


def write_all(spark: SparkSession, args: argparse.Namespace) -> None:
    inputs = {}
    for name in sorted(tables_of(args.reports)):
        text = getattr(args, name)
        if name == TRANSACTIONS.name and args.sums:
            if text:
                save_sums(read_lines(spark, text), args.sums, args.export)
            inputs[SUMS] = load_sums(spark, args.sums)
        elif text or args.typed:
            inputs[name] = read_input(spark, name, text, args.typed)
    for name, path in write_reports(inputs, args.out, args.reports).items():
        print(name, path)


if __name__ == "__main__":
    main()
