"""Sums per address and month: one scan, equal reports, merging of exports."""

from __future__ import annotations

import random
from datetime import datetime

import pytest

from checks.exports import transactions
from checks.queries import _halves
from ledger import block, contract, scam, tx
from ledgerloom import plans
from ledgerloom.plans.reports import NAMES, write_reports
from ledgerloom.plans.sums import (
    MEASURES, addresses_from_sums, contract_gas_from_sums, ledger_sums, load_sums, merged_sums, monthly_from_sums,
    save_sums, scams_from_sums,
)
from ledgerloom.sources import TRANSACTIONS, load_table, read_pairs, save_table

LONG = "1" * 39


def random_lines(seed, n=400):
    draw = random.Random(seed)
    pick = lambda *texts: draw.choice(texts)
    return [
        tx(
            address="" if draw.random() < 1 / 3 else f"0x{draw.randrange(6)}",
            value=pick("bad", "7", " 12 ", str(draw.randrange(10**12))), gas=pick("x", "3", str(draw.randrange(90))),
            price=pick("1.5", "2", "9"), c3=pick("", "1", LONG), extra=draw.randrange(10) == 0,
            ts=pick("bad", str(1438387199 + draw.randrange(10**8)), str(draw.randrange(10**9))),
        )
        for _ in range(n)
    ]


LISTED = [contract(f"0x{i}") for i in (0, 1, 1, 3)] + [contract("")]
SCAMS = [scam(str(i), c, f"0x{i}") for i, c in enumerate(("Phishing", "Scamming", "Fake ICO", "Other"))]
SCAMS += [scam("9", "Phishing", "0x1"), scam("8", "Phishing", "")]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def frames(spark):
    made = lambda text: spark.createDataFrame([(t,) for t in text], "line string")
    return made(random_lines(1)), made(LISTED), made(SCAMS)


def test_reports_out_of_sums_equal_the_single_reports(frames):
    raw, listed, flagged = frames
    sums = ledger_sums(raw).persist()
    summary = plans.monthly_summary(monthly_from_sums(sums))
    assert rows(summary.count) == rows(plans.monthly_count(raw))
    assert rows(summary.avg_value) == rows(plans.monthly_avg_value(raw))
    assert rows(summary.avg_gas_price) == rows(plans.monthly_avg_gas_price(raw))
    assert rows(contract_gas_from_sums(sums, listed)) == rows(plans.monthly_avg_contract_gas(raw, listed))
    assert rows(scams_from_sums(sums, flagged)) == rows(plans.scam_totals(raw, flagged))
    assert rows(addresses_from_sums(sums, listed)) == rows(plans.top_addresses_by_value(raw, listed))


def test_large_lists_meet_sums_by_a_sorted_join(spark, frames):
    raw, listed, flagged = frames
    sums = ledger_sums(raw)
    spark.conf.set("spark.ledgerloom.broadcastBytes", "0")
    try:
        gas, scams = contract_gas_from_sums(sums, listed), scams_from_sums(sums, flagged)
        assert "Broadcast" not in gas._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.ledgerloom.broadcastBytes")
    assert rows(gas) == rows(plans.monthly_avg_contract_gas(raw, listed))
    assert rows(scams) == rows(plans.scam_totals(raw, flagged))


def test_saved_sums_of_two_exports_merge(spark, tmp_path, lines):
    text = random_lines(2)
    save_sums(lines(*text[:150]), str(tmp_path / "sums"), "a")
    save_sums(lines(*text[150:]), str(tmp_path / "sums"), "2")
    merged = load_sums(spark, str(tmp_path / "sums"))
    columns = ["address", "start", "n", *(c for m in MEASURES for c in (m, f"n_{m}"))]
    assert rows(merged.select(columns)) == rows(ledger_sums(lines(*text)).select(columns))
    with pytest.raises(Exception, match="(?i)exist"):
        save_sums(lines(*text[:150]), str(tmp_path / "sums"), "a")


def test_lost_sums_stay_lost_when_merged_and_raise_only_where_used(spark, lines, tmp_path):
    big = "9" * 38
    parts = [ledger_sums(lines(tx(value=v, gas="2"), tx(address="0xb", ts="bad", value="5"))) for v in (big, LONG, "1")]
    sums = merged_sums(merged_sums(parts[0].unionByName(parts[1])).unionByName(parts[2]))
    summary = plans.monthly_summary(monthly_from_sums(sums))
    assert rows(summary.count) == [("07/2015", 3)]
    assert rows(summary.avg_gas_price) == [("07 2015", 1.0)]
    assert rows(contract_gas_from_sums(sums, lines(contract()))) == [("07 15", 2.0)]
    for broken in (summary.avg_value, scams_from_sums(sums, lines(scam())), addresses_from_sums(sums, lines(contract()))):
        with pytest.raises(Exception, match="(?i)overflow"):
            broken.collect()
    assert rows(scams_from_sums(sums, lines(scam(address="0xb")))) == []


def test_seconds_beyond_a_date_raise_in_monthly_reports_only(lines):
    raw = lines(tx(value="3"), tx(value="4", ts="9" * 18), tx(value="5", ts="9" * 30))
    sums = ledger_sums(raw)
    assert rows(addresses_from_sums(sums, lines(contract("0xb")))) == [("0xa", 12), ("0xb", 1)]
    assert {r["total"] for r in scams_from_sums(sums, lines(scam())).collect()} == {3, 9}
    with pytest.raises(Exception, match="OUT_OF_RANGE"):
        plans.monthly_summary(monthly_from_sums(sums)).count.collect()


def saved(spark, paths):
    return {name: sorted(map(tuple, read_pairs(spark, path).collect())) for name, path in paths.items()}


def test_a_run_over_text_scans_the_transactions_once(spark, tmp_path, monkeypatch, frames):
    from ledgerloom.plans import reports

    raw, listed, flagged = frames
    raw.write.text(str(tmp_path / "tx"))
    text = spark.read.text(str(tmp_path / "tx")).withColumnRenamed("value", "line")
    inputs = {"transactions": text, "contracts": listed, "scams": flagged}
    inputs["blocks"] = spark.createDataFrame([(block("m", "5"),)], "line string")
    plans_seen = []
    write = reports.write_result

    def spy(df, *args, **kwargs):
        plans_seen.append(df._jdf.queryExecution().withCachedData().toString())
        return write(df, *args, **kwargs)

    monkeypatch.setattr(reports, "write_result", spy)
    one = saved(spark, write_reports(inputs, str(tmp_path / "one")))
    assert len(plans_seen) == len(NAMES)
    # What is written reads the cached sums, never the text; only the cache itself scans it.
    assert all("InMemoryRelation" in p for p in plans_seen[: len(NAMES) - 1])
    assert all("Relation [value" not in p.split("InMemoryRelation")[0] for p in plans_seen[: len(NAMES) - 1])

    path = str(tmp_path / "typed")
    save_table(text, TRANSACTIONS, path)
    typed = {**inputs, "transactions": load_table(spark, TRANSACTIONS, path)}
    assert saved(spark, write_reports(typed, str(tmp_path / "two"))) == one


def test_reports_from_saved_sums(spark, tmp_path, frames):
    raw, listed, flagged = frames
    save_sums(raw, str(tmp_path / "sums"), "all")
    inputs = {"sums": load_sums(spark, str(tmp_path / "sums")), "contracts": listed, "scams": flagged}
    names = [n for n in NAMES if n != "top_miners_by_size"]
    from_sums = saved(spark, write_reports(inputs, str(tmp_path / "a"), names))
    plain = {"transactions": raw, "contracts": listed, "scams": flagged}
    for name in names:  # one at a time: the ways of single reports
        assert saved(spark, write_reports(plain, str(tmp_path / name), [name]))[name] == from_sums[name]


def test_monthly_reports_of_a_typed_copy_with_long_integers(spark, lines, tmp_path):
    raw = lines(tx(value="3"), tx(value=LONG, price="4"), tx(value="5", price=LONG, ts="x"))
    path = str(tmp_path / "typed")
    save_table(raw, TRANSACTIONS, path)
    inputs = {"transactions": load_table(spark, TRANSACTIONS, path)}
    paths = write_reports(inputs, str(tmp_path / "out"), ["monthly_count", "monthly_avg_gas_price"])
    assert saved(spark, paths) == {"monthly_count": [("07/2015", 2.0)], "monthly_avg_gas_price": [("07 2015", 2.5)]}
    with pytest.raises(Exception, match="(?i)overflow|OUT_OF_RANGE"):
        write_reports(inputs, str(tmp_path / "out2"), ["monthly_count", "monthly_avg_value"])


def test_lines_of_two_exports_are_put_together_once(spark, tmp_path):
    rows = [
        (i * 10 ** (i % 3 * 8), i % 9, i % 5, 1 + i % 7, float(i % 51), 10.0**(i % 8), i % 11 / 100, i % 9 / 100, "NAR"[i % 3],
         datetime(2015, 8, 1 + i % 28)) for i in range(300)
    ]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"
    names += ", l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    halves = _halves(spark, str(tmp_path))
    for half in halves.values():
        assert half.count() and half._jdf.queryExecution().optimizedPlan().toString().count("concat_ws") == 1
    whole = sorted(r[0] for r in transactions(spark, str(tmp_path)).collect())
    assert sorted(r[0] for half in halves.values() for r in half.collect()) == whole
    assert all((len(r[0]) <= 60) == (n == "short") for n, half in halves.items() for r in half.collect())
