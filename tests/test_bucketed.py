"""Typed copies in buckets: no exchange of facts, hot keys apart, equal results."""

from __future__ import annotations

import random

import pytest

from ledger import contract, scam, tx
from ledgerloom import operators as ops
from ledgerloom import plans
from ledgerloom.sources import SCAMS, TRANSACTIONS, load_bucketed, load_table, pick, save_bucketed, save_table

LONG = "1" * 39


def made(seed=1, n=600, long=False):
    draw = random.Random(seed)
    return [
        tx(
            address="" if draw.random() < 1 / 3 else f"0x{draw.randrange(90)}", value=draw.choice(["x", "5", "12"]),
            gas=draw.choice(["7", "y", "30"]), ts=str(1438387199 + draw.randrange(10**8)),
            c3=LONG if long and draw.random() < 0.1 else "1",
        )
        for _ in range(n)
    ]


LISTED = [contract(f"0x{i}") for i in range(0, 90, 2)] + [contract(""), contract(""), contract("0xz")]
FLAGGED = [scam(str(i % 4), ("Phishing", "Other")[i % 2], f"0x{i}") for i in range(0, 90, 3)]
FLAGGED += [scam(str(i), "Phishing", "") for i in range(20)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    """Every list counts as large."""
    spark.conf.set("spark.ledgerloom.broadcastBytes", "0")
    yield
    spark.conf.unset("spark.ledgerloom.broadcastBytes")


@pytest.mark.parametrize("long", [False, True])
@pytest.mark.parametrize("source", ["text", "typed"])
def test_reports_equal_those_of_the_text(spark, lines, tmp_path, large, long, source):
    raw = lines(*made(long=long))
    given = raw
    if source == "typed":
        save_table(raw, TRANSACTIONS, str(tmp_path / "typed"))
        given = load_table(spark, TRANSACTIONS, str(tmp_path / "typed"))
    save_bucketed(given, TRANSACTIONS, str(tmp_path / "b"), buckets=8)
    copy = load_bucketed(spark, TRANSACTIONS, str(tmp_path / "b"))
    assert [r[0] for r in copy.hot_keys.collect()] == [""]
    assert copy.hot.where("address <> ''").count() == 0 and copy.all().count() == 600
    listed, flagged = lines(*LISTED), lines(*FLAGGED)
    for report in (
        lambda t: plans.monthly_avg_contract_gas(t, listed), lambda t: plans.scam_totals(t, flagged),
        lambda t: plans.top_scam_ids(t, flagged), lambda t: plans.scam_series(t, flagged, "Phishing"),
        lambda t: plans.top_addresses_by_value(t, listed), plans.monthly_count, plans.monthly_avg_value,
    ):
        assert rows(report(copy)) == rows(report(raw))


def test_a_large_list_shuffles_no_fact(spark, lines, tmp_path, large):
    save_bucketed(lines(*made()), TRANSACTIONS, str(tmp_path / "b"), buckets=8)
    copy = load_bucketed(spark, TRANSACTIONS, str(tmp_path / "b"))
    listed = lines(*LISTED).select("line")
    text = plan(plans.monthly_avg_contract_gas(copy, listed))
    assert "Bucketed: true" in text and "SortMergeJoin" in text
    # From the join down to the scan of the buckets there is no exchange; the list has one.
    facts = text[text.index("SortMergeJoin") : text.index("Bucketed: true")]
    assert "Exchange" not in facts
    labelled = pick(lines(*FLAGGED), SCAMS, "id", "address")
    amounts = pick(copy, TRANSACTIONS, "address", "value")
    text = plan(ops.matched_totals(amounts, labelled, "address", "value", [], ["id"]))
    facts = text[text.index("SortMergeJoin") : text.index("Bucketed: true")]
    assert "Exchange" not in facts and "partial_try_sum" in facts


def test_small_lists_are_broadcast_to_all_rows(spark, lines, tmp_path):
    raw = lines(*made())
    save_bucketed(raw, TRANSACTIONS, str(tmp_path / "b"), buckets=8)
    copy = load_bucketed(spark, TRANSACTIONS, str(tmp_path / "b"))
    df = plans.monthly_avg_contract_gas(copy, lines(*LISTED))
    assert "SortMergeJoin" not in plan(df) and rows(df) == rows(plans.monthly_avg_contract_gas(raw, lines(*LISTED)))


def test_a_missing_copy_and_an_empty_one(spark, lines, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_bucketed(spark, TRANSACTIONS, str(tmp_path / "none"))
    save_bucketed(lines("junk"), TRANSACTIONS, str(tmp_path / "b"), buckets=4)
    copy = load_bucketed(spark, TRANSACTIONS, str(tmp_path / "b"))
    assert copy.all().count() == 0 and rows(plans.monthly_count(copy)) == []
