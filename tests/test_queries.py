"""End queries over hand-written lines, against plain-Python totals."""

from __future__ import annotations

import pytest

from ledger import averages, block, contract, joined, largest, month, scam, sums, tx
from ledgerloom import plans
from ledgerloom.plans.reports import NAMES, write_reports
from ledgerloom.sources import (
    BLOCKS,
    CONTRACTS,
    SCAMS,
    TRANSACTIONS,
    load_table,
    read_pairs,
    save_table,
)

WEI = 10**18
AUGUST, SEPTEMBER, NEXT_JANUARY = 1438387200, 1441065600, 1451606400

# (address, value, gas used, gas price, second)
ROWS = [
    ("", 5 * WEI, 21000, 50, AUGUST - 1),
    ("", 7 * WEI + 1, 90000, 51, AUGUST),
    ("0xa", 3 * WEI, 21000, 60, AUGUST),
    ("0xa", 0, 50000, 61, SEPTEMBER),
    ("0xb", 9 * WEI, 40000, 20, SEPTEMBER),
    ("0xb", 9 * WEI, 40001, 20, NEXT_JANUARY),
    ("0xc", 9 * WEI, 21000, 1, NEXT_JANUARY),
    ("0xd", 18 * WEI, 21000, 10**20, NEXT_JANUARY),
]
CONTRACT_ADDRESSES = ["0xa", "0xb", "0xb", "", "0xe"]
SCAM_ROWS = [
    (1, "Scamming", "0xa"),
    (1, "Scamming", "0xa"),
    (2, "Phishing", "0xb"),
    (3, "Fake ICO", ""),
    (3, "Phishing", "0xd"),
    (10, "Scam", "0xb"),
    (11, "phishing", "0xc"),
]
BLOCK_ROWS = [("m1", 500), ("m2", 10**30), ("m1", 700), ("m3", 1200)]

BAD_TX = [
    "h,n,b,c3,i,f,address,value,gas,price,input,ts,x,y,z",
    tx(extra=1),
    tx().rsplit(",", 1)[0],
    tx(ts="1e9"),
    tx(ts=""),
    "",
]


def tx_lines():
    return BAD_TX + [tx(a, str(v), str(g), str(p), str(t)) for a, v, g, p, t in ROWS]


@pytest.fixture(scope="module")
def raw(spark):
    def frame(text):
        return spark.createDataFrame([(t,) for t in text], "line string")

    return {
        "transactions": frame(tx_lines()),
        "contracts": frame([contract(a) for a in CONTRACT_ADDRESSES] + ["0xz,1,2,3,4"]),
        "scams": frame(
            [scam(str(i), c, a) for i, c, a in SCAM_ROWS] + [scam("bad"), "id,n,u,c,cat,s,addr,x"]
        ),
        "blocks": frame([block(m, str(s)) for m, s in BLOCK_ROWS] + [block("m9", "x"), "1,2"]),
    }


@pytest.fixture(scope="module")
def typed(spark, raw, tmp_path_factory):
    base = tmp_path_factory.mktemp("typed")
    out = {}
    for table in (TRANSACTIONS, CONTRACTS, SCAMS, BLOCKS):
        path = str(base / table.name)
        save_table(raw[table.name], table, path)
        out[table.name] = load_table(spark, table, path)
    return out


@pytest.fixture(params=["raw", "typed"])
def inputs(request):
    return request.getfixturevalue(request.param)


def pairs(df):
    return [tuple(int(x) if not isinstance(x, (str, float)) else x for x in r) for r in df.collect()]


def flagged():
    facts = [{"address": a, "value": v, "ts": t} for a, v, _, _, t in ROWS]
    return joined(facts, [{"id": i, "category": c, "address": a} for i, c, a in SCAM_ROWS])


def contract_gas():
    facts = [{"address": a, "gas": g, "ts": t} for a, _, g, _, t in ROWS]
    matched = joined(facts, [{"address": a} for a in CONTRACT_ADDRESSES])
    return averages((month(t["ts"], "%m %y"), t["gas"]) for t, _ in matched)


def test_monthly_count(inputs):
    expected = sums((month(t, "%m/%Y"), 1) for *_, t in ROWS)
    assert dict(pairs(plans.monthly_count(inputs["transactions"]))) == expected


def test_monthly_averages(inputs):
    values = averages((month(t, "%m %Y"), v) for _, v, _, _, t in ROWS)
    prices = averages((month(t, "%m %Y"), p) for _, _, _, p, t in ROWS)
    got = dict(pairs(plans.monthly_avg_value(inputs["transactions"])))
    assert got == {k: pytest.approx(v, rel=1e-15) for k, v in values.items()}
    got = dict(pairs(plans.monthly_avg_gas_price(inputs["transactions"])))
    assert got == {k: pytest.approx(v, rel=1e-15) for k, v in prices.items()}


def test_monthly_average_parts_are_exact(inputs):
    got = plans.monthly_avg_value(inputs["transactions"], parts=True).collect()
    expected = sums((month(t, "%m %Y"), v) for _, v, _, _, t in ROWS)
    assert {r.month: int(r.total) for r in got} == expected


def test_contract_gas(inputs):
    got = plans.monthly_avg_contract_gas(inputs["transactions"], inputs["contracts"])
    assert dict(pairs(got)) == contract_gas()
    top = plans.top_gas_months(inputs["transactions"], inputs["contracts"], 2)
    assert pairs(top) == largest(contract_gas(), 2)


def test_top_addresses(inputs):
    amounts = [(a, v) for a, v, *_ in ROWS] + [(a, 1) for a in CONTRACT_ADDRESSES]
    # Lines with a bad second still have a valid value.
    amounts += [("0xa", 1)] * 2
    totals = sums(amounts)
    got = plans.top_addresses_by_value(inputs["transactions"], inputs["contracts"], 4)
    assert pairs(got) == largest(totals, 4)
    only = plans.top_addresses_by_value(inputs["transactions"], inputs["contracts"], 10, True)
    listed = {a: t for a, t in totals.items() if a in CONTRACT_ADDRESSES}
    assert pairs(only) == largest(listed, 10)


def test_top_miners(inputs):
    assert pairs(plans.top_miners_by_size(inputs["blocks"])) == largest(sums(BLOCK_ROWS), 10)


def test_scam_tops(inputs):
    source = inputs["transactions"], inputs["scams"]
    categories = sums((e["category"], t["value"]) for t, e in flagged())
    assert pairs(plans.top_scam_categories(*source)) == largest(categories, 3)
    ids = sums((e["id"], t["value"]) for t, e in flagged())
    assert pairs(plans.top_scam_ids(*source)) == largest(ids, 10)


@pytest.mark.parametrize("category", plans.SERIES_CATEGORIES)
def test_scam_series(inputs, category):
    expected = sums(
        (month(t["ts"], "%m %y"), t["value"]) for t, e in flagged() if e["category"] == category
    )
    got = pairs(plans.scam_series(inputs["transactions"], inputs["scams"], category))
    assert got == sorted(expected.items())


def test_two_digit_years_share_a_label(lines):
    century = 3155760000  # the same month a hundred years on
    source = lines(tx(value="1", ts=str(AUGUST)), tx(value="2", ts=str(AUGUST - century)))
    got = plans.scam_series(source, lines(scam(category="Phishing")), "Phishing")
    assert pairs(got) == [("08 15", 3)]


def test_malformed_gas_drops_a_line_from_the_scam_reports(lines):
    source = lines(tx(value="5", gas="bad"), tx(value="7"))
    assert pairs(plans.top_scam_categories(source, lines(scam()))) == [("Phishing", 7)]


def test_malformed_value_drops_a_line_from_the_addresses(lines):
    source = lines(tx(value="bad"), tx(value="7"), tx(value="7", c3="x"))
    assert pairs(plans.top_addresses_by_value(source, lines(contract()))) == [("0xa", 8)]


def test_all_reports(spark, inputs, tmp_path):
    written = write_reports(inputs, str(tmp_path))
    assert sorted(written) == sorted(NAMES) and len(NAMES) == 12

    def saved(name, kind="double"):
        return [tuple(r) for r in read_pairs(spark, written[name], kind).collect()]

    source = inputs["transactions"]
    for name, df in {
        "monthly_count": plans.monthly_count(source),
        "monthly_avg_value": plans.monthly_avg_value(source),
        "monthly_avg_gas_price": plans.monthly_avg_gas_price(source),
        "monthly_avg_contract_gas": plans.monthly_avg_contract_gas(source, inputs["contracts"]),
    }.items():
        assert saved(name) == sorted((k, float(v)) for k, v in pairs(df))
    exact = "decimal(38,0)"
    for name, df in {
        "top_addresses_by_value": plans.top_addresses_by_value(source, inputs["contracts"]),
        "top_miners_by_size": plans.top_miners_by_size(inputs["blocks"]),
        "top_scam_categories": plans.top_scam_categories(source, inputs["scams"]),
        "top_scam_ids": plans.top_scam_ids(source, inputs["scams"]),
        "scam_series_fake_ico": plans.scam_series(source, inputs["scams"], "Fake ICO"),
    }.items():
        assert [(k, int(v)) for k, v in saved(name, exact)] == [(str(k), v) for k, v in pairs(df)]
    gas = plans.top_gas_months(source, inputs["contracts"])
    assert saved("top_gas_months") == pairs(gas)


def test_shared_scan_equals_single_reports_on_malformed_amounts(spark, lines, tmp_path):
    source = lines(tx(value="bad", price="4"), tx(value="6", price="1.5"), tx(value="x", price="", ts=str(AUGUST)))
    names = ["monthly_count", "monthly_avg_value", "monthly_avg_gas_price"]
    written = write_reports({"transactions": source}, str(tmp_path), names)
    got = {n: [tuple(r) for r in read_pairs(spark, p).collect()] for n, p in written.items()}
    assert got == {
        "monthly_count": [("07/2015", 2.0), ("08/2015", 1.0)],
        "monthly_avg_value": [("07 2015", 6.0)],
        "monthly_avg_gas_price": [("07 2015", 4.0)],
    }
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_unknown_report(inputs, tmp_path):
    with pytest.raises(ValueError, match="nonsense"):
        write_reports(inputs, str(tmp_path), ["nonsense"])


def test_sorted_series(spark):
    saved = spark.createDataFrame([("12/2015", 1.0), ("01/2016", 2.0)], "key string, value double")
    assert pairs(plans.sorted_series(saved)) == [("01/2016", 2.0), ("12/2015", 1.0)]
    assert pairs(plans.sorted_series(saved, commas=True)) == [("01,2016", 2.0), ("12,2015", 1.0)]
