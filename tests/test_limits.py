"""Long results, long integers, and ways and reports that must not depend on one another."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.scratch import SETTING, scratch
from ledger import contract, scam, tx
from ledgerloom import operators as ops
from ledgerloom import plans
from ledgerloom.__main__ import main
from ledgerloom.plans.reports import write_reports
from ledgerloom.session import build_session
from ledgerloom.sources import read_pairs

LARGE = "9" * 38


def month_lines():
    return [tx(ts=str(1104537600 + i * 2635200)) for i in range(132)]  # 30.5 days from 2005 on


def test_all_months_are_written(spark, lines, tmp_path):
    df = lines(*month_lines())
    names = ["monthly_count", "monthly_avg_value"]
    for name, path in write_reports({"transactions": df}, str(tmp_path), names).items():
        months = {r["month"] for r in getattr(plans, name)(df).collect()}
        saved = [r["key"] for r in read_pairs(spark, path).collect()]
        assert len(saved) == len(months) > 120 and set(saved) == months


@pytest.mark.parametrize("labels, size", [(1, None), (1, 0), (20, None), (20, 0)])
def test_only_listed_sums_can_overflow(spark, labels, size):
    facts = spark.createDataFrame([("a", 5), ("b", 0), ("b", 0)], "address string, n int")
    amount = F.when(F.col("address") == "b", F.lit(LARGE)).otherwise("5").cast("decimal(38,0)")
    facts = facts.withColumn("value", amount)
    listed = lambda key: spark.createDataFrame([(key, i) for i in range(labels)], "address string, id int")
    total = lambda key: ops.matched_totals(
        facts, listed(key), "address", "value", [], ["id"], broadcast_bytes=size
    )
    assert [(int(r["total"]), r["n"]) for r in total("a").collect()] == [(5, 1)] * labels
    with pytest.raises(Exception, match="(?i)overflow|out_of_range"):
        total("b").collect()


def test_long_checked_fields_keep_their_line(lines):
    raw = lines(tx(gas="1" * 39, c3="1" * 39, value="7"), tx(ts="1438387199000"))
    assert [tuple(r) for r in plans.top_addresses_by_value(raw, lines(contract("0xb"))).collect()] == [
        ("0xa", 8), ("0xb", 1),
    ]
    assert [int(r["total"]) for r in plans.top_scam_categories(raw, lines(scam())).collect()] == [8]
    assert {r["month"] for r in plans.monthly_count(raw).collect()} == {"07/2015", "09/47550"}


def test_two_digit_years_of_different_centuries_are_one_month(lines):
    raw = lines(tx(gas="10", ts="1438387199"), tx(gas="20", ts=str(1438387199 + 36524 * 86400)))
    assert [tuple(r) for r in plans.monthly_avg_contract_gas(raw, lines(contract())).collect()] == [("07 15", 15.0)]


def test_labels_are_formatted_after_the_first_exchange(spark, lines):
    raw = lines(tx())
    for df in (
        plans.monthly_count(raw), plans.monthly_avg_value(raw), plans.monthly_avg_gas_price(raw),
        plans.monthly_avg_contract_gas(raw, lines(contract())), plans.scam_series(raw, lines(scam()), "Phishing"),
    ):
        text = df._jdf.queryExecution().executedPlan().toString()
        # Rows are grouped by a date; the plan shows the label only inside a grouping of groups.
        assert "trunc(date_from_unix_date" in text and "date_format" not in text
        assert text.count("HashAggregate") >= 4


def test_one_reports_overflow_leaves_the_others(spark, lines, tmp_path):
    raw = lines(tx(price=LARGE), tx(price=LARGE))
    names = ["monthly_count", "monthly_avg_value"]
    paths = write_reports({"transactions": raw}, str(tmp_path), [*names])
    assert [r["value"] for r in read_pairs(spark, paths["monthly_count"]).collect()] == [2.0]
    base = plans.monthly.monthly_totals(raw.selectExpr("1438387199L ts", f"{LARGE}BD value", f"{LARGE}BD gas_price"))
    summary = plans.monthly.monthly_summary(base)
    assert summary.count.first()["n"] == 2
    with pytest.raises(Exception, match="(?i)overflow"):
        summary.avg_gas_price.collect()


def test_object_store_options_reach_a_running_session(spark):
    env = {
        "S3_ENDPOINT_URL": "store.example", "BUCKET_PORT": "9", "AWS_ACCESS_KEY_ID": "a", "AWS_SECRET_ACCESS_KEY": "b",
    }
    hadoop = build_session(env=env).sparkContext._jsc.hadoopConfiguration()
    assert hadoop.get("fs.s3a.endpoint") == "store.example:9"
    assert hadoop.get("fs.s3a.path.style.access") == "true"


class Elsewhere:
    """A session on a cluster, as far as scratch() looks."""

    class sparkContext:
        master = "spark://host:7077"

    def __init__(self, shared=None):
        self.conf = {SETTING: shared} if shared else {}


def test_scratch_on_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match=SETTING):
        scratch(Elsewhere())
    assert scratch(Elsewhere("hdfs://x/y/")).startswith("hdfs://x/y/")


def test_series_of_a_saved_result_from_the_command_line(spark, tmp_path, capsys):
    (tmp_path / "lines.csv").write_text("\n".join(month_lines()))
    main(["--transactions", str(tmp_path / "lines.csv"), "--out", str(tmp_path / "out"), "monthly_count"])
    saved = capsys.readouterr().out.split()[1].rsplit("/", 1)[1]
    main(["--out", str(tmp_path / "out"), "--series", saved])
    path = capsys.readouterr().out.split()[1]
    rows = read_pairs(spark, path).collect()
    assert len(rows) > 120 and all("," in r["key"] for r in rows)
