"""Shapes of the physical plans."""

from __future__ import annotations

import uuid

import pytest

from ledger import contract, scam, tx
from ledgerloom import operators as ops
from ledgerloom import plans
from ledgerloom.sources import CONTRACTS, SCAMS, TRANSACTIONS, load_table, pick, read_lines, save_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("plans")
    paths = {}
    for name, line in {"tx": tx(), "ct": contract(), "sc": scam()}.items():
        (base / name).mkdir()
        (base / name / "part.csv").write_text(line + "\n")
        paths[name] = read_lines(spark, str(base / name))
    save_table(paths["tx"], TRANSACTIONS, str(base / "typed"))
    paths["typed"] = load_table(spark, TRANSACTIONS, str(base / "typed"))
    return paths


def test_monthly_report_is_one_scan_and_one_shuffle(files):
    text = plan(plans.monthly_avg_value(files["tx"]))
    # The second exchange carries one row for each month.
    assert text.count("FileScan") == 1 and text.count("Exchange") == 2
    assert "partial_sum" in text


def test_a_line_is_split_and_converted_once(files):
    text = plan(plans.monthly_avg_value(files["tx"]))
    assert text.count("split(") == 1
    assert text.count("RLIKE") == 2  # value and ts


def test_typed_table_reads_its_columns_and_pushes_null_tests(files):
    text = plan(plans.monthly_avg_value(files["typed"]))
    assert "IsNotNull(value)" in text and "IsNotNull(ts)" in text
    assert "ReadSchema: struct<value:decimal(38,0),ts:bigint>" in text


@pytest.mark.parametrize("kind", ["tx", "typed"])
def test_no_python_in_any_report(files, kind):
    for df in (
        plans.monthly_count(files[kind]),
        plans.top_gas_months(files[kind], files["ct"]),
        plans.top_addresses_by_value(files[kind], files["ct"]),
        plans.top_scam_ids(files[kind], files["sc"]),
        plans.scam_series(files[kind], files["sc"], "Phishing"),
    ):
        text = plan(df)
        assert "Python" not in text and "Pandas" not in text
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_top_k_needs_no_global_sort(files):
    text = plan(plans.top_addresses_by_value(files["tx"], files["ct"]))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def joined(files, limit):
    rows = pick(files["tx"], TRANSACTIONS, "address", "value")
    listed = pick(files["sc"], SCAMS, "id", "address")
    return ops.matched_totals(rows, listed, "address", "value", [], ["id"], limit)


def test_small_list_is_joined_inside_the_scan_stage(files):
    text = plan(joined(files, None))
    # Printed top down: no exchange of facts between the join and the scan of the transactions.
    facts = text[text.index("BroadcastHashJoin") : text.index("BroadcastExchange")]
    assert "Exchange" not in facts and "FileScan" in facts
    assert text.index("partial_sum") < text.index("BroadcastHashJoin")
    assert "LeftSemi" not in text and "SortMergeJoin" not in text


def test_many_labels_per_key_meet_facts_already_summed(lines):
    many = lines(*[scam(str(i)) for i in range(20)])
    rows = pick(lines(tx()), TRANSACTIONS, "address", "value")
    listed = pick(many, SCAMS, "id", "address")
    text = plan(ops.matched_totals(rows, listed, "address", "value", [], ["id"]))
    first_join, sums, semi = (text.index(t) for t in ("Inner", "partial_try_sum(sum_amount", "LeftSemi"))
    assert first_join < sums < semi and "SortMergeJoin" not in text


def test_large_list_meets_facts_already_summed(files):
    text = plan(joined(files, 0))
    assert "Broadcast" not in text and "LeftSemi" not in text
    assert text.index("SortMergeJoin") < text.index("partial_try_sum(sum_amount")


def gas(files, limit):
    rows = pick(files["tx"], TRANSACTIONS, "address", "gas_used", "ts")
    listed = pick(files["ct"], CONTRACTS, "address")
    return ops.matched_totals(rows, listed, "address", "gas_used", ["ts"], broadcast_bytes=limit)


def test_large_list_without_labels_shuffles_facts_once(files):
    text = plan(gas(files, 0))
    # Printed top down: the sums of the result, the join, and one exchange by address on either side.
    assert text.index("partial_sum") < text.index("SortMergeJoin") and "Broadcast" not in text
    joined = text[text.index("SortMergeJoin") :]
    assert joined.count("Exchange hashpartitioning(address") == joined.count("Exchange") == 2
    # The counted list is aggregated in its exchange; facts are not aggregated before they meet it.
    assert joined.count("HashAggregate") == 2


def stages_of(spark, action):
    """Stages of each job that the action runs."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, "counted")
    try:
        action()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    return [len(tracker.getJobInfo(i).stageIds) for i in tracker.getJobIdsForGroup(group)]


def test_a_clearly_large_list_is_not_measured(spark, files, tmp_path):
    (tmp_path / "ct.csv").write_text("\n".join(contract(f"0x{i}") for i in range(2000)))
    large = {**files, "ct": read_lines(spark, str(tmp_path / "ct.csv"))}
    assert stages_of(spark, lambda: gas(large, 1000)) == []
    assert stages_of(spark, lambda: gas(large, 0)) == []
    assert "SortMergeJoin" in plan(gas(large, 1000))


def test_a_list_without_labels_is_measured_without_a_grouping(spark, files, tmp_path):
    """The rows as they stand are a bound; only one over the limit makes a grouping worth while."""
    jobs = stages_of(spark, lambda: gas(files, None))
    assert len(jobs) <= 2 and max(jobs) <= 2  # the rows, and their sum in one more stage
    (tmp_path / "ct.csv").write_text("\n".join(contract("0xa") for _ in range(30)))
    again = {**files, "ct": read_lines(spark, str(tmp_path / "ct.csv"))}
    assert "BroadcastHashJoin" in plan(gas(again, 1500))  # 30 rows are over it, one counted key is not


def test_contracts_only_filters_sums_without_moving_them_again(files):
    text = plan(plans.top_addresses_by_value(files["tx"], files["ct"], contracts_only=True))
    assert "Broadcast" not in text
    # One exchange for the sums, one for the listed keys.
    assert text.count("Exchange hashpartitioning") == 2


def test_contract_markers_add_no_second_shuffle(files):
    text = plan(plans.top_addresses_by_value(files["tx"], files["ct"]))
    assert text.count("Exchange hashpartitioning") == 1


def test_contract_payload_is_not_carried(files):
    text = plan(plans.monthly_avg_contract_gas(files["tx"], files["ct"]))
    assert "byte" not in text
    assert CONTRACTS.columns == ["address", "byte"]
