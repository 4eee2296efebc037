"""Shape of the physical plans."""

import re

import pytest
from conftest import SMALL

import __spark_entry__ as entry
from sparkrecon.fixtures import view
from sparkrecon.operators import dq, recon_sql, reconcile, totals
from sparkrecon.plans import stages
from sparkrecon.sources import written

def plan(df):
    """The plan as it was run."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def scans(text):
    return re.findall(r"FileScan parquet.*?ReadSchema: struct<([^>]*)>", text)


@pytest.fixture(scope="module")
def run(spark):
    def of(key):
        return plan(entry.queries()[key](spark, SMALL))

    return of


def test_checks_share_one_scan_per_table(run):
    text = run("qc_report")
    columns = [s.split(",") for s in scans(text)]
    # Per table: one scan for all row checks, and one of the key column for the duplicates.
    assert len(columns) == 4
    assert sorted(len(c) for c in columns)[:2] == [1, 1]


def test_rule_catalogue_shares_scans(run):
    assert len(scans(run("dq_report"))) == 4


def test_detail_shuffles_each_side_once(spark, landed):
    """Without broadcasts: rows of both sides once, reused by the anti joins; and per side its keys,
    once to make them nearly distinct and once for the join."""
    source, target = landed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(reconcile.reconcile(source, target))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "FullOuter" not in text
    shuffles = re.findall(r"(Reused)?Exchange (?:\[[^]]*\], Exchange )?hashpartitioning", text)
    assert (shuffles.count(""), shuffles.count("Reused")) == (6, 2)
    assert all("description" not in s and "vendor_id" not in s for s in scans(text))


def test_totals_shuffle_each_side_once(spark, landed, monkeypatch):
    plans = []
    monkeypatch.setattr(totals, "written", lambda df, name: plans.append(df) or written(df, name))
    totals.reconcile_totals(*landed)
    text = plan(plans[0])
    # One shuffle per side, none for the join, one of the few groups that are left.
    assert text.count("Exchange hashpartitioning") == 3
    assert all(set(re.findall(r"(\w+):", s)) - {"debit_amount", "credit_amount"} in (
        {"transaction_id"}, {"ledger_transaction_id"}) for s in scans(text))


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Both views as the parquet tables that the ingest stage leaves behind."""
    folder = tmp_path_factory.mktemp("landed")
    frames = []
    for name in ("dq_source", "target_ledger"):
        path = str(folder / name)
        view(spark, SMALL, name).write.parquet(path)
        frames.append(spark.read.parquet(path))
    return frames


def test_predicates_and_columns_reach_the_scan(landed):
    source, target = landed
    text = plan(dq.batch_integrity(source))
    assert "EqualTo(transaction_type,JOURNAL)" in text
    (columns,) = scans(text)
    assert {c.split(":")[0] for c in columns.split(",")} == {
        "transaction_type", "batch_id", "debit_amount", "credit_amount",
    }
    assert "GreaterThan(debit_amount,500000.0)" in plan(dq.outliers(source))
    text = plan(recon_sql.amount_discrepancies(source, target))
    assert "IsNotNull(transaction_id)" in text and "IsNotNull(ledger_transaction_id)" in text


def test_a_written_detail_is_read_by_status(spark, tmp_path, landed):
    source, target = landed
    stages.write_table(
        reconcile.reconcile(source, target), str(tmp_path / "d"), "parquet", "reconciliation_status"
    )
    text = plan(reconcile.discrepancies(spark.read.parquet(str(tmp_path / "d"))))
    assert re.search(r"PartitionFilters: \[[^\]]*MATCHED", text)


def test_key_sets_read_only_keys(run):
    for key in ("key_match_rate", "dq6d_recon_summary"):
        assert {s for s in scans(run(key))} == {"o_orderkey:bigint"}
