"""Checks and reconciliation on the three small frames."""

from conftest import ledger, records, transactions

from sparkrecon.operators import checks, ingest, reconcile


def metrics(df):
    return {r["metric"]: r["value"] for r in records(df)}


def failed(df):
    return {r["check_name"][:6]: r["rows_failed"] for r in records(df)}


def test_no_nulls_in_clean_source(clean_source):
    found = metrics(ingest.validate_source(clean_source))
    assert [v for k, v in found.items() if k.startswith("null_")] == [0] * 5


def test_nulls_are_found(faulty_source):
    found = metrics(ingest.validate_source(faulty_source))
    assert (found["null_transaction_id"], found["null_debit_amount"]) == (1, 1)


def test_all_members_of_a_duplicate_fail(faulty_source):
    assert failed(checks.check_source(faulty_source, only="s02")) == {"QC-S02": 2}


def test_no_duplicates_in_clean_source(clean_source):
    assert failed(checks.check_source(clean_source, only="s02")) == {"QC-S02": 0}


def test_negative_amount(faulty_source):
    assert failed(checks.check_source(faulty_source, only="s05")) == {"QC-S05": 1}


def test_both_zero_depends_on_the_fill(faulty_source):
    assert failed(checks.check_source(faulty_source, only="s03")) == {"QC-S03": 2}
    assert metrics(ingest.validate_source(faulty_source))["both_amounts_zero"] == 1


def test_high_value_without_approver(faulty_source):
    assert failed(checks.check_source(faulty_source, only="s12")) == {"QC-S12": 1}


def test_invalid_currency(faulty_source):
    assert failed(checks.check_source(faulty_source, only="s07")) == {"QC-S07": 1}


def test_home_currency_rate(clean_source):
    assert failed(checks.check_source(clean_source, only="s08")) == {"QC-S08": 0}


def test_match_rate(clean_source, clean_target):
    (row,) = records(reconcile.key_match_rate(clean_source, clean_target))
    assert row == {"source_keys": 5, "matched_keys": 3, "match_rate_pct": 60.0}


def test_missing_in_target(clean_source, clean_target):
    off = reconcile.discrepancies(reconcile.reconcile(clean_source, clean_target))
    assert {r["key"] for r in records(off)} == {"TXN004", "TXN005"}
    assert {r["reconciliation_status"] for r in records(off)} == {"MISSING_IN_TARGET"}


def one_pair(spark, source_amount, target_amount):
    s = transactions(spark, [("A", "4100", "IT", source_amount, 0.0, "GBP", 1.0, "u")])
    (row,) = records(reconcile.reconcile(s, ledger(spark, [("A", target_amount, 0.0)])))
    return row["reconciliation_status"], row["debit_delta"]


def test_discrepancy_above_tolerance(spark):
    assert one_pair(spark, 500.05, 500.0) == ("AMOUNT_DISCREPANCY", 0.05)


def test_difference_within_tolerance(spark):
    assert one_pair(spark, 500.009, 500.0) == ("MATCHED", 0.009)


def test_tolerance_compares_binary_doubles(spark):
    assert one_pair(spark, 1.01, 1.00)[0] == "AMOUNT_DISCREPANCY"
    assert one_pair(spark, 500.01, 500.00)[0] == "MATCHED"


def test_ledger_status(clean_target):
    assert failed(checks.check_target(clean_target, only="t03")) == {"QC-T03": 0}


def test_no_duplicate_ledger_ids(clean_target):
    assert failed(checks.check_target(clean_target, only="t02")) == {"QC-T02": 0}


def test_all_source_checks_on_the_faulty_frame(faulty_source):
    found = list(failed(checks.check_source(faulty_source)).values())
    assert found == [1, 2, 2, 0, 1, 0, 1, 0, 1, 0, 0, 1]


def test_report_and_summary(faulty_source, clean_target):
    report = checks.quality_report(faulty_source, clean_target)
    rows = records(report)
    assert [r["check_name"][3:6] for r in rows] == [
        *[f"S{i:02d}" for i in range(1, 13)], "T01", "T02", "T03", "T04",
    ]
    assert rows[0]["failure_pct"] == 20.0 and rows[0]["status"] == "FAIL"
    (summary,) = records(checks.quality_summary(report))
    assert (summary["checks_run"], summary["passed"], summary["failed"]) == (16, 9, 7)
    assert summary["overall_status"] == "7 CHECKS FAILED"
    assert "[source] QC-S12: High-value (>£10K) with no approver (1 rows)" in summary["failed_checks"]


def test_all_clear(clean_source, clean_target):
    (summary,) = records(checks.quality_summary(checks.quality_report(clean_source, clean_target)))
    assert (summary["overall_status"], summary["failed_checks"]) == ("ALL CLEAR", "")


def test_empty_tables(spark, clean_source, clean_target):
    s, t = clean_source.limit(0), clean_target.limit(0)
    assert {(r["rows_failed"], r["total_rows"], r["failure_pct"]) for r in records(checks.quality_report(s, t))} == {
        (0, 0, 0.0)
    }
    assert set(metrics(ingest.validate_source(s)).values()) == {0}
    (summary,) = records(ingest.financial_summary(s, ingest.validate_source(s), "source"))
    assert (summary["total_debit"], summary["net_balance"], summary["checks_flagged"]) == (0.0, 0.0, 0)
    (kpis,) = records(reconcile.summarize(reconcile.reconcile(s, t)))
    assert set(kpis.values()) == {0, 0.0}
