"""The stages end to end, from CSV files to CSV and parquet results."""

import csv
import glob

import pytest
from conftest import SMALL, records
from pyspark.sql import functions as F

from sparkrecon import __main__ as cli
from sparkrecon.fixtures import FIXTURE_RULES, view
from sparkrecon.operators import dq, recon_sql, reconcile
from sparkrecon.params import Rules
from sparkrecon.plans import stages
from sparkrecon.schemas import SOURCE_SCHEMA, TARGET_SCHEMA
from sparkrecon.sources import shared_folder, written


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """Both fixture views as CSV files, columns in another order than the schema."""
    folder = tmp_path_factory.mktemp("csv")
    for name in ("source_transactions", "target_ledger"):
        df = view(spark, SMALL, name)
        stages.write_table(df.select(*sorted(df.columns)), str(folder / name), "csv")
    return str(folder / "source_transactions"), str(folder / "target_ledger")


def rows_of(folder):
    found = []
    for path in glob.glob(f"{folder}/*.csv"):
        with open(path, encoding="utf-8") as f:
            found += list(csv.DictReader(f))
    return found


@pytest.mark.parametrize("detail_fmt", ["parquet", "csv"])
def test_all_stages(spark, tmp_path, inputs, detail_fmt):
    out = str(tmp_path / "out")
    job = stages.Job(spark, *inputs, out, "csv", detail_fmt, FIXTURE_RULES)
    results = stages.run_all(job)

    s, t = (view(spark, SMALL, n) for n in ("source_transactions", "target_ledger"))
    detail = reconcile.reconcile(s, t, FIXTURE_RULES)
    (want,) = records(reconcile.summarize(detail))
    (row,) = rows_of(f"{out}/reconciliation_summary")
    assert {k: float(v) for k, v in row.items()} == {k: float(v) for k, v in want.items()}

    checks = rows_of(f"{out}/quality_check_report")
    assert len(checks) == 16
    assert list(checks[0]) == [
        "dataset", "check_name", "status", "rows_failed", "total_rows", "failure_pct", "run_timestamp",
    ]
    assert "QC-S06: Amount > £1,000,000" in {c["check_name"] for c in checks}
    assert len(rows_of(f"{out}/report_discrepancy_register")) == want["total_discrepancies"]
    assert "ERP Debit (£)" in rows_of(f"{out}/report_discrepancy_register")[0]
    trail = {r["stage"]: r for r in rows_of(f"{out}/report_audit_trail")}
    assert len(trail) == 14 and trail["Data Ingestion — target ledger"]["notes"] == f"{t.count():,} rows loaded"
    assert trail["Reconciliation Join"]["notes"] == f"{detail.count():,} rows of a full outer join on transaction_id"
    assert trail["Governance Report Generation"]["notes"] == f"5 tables written, {want['total_discrepancies']:,} discrepancies listed"
    plan = results["report_audit_trail"]._jdf.queryExecution().optimizedPlan().toString()
    assert "landing" not in plan
    failed = sum(c["status"] == "FAIL" for c in checks if c["dataset"] == "source")
    assert trail["Quality Checks — Source"]["notes"] == f"12 checks run, {failed} failed"
    assert {r["kind"] for r in rows_of(f"{out}/schema_diff")} == {"missing", "extra"}
    assert len(rows_of(f"{out}/ingestion_metrics_source")) == 11
    assert results["report_discrepancy_register"].count() == want["total_discrepancies"]
    if detail_fmt == "csv":
        assert len(rows_of(f"{out}/reconciliation_detail")) == detail.count()
        assert list(rows_of(f"{out}/discrepancies")[0]) == reconcile.DETAIL_COLUMNS


def test_checks_read_csv_and_landed_tables_alike(spark, tmp_path, inputs):
    job = stages.Job(spark, *inputs, str(tmp_path / "out"), rules=FIXTURE_RULES)
    landed = stages.run_ingestion(job)
    assert landed.fmt == "parquet"
    assert records(stages.run_checks(job)) == records(stages.run_checks(landed))


def test_report_runs_the_reconciliation_if_needed(spark, tmp_path, inputs):
    job = stages.Job(spark, *inputs, str(tmp_path / "out"), rules=FIXTURE_RULES)
    stages.run_report(job)
    assert len(rows_of(f"{job.out}/reconciliation_summary")) == 1
    assert len(rows_of(f"{job.out}/report_kpis")) == 4


def test_command_line(spark, tmp_path, inputs, capsys):
    where = ["--source", inputs[0], "--target", inputs[1], "--out", str(tmp_path / "out")]
    cli.main(["check", *where])
    assert "QC-T04" in capsys.readouterr().out
    cli.main(["reconcile", *where, "--null-keys", "never"])
    assert "total_source_transactions" in capsys.readouterr().out
    cli.main(["report", *where])
    assert "Net Debit Delta" in capsys.readouterr().out
    with pytest.raises(FileNotFoundError, match="source transactions"):
        cli.main(["ingest", "--source", "/nowhere.csv", *where[2:]])


def test_query_catalogues_on_csv(spark, tmp_path, inputs):
    """Inputs from CSV have text dates; the queries give the results of the typed views."""
    job = stages.Job(spark, *inputs, str(tmp_path / "out"), rules=FIXTURE_RULES)
    names = stages.run_queries(job)
    assert [n[:3] for n in names[:8]] == [f"rq{i}" for i in range(1, 9)]
    # The documented columns are enough for most of the catalogue; the rest is listed with its reason.
    lacking = {r["rule"]: r["missing_columns"] for r in spark.read.parquet(f"{job.out}/queries/dq_not_run").collect()}
    assert lacking["dq6b_orphan_target"] == "target_ledger.net_amount"
    assert set(names[8:]) == {
        "dq_report", "dq2b_duplicate_audit", "dq3c_outliers", "dq6d_recon_summary", "dq7b_batch_integrity",
        "dq8b_singleton_batch", "dq7a_entity_balance", "dq_not_run",
    }
    done = {r["check_name"] for r in spark.read.parquet(f"{job.out}/queries/dq_report").collect()}
    assert {"MISSING_VENDOR_ON_INVOICE", "DUPLICATE_TRANSACTION_ID", "FUTURE_POSTING_DATE"} <= done
    assert set(lacking) == {
        "dq3b_net_amount", "dq6a_missing_from_target", "dq6b_orphan_target", "dq6c_value_discrepancy"
    }
    # Two counting rules share a name; each of those that ran has its line.
    assert spark.read.parquet(f"{job.out}/queries/dq_report").count() == 15 - sum(k in dq.COUNT_RULES for k in lacking)
    pair = [view(spark, SMALL, n) for n in ("source_transactions", "target_ledger")]
    for name, want in recon_sql.all_queries(*pair, FIXTURE_RULES).items():
        got = spark.read.parquet(f"{job.out}/queries/{name}")
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), name


def test_rule_catalogue_runs_if_its_columns_are_there(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("s", "t")]
    for name, path in zip(("dq_source", "dq_target"), paths):
        view(spark, SMALL, name).write.parquet(path)
    job = stages.Job(spark, *paths, str(tmp_path / "out"), "parquet", rules=FIXTURE_RULES)
    names = stages.run_queries(job)
    assert len(names) == 19 and spark.read.parquet(f"{job.out}/queries/dq_not_run").count() == 0
    assert spark.read.parquet(f"{job.out}/queries/dq_report").count() == 15


def test_written_tables_go_to_the_shared_folder(spark):
    df = written(spark.range(5).withColumn("x", F.lit("a")), "test")
    assert sorted(r["id"] for r in df.collect()) == [0, 1, 2, 3, 4]
    (path,) = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    assert shared_folder(spark) in path


def test_the_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_rules_that_lack_columns_are_listed(spark):
    """Tables of the documented schemas only: every rule is either run or listed with its reason."""
    source = spark.createDataFrame([], SOURCE_SCHEMA)
    target = spark.createDataFrame([], TARGET_SCHEMA)
    found = dq.all_rules(*dq.with_catalogue_names(dq.with_dates(source), dq.with_dates(target)))
    lacking = {r["rule"]: r["missing_columns"] for r in records(found["dq_not_run"])}
    assert lacking["dq1b_null_mandatory_target"] == "target_ledger.ledger_id"
    assert lacking["dq4b_value_date_lag"] == "source_transactions.value_date"
    assert lacking["dq7a_entity_balance"] == lacking["dq5c_entity"] == "source_transactions.entity"
    run = set(found) - {"dq_report", "dq_not_run"}
    assert run == {"dq2b_duplicate_audit", "dq3c_outliers", "dq6d_recon_summary", "dq7b_batch_integrity", "dq8b_singleton_batch"}
    assert run | {k for k in lacking if k not in dq.COUNT_RULES} == set(dq._NEEDS)
    assert found["dq_report"].count() == len(dq.COUNT_RULES) - sum(k in dq.COUNT_RULES for k in lacking)


def test_rules_from_the_command_line(spark, tmp_path, inputs):
    path = tmp_path / "rules.json"
    path.write_text('{"tolerance": 1e9, "fiscal_start": "1990-01-01", "fiscal_end": "2100-12-31", "as_of": "2100-01-01"}')
    where = ["--source", inputs[0], "--target", inputs[1], "--out", str(tmp_path / "out")]
    cli.main(["reconcile", *where, "--rules", str(path)])
    (row,) = spark.read.csv(str(tmp_path / "out" / "reconciliation_summary"), header=True).collect()
    assert row["amount_discrepancies"] == "0" and row["matched"] != "0"
    cli.main(["queries", *where, "--rules", str(path)])
    found = spark.read.parquet(str(tmp_path / "out" / "queries" / "dq_report")).collect()
    counts = {r["check_name"]: r["failing_rows"] for r in found}
    assert counts["OUT_OF_PERIOD_TRANSACTIONS"] == counts["FUTURE_POSTING_DATE"] == 0
    with pytest.raises(ValueError, match="unknown rules: tolerence"):
        Rules.from_json('{"tolerence": 1}')


def test_discrepancies_are_written_in_key_order(spark, tmp_path, inputs):
    job = stages.Job(spark, *inputs, str(tmp_path / "out"), "csv", "csv", FIXTURE_RULES)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stages.run_reconciliation(job)
        stages.run_report(job)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for table, key in (("discrepancies", "key"), ("report_discrepancy_register", "Transaction ID")):
        files = sorted(glob.glob(f"{job.out}/{table}/*.csv"))
        assert len(files) > 1
        keys = []
        for path in files:
            with open(path, encoding="utf-8") as f:
                keys += [r[key] for r in csv.DictReader(f)]
        known = [k for k in keys if k]
        assert known == sorted(known) and keys == known + [""] * (len(keys) - len(known)) and len(keys) > len(known)


def test_report_takes_no_detail_of_other_rules_or_inputs(spark, tmp_path, inputs):
    out = str(tmp_path / "out")
    where = ["--source", inputs[0], "--target", inputs[1], "--out", out]
    rules = tmp_path / "rules.json"
    rules.write_text('{"tolerance": 1e9}')

    def statement():
        return {r["item"].strip(): r["count"] for r in rows_of(f"{out}/report_statement")}

    cli.main(["reconcile", *where])
    made = stages.Job(spark, *inputs, out).run().facts("reconciliation")
    cli.main(["report", *where])
    assert stages.Job(spark, *inputs, out).run().facts("reconciliation") == made
    assert statement()["Of which: Amount Discrepancy"] != "0"
    cli.main(["report", *where, "--rules", str(rules)])
    assert statement()["Of which: Amount Discrepancy"] == "0"
    assert stages.Job(spark, *inputs, out).run().facts("reconciliation")["fingerprint"] != made["fingerprint"]
    # Other inputs in the same folder.
    half = str(tmp_path / "half")
    stages.write_table(spark.read.csv(inputs[0], header=True).filter("transaction_id < 'TXN3'"), half, "csv")
    cli.main(["report", "--source", half, *where[2:]])
    (summary,) = rows_of(f"{out}/reconciliation_summary")
    assert statement()["Total Source Transactions (ERP)"] == summary["total_source_transactions"]
    # A reconciliation that has not ended is none.
    stages.Job(spark, half, inputs[1], out).run().begin("reconciliation")
    assert stages.Job(spark, half, inputs[1], out).run().facts("reconciliation") == {}


def test_a_report_alone_says_what_did_not_run(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("s", "t")]
    for name, path in zip(("source_transactions", "target_ledger"), paths):
        view(spark, SMALL, name).write.parquet(path)
    job = stages.Job(spark, *paths, str(tmp_path / "out"), "parquet", rules=FIXTURE_RULES)
    trail = {r["stage"]: r for r in records(stages.run_report(job)["report_audit_trail"])}
    assert trail["Data Ingestion — source transactions"]["status"] == "NOT RUN"
    assert trail["Quality Checks — Source"]["status"] == "NOT RUN"
    stages.run_ingestion(job)
    trail = {r["stage"]: r for r in records(stages.run_report(job)["report_audit_trail"])}
    assert trail["Data Ingestion — source transactions"]["notes"] == f"{job.source().count():,} rows loaded"
