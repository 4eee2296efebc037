"""Published result reconstructed: 13 discrepancies with known values plus 987 equal pairs."""

from conftest import records

from sparkrecon.operators import reconcile, report, totals

# The published discrepancies.
# id, account, department, day, currency, debit, credit, ledger debit, ledger credit, deltas
AMOUNTS = """
TXN000004 4000 Sales       2023-05-21 USD 0.0      3962.16 0.0      3962.49  0.0  -0.33
TXN000064 3100 Sales       2023-01-24 USD 67.07    0.0     66.68    0.0      0.39  0.0
TXN000164 3100 IT          2023-05-15 GBP 0.0      117.8   0.0      117.5    0.0   0.3
TXN000261 2000 Finance     2023-07-30 GBP 100.44   0.0     100.72   0.0     -0.28  0.0
TXN000447 3100 Procurement 2023-01-21 USD 699.17   0.0     699.42   0.0     -0.25  0.0
TXN000479 4000 Finance     2023-06-29 GBP 40876.93 0.0     40876.95 0.0     -0.02  0.0
"""
MISSING = """
TXN000051 4300 Operations  2023-10-02 GBP 0.0    655.98
TXN000249 2000 Legal       2023-10-23 GBP 0.0    5699.77
TXN000281 3100 Legal       2023-08-25 GBP 0.0    478.32
TXN000448 1200 HR          2023-07-03 USD 98.51  0.0
TXN000501 4200 Sales       2023-04-02 GBP 0.0    1618.52
TXN000502 3000 IT          2023-10-25 USD 7073.6 0.0
TXN000972 3100 IT          2023-05-03 GBP 0.0    145.25
"""
SUMMARY = {
    "total_source_transactions": 1000,
    "matched": 987,
    "missing_in_target": 7,
    "missing_in_source": 0,
    "amount_discrepancies": 6,
    "total_discrepancies": 13,
    "reconciliation_rate_pct": 98.7,
    "net_debit_delta_gbp": -0.16,
    "net_credit_delta_gbp": -0.03,
}
COLUMNS = (
    "gl_account STRING, department STRING, transaction_date STRING, currency STRING, "
    "debit_amount DOUBLE, credit_amount DOUBLE"
)


def lines(text):
    return [line.split() for line in text.strip().splitlines()]


def frames(spark):
    amounts, missing = lines(AMOUNTS), lines(MISSING)
    source = [(*r[:5], float(r[5]), float(r[6])) for r in amounts + missing]
    target = [(*r[:5], float(r[7]), float(r[8])) for r in amounts]
    same = [
        (f"SAME{i:04d}", "4100", "Finance", "2023-02-01", "GBP", i * 1.37 + 5, 0.0) for i in range(987)
    ]
    return (
        spark.createDataFrame(source + same, "transaction_id STRING, " + COLUMNS),
        spark.createDataFrame(target + same, "ledger_transaction_id STRING, " + COLUMNS),
    )


def test_discrepancies_and_their_deltas(spark):
    source, target = frames(spark)
    found = records(reconcile.discrepancies(reconcile.reconcile(source, target)))
    by_key = {r["key"]: r for r in found}
    assert len(found) == len(by_key) == 13
    for r in lines(AMOUNTS):
        row = by_key[r[0]]
        assert row["reconciliation_status"] == "AMOUNT_DISCREPANCY"
        assert (row["debit_delta"], row["credit_delta"]) == (float(r[9]), float(r[10]))
        assert (row["gl_account_src"], row["gl_account_tgt"]) == (r[1], r[1])
    for r in lines(MISSING):
        row = by_key[r[0]]
        assert row["reconciliation_status"] == "MISSING_IN_TARGET"
        assert (row["src_debit"], row["src_credit"]) == (float(r[5]), float(r[6]))
        assert {row[c] for c in ("tgt_debit", "gl_account_tgt", "debit_delta", "credit_delta")} == {None}


def test_detail_columns(spark):
    assert reconcile.reconcile(*frames(spark)).columns == [
        "key", "src_debit", "src_credit", "gl_account_src", "department_src",
        "transaction_date_src", "currency_src", "tgt_debit", "tgt_credit", "gl_account_tgt",
        "department_tgt", "transaction_date_tgt", "currency_tgt", "reconciliation_status",
        "debit_delta", "credit_delta",
    ]


def test_summary_both_ways(spark):
    source, target = frames(spark)
    assert records(totals.reconcile_totals(source, target)) == [SUMMARY]
    assert records(reconcile.summarize(reconcile.reconcile(source, target))) == [SUMMARY]


def test_report_tables(spark):
    source, target = frames(spark)
    detail = reconcile.reconcile(source, target)
    summary = totals.reconcile_totals(source, target)
    tiles = [(r["value"], r["rag"]) for r in records(report.kpi_tiles(summary))]
    assert tiles == [("1,000", None), ("993", None), ("98.7%", "GREEN"), ("13", "RED")]
    statement = [r["count"] for r in records(report.statement(summary))]
    assert statement == ["1000", "987", "7", "6", "0", "£-0.1600", "£-0.0300"]
    trail = records(report.audit_trail(summary, source, target))
    assert len(trail) == 14
    assert trail[0]["notes"] == "1,000 rows loaded" and trail[1]["notes"] == "993 rows loaded"
    # These frames have some of the documented columns only, and no check ran.
    assert trail[2]["status"] == "INCOMPLETE" and "missing: " in trail[2]["notes"]
    assert trail[4]["status"] == trail[5]["status"] == "NOT RUN"
    assert trail[6]["notes"] == "1,000 rows of a full outer join on transaction_id"
    assert trail[7]["notes"] == "13 discrepancies identified"
    assert (trail[8]["stage"], trail[8]["status"]) == ("Governance Report Generation", "NOT RUN")
    assert trail[9] == {"position": 10, "stage": "", "status": "", "timestamp": "", "notes": ""}
    register = records(report.discrepancy_register(detail))
    assert {(r["status"], r["fill"]) for r in register} == {
        ("AMOUNT_DISCREPANCY", "FCE4D6"),
        ("MISSING_IN_TARGET", "FFC7CE"),
    }
    accounts = {r["gl_account"]: r for r in records(report.gl_analysis(source, detail))}
    assert accounts["3100"]["discrepancies"] == 5 and accounts["3100"]["fill"] == "FFC7CE"
    assert (accounts["4100"]["discrepancies"], accounts["4100"]["fill"]) == (0, None)
    assert accounts["3100"]["account_name"] == "Other Income"
    assert (accounts["3100"]["total_debit"], accounts["3100"]["net_balance"]) == (766.24, 24.87)
