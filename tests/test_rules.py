"""One case per rule where the two families of queries treat null, ties or repeats differently."""

import datetime as dt

import pytest
from conftest import ledger, records, transactions
from pyspark.sql import functions as F

from sparkrecon.functions import money_net, money_sum
from sparkrecon.operators import checks, dq, ingest, recon_sql, reconcile, report
from sparkrecon.params import Rules

RULES = Rules(as_of=dt.date(2024, 6, 1))


def frame(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


def count(df, rule, rules=RULES):
    (row,) = records(dq.count_rule(df, rule, rules))
    return row["failing_rows"], row["result"]


def test_null_is_outside_a_list_in_checks_but_unknown_in_the_catalogue(spark, clean_source):
    df = clean_source.withColumns({"currency": F.lit(None).cast("string"), "entity": F.lit(None).cast("string")})
    (row,) = records(checks.check_source(df, only="s07"))
    assert row["rows_failed"] == 5
    assert count(df, "dq5c_entity") == (0, "PASS")


def test_null_account_fails_the_check_only(spark, clean_source):
    df = clean_source.withColumn("gl_account", F.lit(None).cast("string"))
    (row,) = records(checks.check_source(df, only="s09"))
    assert row["rows_failed"] == 5
    assert count(df, "dq5a_gl") == (0, "PASS")


def test_null_rate_on_home_currency(spark, clean_source):
    df = clean_source.withColumn("exchange_rate", F.lit(None).cast("double"))
    found = {r["metric"]: r["value"] for r in records(ingest.validate_source(df))}
    assert found["bad_gbp_exchange_rate"] == 3
    (row,) = records(checks.check_source(df, only="s08"))
    assert row["rows_failed"] == 3


def test_four_duplicate_counts(spark):
    ids = ["A", "A", "A", "B", None, None]
    s = transactions(spark, [(i, "4100", "IT", 1.0, 0.0, "GBP", 1.0, "u") for i in ids])
    extras = {r["metric"]: r["value"] for r in records(ingest.validate_source(s))}
    assert extras["duplicate_transaction_ids"] == 3  # two of A, one of null
    (members,) = records(checks.check_source(s, only="s02"))
    assert members["rows_failed"] == 5
    assert count(s, "dq2a_duplicate_transaction_id") == (4, "FAIL")  # both nulls count
    groups = [(r["transaction_id"], r["occurrence_count"]) for r in records(dq.duplicate_audit(s))]
    assert groups == [("A", 3), (None, 2)]


def test_unparsable_dates_and_lag(spark):
    days = [
        ("2023-01-10", "2023-01-09"),  # before
        ("2023-01-10", "2023-01-17"),  # 7 days: allowed
        ("2023-01-10", "2023-01-18"),  # 8 days
        ("10/01/2023", "2023-01-01"),
        ("2023-01-10", None),
    ]
    s = frame(spark, "transaction_date STRING, posting_date STRING", *days)
    both = dict.fromkeys(
        ["transaction_id", "gl_account", "currency", "approved_by"], F.lit("x")
    ) | dict.fromkeys(["debit_amount", "credit_amount", "exchange_rate"], F.lit(1.0))
    s = s.withColumns(both)
    found = [records(checks.check_source(s, only=c))[0]["rows_failed"] for c in ("s10", "s11")]
    assert found == [1, 1]
    (row,) = records(checks.check_source(s, Rules(date_format="d/M/yyyy"), only="s10"))
    assert row["rows_failed"] == 0


def test_text_amounts_are_parsed_and_filled(spark):
    s = frame(spark, "transaction_id STRING, debit_amount STRING, credit_amount STRING",
              ("A", " 12 ", "bad"), ("B", None, "1e400"))
    found = records(checks.for_checks(s))
    assert [(r["debit_amount"], r["credit_amount"]) for r in found] == [(12.0, 0.0), (0.0, 0.0)]


def test_null_keys_match_or_not(spark):
    s = transactions(spark, [(None, "4100", "IT", 1.0, 0.0, "GBP", 1.0, "u")] * 2)
    t = ledger(spark, [(None, 1.0, 0.0)])
    match = records(reconcile.reconcile(s, t))
    assert [r["reconciliation_status"] for r in match] == ["MATCHED"] * 2
    never = sorted(r["reconciliation_status"] for r in records(reconcile.reconcile(s, t, null_keys="never")))
    assert never == ["MISSING_IN_SOURCE", "MISSING_IN_TARGET", "MISSING_IN_TARGET"]
    # In the SQL form a row without a key is labelled by its missing key, on either side.
    sql = [r["reconciliation_status"] for r in records(recon_sql.detail(s, t))]
    assert sql == ["MISSING_IN_SOURCE"] * 3


def test_presence_does_not_depend_on_amounts(spark):
    s = transactions(spark, [("A", "4100", "IT", None, None, "GBP", 1.0, "u")])
    (row,) = records(reconcile.reconcile(s, ledger(spark, [("A", 5.0, 0.0)])))
    assert (row["reconciliation_status"], row["debit_delta"]) == ("AMOUNT_DISCREPANCY", -5.0)


def test_null_amount_never_differs_in_sql_form(spark):
    s = transactions(spark, [("A", "4100", "IT", None, 1.0, "GBP", 1.0, "u")])
    t = ledger(spark, [("A", 5.0, 1.0)])
    (row,) = records(recon_sql.detail(s, t))
    assert (row["reconciliation_status"], row["debit_delta"]) == ("MATCHED", 5.0)
    assert recon_sql.amount_discrepancies(s, t).count() == 0


def test_deltas_are_signed_or_absolute(spark):
    s = transactions(spark, [("A", "4100", "IT", 1.0, 0.0, "GBP", 1.0, "u"),
                             ("B", "4100", "IT", 2.5, 0.0, "GBP", 1.0, "u")])
    t = ledger(spark, [("A", 3.0, 0.0)])
    signed = {r["key"]: r["debit_delta"] for r in records(reconcile.reconcile(s, t))}
    absolute = {r["key"]: r["debit_delta"] for r in records(recon_sql.detail(s, t))}
    assert (signed, absolute) == ({"A": -2.0, "B": None}, {"A": 2.0, "B": 2.5})


def test_repeated_keys_fan_out(spark):
    s = transactions(spark, [("A", "4100", "IT", 1.0, 0.0, "GBP", 1.0, "u")] * 3)
    t = ledger(spark, [("A", 1.0, 0.0), ("A", 9.0, 0.0)])
    (row,) = records(reconcile.summarize(reconcile.reconcile(s, t)))
    assert (row["matched"], row["amount_discrepancies"]) == (3, 3)


def test_three_rates(spark):
    s = transactions(spark, [(k, "4100", "IT", 1.0, 0.0, "GBP", 1.0, "u") for k in "ABCD"])
    t = ledger(spark, [("A", 1.0, 0.0), ("B", 2.0, 0.0), ("X", 1.0, 0.0)])
    (filled,) = records(reconcile.summarize(reconcile.reconcile(s, t)))
    (joined,) = records(recon_sql.kpis(s, t))
    (keys,) = records(dq.recon_summary(s, t.withColumnRenamed("ledger_transaction_id", "source_ref")))
    rates = (filled["reconciliation_rate_pct"], joined["reconciliation_rate_pct"], keys["recon_rate_pct"])
    assert rates == (25.0, 20.0, 50.0)


def test_two_ledger_sizes(spark):
    s = transactions(spark, [(k, "4100", "IT", 1.0, 0.0, "GBP", 1.0, "u") for k in "ABCD"])
    t = ledger(spark, [("A", 1.0, 0.0), ("X", 1.0, 0.0), ("Y", 1.0, 0.0)])
    summary = reconcile.summarize(reconcile.reconcile(s, t))
    (row,) = records(reconcile.ledger_entries(summary))
    assert row["ledger_entries"] == 3
    assert records(report.kpi_tiles(summary))[1]["value"] == "1"


def test_orphans_have_no_account_and_are_not_counted(spark):
    s = transactions(spark, [("A", "4100", "IT", 1.0, 0.0, "GBP", 1.0, "u"),
                             ("B", None, "IT", 1.0, 0.0, "GBP", 1.0, "u"),
                             (None, "9999", "IT", 3.0, 0.0, "GBP", 1.0, "u")])
    t = ledger(spark, [("A", 1.0, 0.0), ("X", 1.0, 0.0)])
    detail = reconcile.reconcile(s, t)
    rows = {r["gl_account"]: r for r in records(report.gl_analysis(s, detail))}
    assert set(rows) == {"4100", "9999"}
    assert rows["4100"]["discrepancies"] == 0
    assert (rows["9999"]["transactions"], rows["9999"]["discrepancies"]) == (0, 1)
    assert rows["9999"]["account_name"] == "Unknown"
    register = {r["transaction_id"]: r for r in records(report.discrepancy_register(detail))}
    assert register["X"]["gl_account"] is None and register["X"]["fill"] == "FFEB9C"


def test_warnings(spark, clean_source):
    zero = clean_source.withColumn("debit_amount", F.lit(0.0))
    assert count(zero, "dq3d_zero_value") == (5, "WARNING")
    assert count(clean_source, "dq3d_zero_value") == (0, "PASS")


@pytest.mark.parametrize(("day", "failing"), [("2024-06-01", 0), ("2024-06-02", 1)])
def test_future_posting(spark, day, failing):
    df = frame(spark, "posting_date DATE", (dt.date.fromisoformat(day),))
    assert count(df, "dq4a_future_posting")[0] == failing


@pytest.mark.parametrize(("value_day", "failing"), [("2024-05-02", 0), ("2024-05-01", 1), ("2024-07-01", 0)])
def test_value_date_lag_is_posting_less_value(spark, value_day, failing):
    df = frame(spark, "posting_date DATE, value_date DATE",
               (dt.date(2024, 6, 1), dt.date.fromisoformat(value_day)))
    assert count(df, "dq4b_value_date_lag")[0] == failing


@pytest.mark.parametrize(
    ("day", "failing"), [("2023-12-31", 1), ("2024-01-01", 0), ("2024-12-31", 0), ("2025-01-01", 1), (None, 0)]
)
def test_fiscal_window(spark, day, failing):
    df = frame(spark, "posting_date DATE", (day and dt.date.fromisoformat(day),))
    assert count(df, "dq4c_out_of_period")[0] == failing


@pytest.mark.parametrize(("day", "status"), [("2024-05-31", "CURRENT"), ("2024-05-30", "STALE — CHECK FEED")])
def test_freshness(spark, day, status):
    df = frame(spark, "posting_date DATE", (dt.date.fromisoformat(day),), (dt.date(2020, 1, 1),))
    assert [r["freshness_status"] for r in records(recon_sql.freshness(df, df, RULES))] == [status] * 2


def test_freshness_of_an_empty_table(spark):
    df = frame(spark, "posting_date DATE")
    assert records(recon_sql.freshness(df, df, RULES))[0]["freshness_status"] == "CURRENT"


def test_limits_are_strict(spark, clean_source):
    at = clean_source.withColumn("debit_amount", F.lit(1_000_000.0))
    assert records(checks.check_source(at, only="s06"))[0]["rows_failed"] == 0
    over = clean_source.withColumn("credit_amount", F.lit(1_000_000.01))
    assert records(checks.check_source(over, only="s06"))[0]["rows_failed"] == 5


def test_larger_amount_skips_null(spark):
    df = frame(spark, "debit_amount DOUBLE, credit_amount DOUBLE, transaction_id STRING, "
               "transaction_type STRING, description STRING", (None, 600_000.0, "A", "INVOICE", "d"))
    assert dq.outliers(df).count() == 1


def test_nothing_to_divide_by(spark):
    empty = frame(spark, "transaction_id STRING, source_ref STRING, debit_amount DOUBLE, credit_amount DOUBLE, "
                  "ledger_transaction_id STRING")
    assert records(dq.recon_summary(empty, empty))[0]["recon_rate_pct"] is None
    assert records(recon_sql.kpis(empty, empty))[0]["reconciliation_rate_pct"] is None
    assert records(recon_sql.balance(empty, empty))[0]["total_debits"] is None
    assert records(reconcile.key_match_rate(empty, empty))[0]["match_rate_pct"] == 0.0


def test_rounding_is_half_away_from_zero(spark):
    df = spark.range(800).select((F.col("id") == 0).alias("bad"))
    check = checks.Check("one in 800", "source", failing=F.col("bad"))
    assert records(checks.run_checks(df, [check], "now"))[0]["failure_pct"] == 0.13


def test_money_sums_do_not_depend_on_order(spark):
    values = [0.1, 1e9 + 0.01, -1e9, 0.2, 1234567.89, -0.3, None]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    for parts in (1, 3, 7):
        (row,) = records(df.repartition(parts).agg(money_sum(F.col("v")).alias("s")))
        assert row["s"] == 1234567.9


def test_money_sums_of_large_and_missing_values(spark):
    df = spark.createDataFrame([(1e20, 0.1), (5.0, None), (-1e20, 0.2)], "a DOUBLE, b DOUBLE")
    (row,) = records(df.agg(money_sum(F.col("a")).alias("a"), money_net(F.col("b"), F.col("a")).alias("n")))
    assert (row["a"], row["n"]) == (5.0, pytest.approx(-4.7))
    (row,) = records(df.filter("b > 9").agg(money_sum(F.col("a")).alias("a")))
    assert row["a"] is None
    (row,) = records(df.filter("a > 9").agg(money_sum(F.col("a")).alias("a")))
    assert row["a"] == 1e20


def test_balance_limit_is_exact(spark):
    """A gap of one cent is not below one cent, however large the totals."""
    rows = [("E", 1e9 + 0.01, 0.0), ("E", 0.0, 1e9), ("F", 1e9 + 0.009, 0.0), ("F", 0.0, 1e9)]
    df = frame(spark, "entity STRING, debit_amount DOUBLE, credit_amount DOUBLE", *rows)
    found = {r["entity"]: (r["imbalance"], r["balance_status"]) for r in records(dq.entity_balance(df))}
    assert found == {"E": (0.01, "IMBALANCED"), "F": (0.01, "BALANCED")}


def test_batches(spark):
    rows = [("B1", "JOURNAL", 5.0, 0.0), ("B1", "JOURNAL", 0.0, 5.0), ("B2", "JOURNAL", 5.0, 0.0),
            ("B3", "INVOICE", 5.0, 0.0), (None, "JOURNAL", 1.0, 0.0)]
    df = frame(spark, "batch_id STRING, transaction_type STRING, debit_amount DOUBLE, credit_amount DOUBLE", *rows)
    assert [(r["batch_id"], r["imbalance"]) for r in records(dq.batch_integrity(df))] == [("B2", 5.0), (None, 1.0)]
    assert [r["batch_id"] for r in records(dq.singleton_batches(df))] == [None, "B2", "B3"]


def test_catalogue_columns(spark):
    df = frame(spark, "erp_batch_id STRING", ("B",))
    assert records(dq.catalogue_columns(df, batch_id="erp_batch_id")) == [{"erp_batch_id": "B", "batch_id": "B"}]
