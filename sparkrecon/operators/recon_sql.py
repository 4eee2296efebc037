"""The reconciliation queries over typed tables, with SQL's treatment of null: a null key equals
nothing, a null amount never differs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exceeds
from ..params import (
    AMOUNT_DISCREPANCY,
    DEFAULT_RULES,
    MATCHED,
    MISSING_IN_SOURCE,
    MISSING_IN_TARGET,
    Rules,
)
from ..plans.skew import full_outer, plain_key, sorted_rows, tag_keys
from .dq import balance_columns, unmatched
from .reconcile import SOURCE_KEY, TARGET_KEY
from .totals import status_kpis

SYSTEMS = ("source_transactions", "target_ledger")


def row_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("system"), "record_count"
        )

    return counted(source, SYSTEMS[0]).unionByName(counted(target, SYSTEMS[1]))


def missing_in_target(source: DataFrame, target: DataFrame) -> DataFrame:
    columns = [
        "transaction_id", "transaction_date", "posting_date", "gl_account", "department",
        "debit_amount", "credit_amount", "currency", "transaction_type", "description",
    ]
    rows = unmatched(source, SOURCE_KEY, target, TARGET_KEY, columns)
    return _labelled_latest_first(rows, MISSING_IN_TARGET)


def missing_in_source(source: DataFrame, target: DataFrame) -> DataFrame:
    columns = [
        "ledger_transaction_id", "transaction_date", "posting_date", "gl_account", "department",
        "debit_amount", "credit_amount", "ledger_status",
    ]
    rows = unmatched(target, TARGET_KEY, source, SOURCE_KEY, columns)
    return _labelled_latest_first(rows, MISSING_IN_SOURCE)


def _labelled_latest_first(rows: DataFrame, status: str) -> DataFrame:
    labelled = rows.withColumn("reconciliation_status", F.lit(status))
    return sorted_rows(labelled, F.desc("posting_date"))


def _differs(rules: Rules) -> Column:
    return exceeds(F.col("src_debit"), F.col("tgt_debit"), rules.tolerance) | exceeds(
        F.col("src_credit"), F.col("tgt_credit"), rules.tolerance
    )


def amount_discrepancies(
    source: DataFrame, target: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Pairs with equal ids and different amounts, largest first. An inner join: AQE splits hot
    keys, and rows without an id are filtered out at the scan."""
    s = source.select(
        SOURCE_KEY,
        "transaction_date",
        "gl_account",
        F.col("debit_amount").alias("src_debit"),
        F.col("credit_amount").alias("src_credit"),
    )
    t = target.select(
        F.col(TARGET_KEY).alias(SOURCE_KEY),
        F.col("debit_amount").alias("tgt_debit"),
        F.col("credit_amount").alias("tgt_credit"),
    )
    debit_delta = F.abs(F.col("src_debit") - F.col("tgt_debit"))
    credit_delta = F.abs(F.col("src_credit") - F.col("tgt_credit"))
    found = (
        s.join(t, SOURCE_KEY)
        .filter(_differs(rules))
        .select(
            SOURCE_KEY, "transaction_date", "gl_account",
            "src_debit", "tgt_debit", debit_delta.alias("debit_delta"),
            "src_credit", "tgt_credit", credit_delta.alias("credit_delta"),
            F.lit(AMOUNT_DISCREPANCY).alias("reconciliation_status"),
        )
    )
    return sorted_rows(found, (F.col("debit_delta") + F.col("credit_delta")).desc())


def detail(
    source: DataFrame, target: DataFrame, rules: Rules = DEFAULT_RULES, ordered: bool = True
) -> DataFrame:
    """All records with status, absolute differences (a missing side counts as 0), by status and
    key. ``ordered=False`` saves the global sort."""

    def side(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.select(
            F.col(key).alias("key"),
            F.col("transaction_date").alias(f"{name}_date"),
            F.col("gl_account").alias(f"{name}_gl"),
            F.col("debit_amount").alias(f"{name}_debit"),
            F.col("credit_amount").alias(f"{name}_credit"),
            F.col(key).isNotNull().alias(f"in_{name}"),
        )

    left, right = tag_keys(
        side(source, SOURCE_KEY, "src"), side(target, TARGET_KEY, "tgt"), "key", "key", "never"
    )
    joined = full_outer(left, right)
    # in_src and in_tgt tell whether the side has a key, so they are not true for a null key.
    has_source = F.coalesce("in_src", F.lit(False))
    has_target = F.coalesce("in_tgt", F.lit(False))
    status = (
        F.when(~has_source, MISSING_IN_SOURCE)
        .when(~has_target, MISSING_IN_TARGET)
        .when(_differs(rules), AMOUNT_DISCREPANCY)
        .otherwise(MATCHED)
    )

    def gap(a: str) -> Column:
        known = [F.coalesce(f"{name}_{a}", F.lit(0.0)) for name in ("src", "tgt")]
        return F.round(F.abs(known[0] - known[1]), 4).alias(f"{a}_delta")

    rows = joined.select(
        plain_key().alias("key"),
        status.alias("reconciliation_status"),
        "src_date", "tgt_date", "src_gl", "tgt_gl",
        "src_debit", "tgt_debit", gap("debit"),
        "src_credit", "tgt_credit", gap("credit"),
    )
    return sorted_rows(rows, F.asc("reconciliation_status"), F.asc("key")) if ordered else rows


kpis = status_kpis


def balance(source: DataFrame, target: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    def line(df: DataFrame, system: str) -> DataFrame:
        gap = F.col("gap")
        return df.agg(*balance_columns()).select(
            F.lit(system).alias("system"),
            F.round("debits", 2).alias("total_debits"),
            F.round("credits", 2).alias("total_credits"),
            F.round(gap, 4).alias("balance_delta"),
            F.when(gap < rules.balance_limit, "BALANCED")
            .otherwise("DISCREPANCY_DETECTED")
            .alias("balance_status"),
        )

    return line(source, "SOURCE").unionByName(line(target, "TARGET"))


def freshness(source: DataFrame, target: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Newest posting date of each table and its age in days."""

    def line(df: DataFrame, name: str) -> DataFrame:
        age = F.datediff(F.lit(rules.today()), F.col("last_posting_date"))
        newest = df.agg(F.max("posting_date").alias("last_posting_date"))
        return newest.select(
            F.lit(name).alias("table_name"),
            "last_posting_date",
            age.cast("long").alias("days_since_last_post"),
            F.when(age > rules.stale_after_days, "STALE — CHECK FEED")
            .otherwise("CURRENT")
            .alias("freshness_status"),
        )

    return line(source, SYSTEMS[0]).unionByName(line(target, SYSTEMS[1]))


def all_queries(
    source: DataFrame, target: DataFrame, rules: Rules = DEFAULT_RULES
) -> dict[str, DataFrame]:
    return {
        "rq1_row_counts": row_counts(source, target),
        "rq2_missing_in_target": missing_in_target(source, target),
        "rq3_missing_in_source": missing_in_source(source, target),
        "rq4_amount_discrepancy": amount_discrepancies(source, target, rules),
        "rq5_detail": detail(source, target, rules),
        "rq6_kpis": kpis(source, target, rules),
        "rq7_balance": balance(source, target, rules),
        "rq8_freshness": freshness(source, target, rules),
    }
