"""Declarative quality checks: any number of checks on one table cost one scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import blank, calendar_date, number, share_pct, status_of
from ..params import DEFAULT_RULES, Rules
from .masters import listed


@dataclass(frozen=True)
class Check:
    """One rule. ``failing`` marks bad rows (unknown counts as good), or ``unique`` names a key
    whose repeated values, null included, are all bad."""

    name: str
    dataset: str
    failing: Column | None = None
    unique: str | None = None
    severity: str = "FAIL"


def run_checks(df: DataFrame, checks: Sequence[Check], run_stamp: str) -> DataFrame:
    """One row per check: dataset, check_name, status, rows_failed, total_rows, failure_pct,
    run_timestamp, in the order of ``checks``.

    All row checks share a single aggregate without a shuffle of rows. A uniqueness check reads
    its key column only and is counted per key on the map side before the shuffle, so a key that
    holds a third of the table sends one row per map task.
    """
    parts = []
    by_row = [(i, c) for i, c in enumerate(checks) if c.failing is not None]
    if by_row:
        counted = df.agg(
            F.count(F.lit(1)).alias("total"),
            *[F.count_if(c.failing).alias(f"failed_{i}") for i, c in by_row],
        )
        rows = [
            _result(i, c, F.col(f"failed_{i}"), F.col("total")) for i, c in by_row
        ]
        parts.append(counted.select(F.inline(F.array(*rows))))
    for i, c in enumerate(checks):
        if c.unique is not None:
            counted = key_counts(df, c.unique).agg(
                F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failed"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            )
            parts.append(
                counted.select(F.inline(F.array(_result(i, c, F.col("failed"), F.col("total")))))
            )
    # A handful of rows, each from an already finished aggregate.
    found = reduce(DataFrame.unionByName, parts).coalesce(1).sortWithinPartitions("position")
    return found.select(
        "dataset",
        "check_name",
        status_of(F.col("rows_failed"), F.col("severity")).alias("status"),
        "rows_failed",
        "total_rows",
        share_pct(F.col("rows_failed"), F.col("total_rows"), 2).alias("failure_pct"),
        F.lit(run_stamp).alias("run_timestamp"),
    )


def _result(position: int, check: Check, failed: Column, total: Column) -> Column:
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(check.dataset).alias("dataset"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        failed.cast("long").alias("rows_failed"),
        total.cast("long").alias("total_rows"),
    )


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """(key, n) per distinct value, null being a value."""
    return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def filled(df: DataFrame, columns: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Parse the named number columns that exist and replace what is missing or bad by ``fill``."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.coalesce(number(df, c), F.lit(fill)) for c in present})


def for_checks(df: DataFrame) -> DataFrame:
    """The named checks see missing amounts and rates as 0."""
    return filled(df, ["debit_amount", "credit_amount", "exchange_rate"])


def source_checks(df: DataFrame, rules: Rules = DEFAULT_RULES) -> dict[str, Check]:
    """The 12 checks on transactions, for a frame prepared by ``for_checks``."""
    debit, credit = F.col("debit_amount"), F.col("credit_amount")
    larger = F.greatest(debit, credit)
    entered = calendar_date(df, "transaction_date", rules.date_format)
    posted = calendar_date(df, "posting_date", rules.date_format)
    wrong_rate = ~F.col("exchange_rate").eqNullSafe(F.lit(1.0))
    # The check names.
    named = {
        "s01": ("QC-S01: Null transaction_id", F.col("transaction_id").isNull()),
        "s02": ("QC-S02: Duplicate transaction_id", "transaction_id"),
        "s03": ("QC-S03: Both debit and credit = 0", (debit == 0) & (credit == 0)),
        "s04": ("QC-S04: Both debit and credit > 0", (debit > 0) & (credit > 0)),
        "s05": ("QC-S05: Negative debit or credit amount", (debit < 0) | (credit < 0)),
        "s06": (f"QC-S06: Amount > £{rules.max_amount:,.0f}", larger > rules.max_amount),
        "s07": ("QC-S07: Invalid currency", ~listed(df, "currency", rules.currencies)),
        "s08": (
            f"QC-S08: {rules.home_currency} with exchange_rate ≠ 1.0",
            (F.col("currency") == rules.home_currency) & wrong_rate,
        ),
        "s09": (
            "QC-S09: Invalid GL account",
            ~listed(df, "gl_account", rules.gl_accounts),
        ),
        "s10": ("QC-S10: Posting date before transaction date", posted < entered),
        "s11": (
            f"QC-S11: Posting lag > {rules.max_posting_lag_days} days",
            F.datediff(posted, entered) > rules.max_posting_lag_days,
        ),
        "s12": (
            f"QC-S12: High-value (>£{rules.approval_amount / 1000:g}K) with no approver",
            (larger > rules.approval_amount) & blank(F.col("approved_by")),
        ),
    }
    return _as_checks(named, "source")


def target_checks(df: DataFrame, rules: Rules = DEFAULT_RULES) -> dict[str, Check]:
    """The 4 checks on the ledger, for a frame prepared by ``for_checks``."""
    no_amount = (F.col("debit_amount") == 0) & (F.col("credit_amount") == 0)
    # The check names.
    named = {
        "t01": ("QC-T01: Null ledger_transaction_id", F.col("ledger_transaction_id").isNull()),
        "t02": ("QC-T02: Duplicate ledger_transaction_id", "ledger_transaction_id"),
        "t03": (
            "QC-T03: Invalid ledger_status",
            ~listed(df, "ledger_status", rules.ledger_statuses),
        ),
        "t04": ("QC-T04: Both debit and credit = 0", no_amount),
    }
    return _as_checks(named, "target")


def _as_checks(named: dict, dataset: str) -> dict[str, Check]:
    return {
        code: Check(name, dataset, unique=rule)
        if isinstance(rule, str)
        else Check(name, dataset, failing=rule)
        for code, (name, rule) in named.items()
    }


def check_source(df: DataFrame, rules: Rules = DEFAULT_RULES, only: str | None = None) -> DataFrame:
    return _run(df, source_checks, rules, only)


def check_target(df: DataFrame, rules: Rules = DEFAULT_RULES, only: str | None = None) -> DataFrame:
    return _run(df, target_checks, rules, only)


def _run(df, catalogue, rules, only):
    ready = for_checks(df)
    checks = catalogue(ready, rules)
    chosen = list(checks.values()) if only is None else [checks[only]]
    return run_checks(ready, chosen, rules.run_stamp())


def quality_report(source: DataFrame, target: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """All 16 named checks, source first."""
    return check_source(source, rules).unionByName(check_target(target, rules))


def quality_summary(report: DataFrame) -> DataFrame:
    """One row over a check report (at most a few dozen rows): counts, verdict, failed checks."""
    failed = F.col("status") == "FAIL"
    line = F.concat(
        F.lit("["), "dataset", F.lit("] "), "check_name",
        F.lit(" ("), F.format_number("rows_failed", 0), F.lit(" rows)"),
    )
    counted = report.agg(
        F.count(F.lit(1)).alias("checks_run"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(failed).alias("failed"),
        F.array_join(F.array_sort(F.collect_list(F.when(failed, line))), "; ").alias("failed_checks"),
    )
    verdict = F.when(F.col("failed") == 0, "ALL CLEAR").otherwise(
        F.concat(F.col("failed").cast("string"), F.lit(" CHECKS FAILED"))
    )
    return counted.withColumn("overall_status", verdict)
