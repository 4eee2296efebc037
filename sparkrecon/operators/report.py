"""Governance tables: tiles, statement, discrepancy register, account analysis, audit trail.

Fill colours are delivered as columns; cell styling is left to whatever displays the tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import money_net, money_sum
from ..params import (
    AMBER_FILL,
    DEFAULT_RULES,
    GREEN_FILL,
    RED_FILL,
    STATUS_FILLS,
    Rules,
)
from ..schemas import SOURCE_SCHEMA, TARGET_SCHEMA
from .checks import filled
from .reconcile import discrepancies

# Display headers of the register and of the account analysis.
REGISTER_HEADERS = {
    "transaction_id": "Transaction ID",
    "status": "Status",
    "transaction_date": "Transaction Date",
    "gl_account": "GL Account",
    "department": "Department",
    "currency": "Currency",
    "erp_debit": "ERP Debit (£)",
    "erp_credit": "ERP Credit (£)",
    "ledger_debit": "Ledger Debit (£)",
    "ledger_credit": "Ledger Credit (£)",
    "debit_delta": "Debit Delta (£)",
    "credit_delta": "Credit Delta (£)",
}
GL_HEADERS = {
    "gl_account": "GL Account",
    "account_name": "Account Name",
    "transactions": "Transactions",
    "total_debit": "Total Debit (£)",
    "total_credit": "Total Credit (£)",
    "net_balance": "Net Balance (£)",
    "discrepancies": "Discrepancies",
}


def _lines(one_row: DataFrame, names: list[str], lines: list[tuple]) -> DataFrame:
    """Turn a one-row frame into the given lines of text expressions, numbered from 1."""
    structs = [
        F.struct(
            F.lit(i).alias("position"),
            *[
                (v if isinstance(v, Column) else F.lit(v)).cast("string").alias(n)
                for n, v in zip(names, line)
            ],
        )
        for i, line in enumerate(lines, start=1)
    ]
    return one_row.select(F.inline(F.array(*structs)))


def _thousands(name: str) -> Column:
    return F.format_number(name, 0)


# Ledger size as the report states it: transactions that were posted, orphan entries left out.
_POSTED = "posted"


def _with_posted(summary: DataFrame) -> DataFrame:
    return summary.withColumn(
        _POSTED, F.col("total_source_transactions") - F.col("missing_in_target")
    )


def kpi_tiles(summary: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Four tiles with their traffic light."""
    rate, off = F.col("reconciliation_rate_pct"), F.col("total_discrepancies")
    good = rate >= rules.green_rate_pct
    none = F.lit(None).cast("string")
    return _lines(
        _with_posted(summary),
        ["tile", "value", "rag", "fill"],
        [
            ("Source Transactions", _thousands("total_source_transactions"), none, none),
            ("Ledger Entries", _thousands(_POSTED), none, none),
            (
                "Reconciliation Rate",
                F.concat(rate.cast("string"), F.lit("%")),
                F.when(good, "GREEN").otherwise("AMBER"),
                F.when(good, GREEN_FILL).otherwise(AMBER_FILL),
            ),
            (
                "Total Discrepancies",
                _thousands("total_discrepancies"),
                F.when(off > 0, "RED").otherwise("GREEN"),
                F.when(off > 0, RED_FILL).otherwise(GREEN_FILL),
            ),
        ],
    )


def statement(summary: DataFrame) -> DataFrame:
    """The reconciliation statement, seven lines."""

    def money(name: str) -> Column:
        # Adding 0 turns -0.0, which would print as "-0.0000", into 0.0.
        return F.format_string("£%+.4f", F.col(name) + F.lit(0.0))

    # Items and notes.
    return _lines(
        summary,
        ["item", "count", "note"],
        [
            (
                "Total Source Transactions (ERP)",
                F.col("total_source_transactions"),
                "All transactions in ERP system",
            ),
            (
                "  Of which: Matched to Ledger",
                F.col("matched"),
                "✓ Confirmed in both systems",
            ),
            (
                "  Of which: Missing in Target Ledger",
                F.col("missing_in_target"),
                "⚠ Not posted to GL — requires investigation",
            ),
            (
                "  Of which: Amount Discrepancy",
                F.col("amount_discrepancies"),
                "⚠ Delta > £0.01 — interface rounding error",
            ),
            (
                "Ledger-Only Records (no ERP source)",
                F.col("missing_in_source"),
                "Manual journals or interface duplicates",
            ),
            ("Net Debit Delta (£)", money("net_debit_delta_gbp"), "Should be < £0.01"),
            ("Net Credit Delta (£)", money("net_credit_delta_gbp"), "Should be < £0.01"),
        ],
    )


def discrepancy_register(detail: DataFrame) -> DataFrame:
    """One line per discrepancy. Attributes come from the source side, so they are null for
    ledger-only rows."""
    status = F.col("reconciliation_status")
    fill = F.lit(None).cast("string")
    for name, colour in STATUS_FILLS.items():
        fill = F.when(status == name, colour).otherwise(fill)
    return discrepancies(detail).select(
        F.col("key").alias("transaction_id"),
        status.alias("status"),
        F.col("transaction_date_src").alias("transaction_date"),
        F.col("gl_account_src").alias("gl_account"),
        F.col("department_src").alias("department"),
        F.col("currency_src").alias("currency"),
        F.col("src_debit").alias("erp_debit"),
        F.col("src_credit").alias("erp_credit"),
        F.col("tgt_debit").alias("ledger_debit"),
        F.col("tgt_credit").alias("ledger_credit"),
        "debit_delta",
        "credit_delta",
        fill.alias("fill"),
    )


def discrepancies_by_account(detail: DataFrame) -> DataFrame:
    """(gl_account, discrepancies) from detail rows that exist anyway; without them see
    ``totals.account_discrepancies``."""
    off = discrepancies(detail).filter(F.col("gl_account_src").isNotNull())
    return off.groupBy(F.col("gl_account_src").alias("gl_account")).agg(F.count(F.lit(1)).alias("discrepancies"))


def gl_analysis(source: DataFrame, detail: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """``gl_accounts`` with the discrepancies of the given detail."""
    return gl_accounts(source, discrepancies_by_account(detail), rules)


def gl_accounts(source: DataFrame, off: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Totals and discrepancies per account, largest debit first. Rows without an account, and
    discrepancies of ledger-only rows, belong to none. ``off`` holds (gl_account, discrepancies)."""
    account = "gl_account"
    totals = (
        filled(source, ["debit_amount", "credit_amount"])
        .filter(F.col(account).isNotNull())
        .groupBy(account)
        .agg(
            F.count("transaction_id").alias("transactions"),
            money_sum(F.col("debit_amount")).alias("debit"),
            money_sum(F.col("credit_amount")).alias("credit"),
            money_net(F.col("debit_amount"), F.col("credit_amount")).alias("net"),
        )
    )
    names = F.create_map(*[F.lit(x) for pair in rules.gl_names.items() for x in pair])
    found = F.coalesce("discrepancies", F.lit(0))
    # The right side has one row per account; its size is left for AQE to judge.
    return (
        totals.join(off, account, "left")
        .select(
            account,
            F.coalesce(F.try_element_at(names, F.col(account)), F.lit("Unknown")).alias(
                "account_name"
            ),
            "transactions",
            F.round("debit", 2).alias("total_debit"),
            F.round("credit", 2).alias("total_credit"),
            F.round("net", 2).alias("net_balance"),
            found.alias("discrepancies"),
            F.when(found > 0, RED_FILL).alias("fill"),
        )
        .orderBy(F.desc("total_debit"), account)
    )


def _run_facts(
    summary: DataFrame, source: DataFrame, target: DataFrame, checks: DataFrame | None, facts: Mapping[str, object] | None
) -> DataFrame:
    """One row of what is known of a run: rows per table, joined rows, discrepancies, checks run and
    failed per table (null if no check report is given). Rows are counted here only if there is no
    record of the run."""
    joined = F.col("matched") + F.col("amount_discrepancies") + F.col("missing_in_target") + F.col("missing_in_source")
    parts = [summary.select("total_discrepancies", joined.alias("joined_rows"))]
    if facts is None:
        for name, df in (("source", source), ("target", target)):
            parts.append(df.agg(F.count(F.lit(1)).alias(f"{name}_rows")))
    if checks is not None:
        counted = [
            F.count_if((F.col("dataset") == name) & (F.col("status") != "PASS" if failed else F.lit(True))).alias(
                f"{name}_checks_{'failed' if failed else 'run'}"
            )
            for name in ("source", "target")
            for failed in (False, True)
        ]
        parts.append(checks.agg(*counted))
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    found = merged.agg(*[F.max(c).alias(c) for c in merged.columns])
    if facts is not None:
        known = {n: facts.get(n) for n in ("source_rows", "target_rows")}
        found = found.withColumns({n: F.lit(None if v is None else int(v)).cast("long") for n, v in known.items()})
    return found


def audit_trail(
    summary: DataFrame,
    source: DataFrame,
    target: DataFrame,
    checks: DataFrame | None = None,
    rules: Rules = DEFAULT_RULES,
    facts: Mapping[str, object] | None = None,
) -> DataFrame:
    """Stages of the run with what was counted, and the lines to be signed.

    ``facts`` are the record of a run (see ``plans.runs``): the rows that its writes counted and the
    number of tables of the report. With them no table is scanned, and a stage without a record did not
    run. Without them rows are counted in the tables, and no report was written. Columns are compared
    with the schemas, and the checks are those of the check report; without one they did not run.
    """
    stamp = rules.run_stamp("%Y-%m-%d %H:%M")

    def loaded(name: str, title: str) -> tuple:
        rows = F.col(f"{name}_rows")
        note = F.coalesce(F.concat(F.format_number(rows, 0), F.lit(" rows loaded")), F.lit("no ingestion in this run"))
        return (f"Data Ingestion — {title}", F.when(rows.isNull(), "NOT RUN").otherwise("COMPLETE"),
                F.when(rows.isNull(), "").otherwise(stamp), note)

    def validated(df: DataFrame, schema: T.StructType, title: str) -> tuple:
        missing = [c for c in schema.names if c not in df.columns]
        note = f"{len(schema.names) - len(missing)} of {len(schema.names)} columns present"
        if missing:
            note += f"; missing: {', '.join(missing)}"
        return f"Schema Validation — {title}", "INCOMPLETE" if missing else "COMPLETE", stamp, note

    def checked(name: str, title: str) -> tuple:
        if checks is None:
            return f"Quality Checks — {title}", "NOT RUN", "", "no check report for this run"
        run, failed = F.col(f"{name}_checks_run"), F.col(f"{name}_checks_failed")
        note = F.concat(run.cast("string"), F.lit(" checks run, "), failed.cast("string"), F.lit(" failed"))
        return f"Quality Checks — {title}", F.when(run > 0, "COMPLETE").otherwise("NOT RUN"), stamp, note

    joined = F.concat(F.format_number("joined_rows", 0), F.lit(" rows of a full outer join on transaction_id"))
    found = F.concat(F.col("total_discrepancies").cast("string"), F.lit(" discrepancies identified"))
    tables = (facts or {}).get("report_tables")
    if tables is None:
        written = ("NOT RUN", "", "no report tables written by this run")
    else:
        written = ("COMPLETE", stamp, f"{tables} tables written, {int(facts['register_rows']):,} discrepancies listed")
    return _lines(
        _run_facts(summary, source, target, checks, facts),
        ["stage", "status", "timestamp", "notes"],
        [
            loaded("source", "source transactions"),
            loaded("target", "target ledger"),
            validated(source, SOURCE_SCHEMA, "Source"),
            validated(target, TARGET_SCHEMA, "Target"),
            checked("source", "Source"),
            checked("target", "Target"),
            ("Reconciliation Join", "COMPLETE", stamp, joined),
            ("Discrepancy Classification", "COMPLETE", stamp, found),
            ("Governance Report Generation", *written),
            ("", "", "", ""),
            ("SIGN-OFF SECTION", "", "", ""),
            ("Prepared by", "Automated Pipeline", stamp, "sparkrecon report"),
            ("Finance Controller Review", "[PENDING]", "", ""),
            ("CFO Approval", "[PENDING]", "", ""),
        ],
    )
