"""Row-level reconciliation: full outer join, four-way classification, signed differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import decimal_number, difference, exceeds, exceeds_exactly, money_sum, share_pct
from ..functions.values import DECIMAL_TYPE
from ..params import (
    AMOUNT_DISCREPANCY,
    DEFAULT_RULES,
    MATCHED,
    MISSING_IN_SOURCE,
    MISSING_IN_TARGET,
    Rules,
)
from ..plans.skew import full_outer, plain_key, sorted_rows, tag_keys
from .checks import filled

SOURCE_KEY, TARGET_KEY = "transaction_id", "ledger_transaction_id"
ATTRIBUTES = ["gl_account", "department", "transaction_date", "currency"]
# Order and names of the detail columns.
DETAIL_COLUMNS = [
    "key", "src_debit", "src_credit", "gl_account_src", "department_src", "transaction_date_src",
    "currency_src", "tgt_debit", "tgt_credit", "gl_account_tgt", "department_tgt",
    "transaction_date_tgt", "currency_tgt", "reconciliation_status", "debit_delta", "credit_delta",
]
DETAIL_NUMBERS = [
    "src_debit", "src_credit", "tgt_debit", "tgt_credit", "debit_delta", "credit_delta",
]


def for_reconciliation(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Reconciliation sees missing amounts as 0. In decimal mode amounts are DECIMAL(18,4) from here on;
    one that does not fit fails the query, since there is no amount that it could stand for."""
    amounts = ["debit_amount", "credit_amount"]
    if rules.amounts == "double":
        return filled(df, amounts)
    zero = F.lit(0).cast(DECIMAL_TYPE)
    return df.withColumns({a: F.coalesce(decimal_number(df, a), zero) for a in amounts})


def reconcile(
    source: DataFrame,
    target: DataFrame,
    rules: Rules = DEFAULT_RULES,
    null_keys: str = "match",
) -> DataFrame:
    """Every pair of a transaction and a ledger entry with the same id, and all that have none.

    Repeated ids give one row per pair. With ``null_keys="match"`` a missing id equals a missing
    id; with ``"never"`` it equals nothing. A missing amount counts as 0, so presence of a row is
    carried by a marker and not by its amounts.
    """
    left, right = tag_keys(
        _side(source, SOURCE_KEY, "src", rules), _side(target, TARGET_KEY, "tgt", rules), "key", "key", null_keys
    )
    exact = rules.amounts == "decimal"

    def delta(a: str) -> Column:
        src, tgt = F.col(f"src_{a}"), F.col(f"tgt_{a}")
        return (src - tgt).cast("decimal(19,4)") if exact else difference(src, tgt)

    return full_outer(left, right).withColumns(
        {
            "key": plain_key(),
            "reconciliation_status": _status(rules),
            "debit_delta": delta("debit"),
            "credit_delta": delta("credit"),
        }
    ).select(*DETAIL_COLUMNS)


def _side(df: DataFrame, key: str, side: str, rules: Rules) -> DataFrame:
    return for_reconciliation(df, rules).select(
        F.col(key).alias("key"),
        F.col("debit_amount").alias(f"{side}_debit"),
        F.col("credit_amount").alias(f"{side}_credit"),
        *[F.col(c).alias(f"{c}_{side}") for c in ATTRIBUTES],
        F.lit(True).alias(f"in_{side}"),
    )


def _status(rules: Rules) -> Column:
    far = exceeds if rules.amounts == "double" else exceeds_exactly
    differs = far(F.col("src_debit"), F.col("tgt_debit"), rules.tolerance) | far(
        F.col("src_credit"), F.col("tgt_credit"), rules.tolerance
    )
    return (
        F.when(F.col("in_src").isNull(), MISSING_IN_SOURCE)
        .when(F.col("in_tgt").isNull(), MISSING_IN_TARGET)
        .when(differs, AMOUNT_DISCREPANCY)
        .otherwise(MATCHED)
    )


def discrepancies(detail: DataFrame) -> DataFrame:
    return detail.filter(F.col("reconciliation_status") != MATCHED)


def in_key_order(detail: DataFrame) -> DataFrame:
    """By key, missing keys last; rows of one key are cut and ordered by their hash, so that none fills
    a partition of its own."""
    return sorted_rows(detail, F.asc_nulls_last("key"))


def summarize(detail: DataFrame) -> DataFrame:
    """The nine figures, from detail rows that exist anyway (``reconcile_totals`` needs none)."""
    status = F.col("reconciliation_status")
    differs = status == AMOUNT_DISCREPANCY
    return summary_row(
        detail.agg(
            F.count_if(status == MATCHED).alias("matched"),
            F.count_if(status == MISSING_IN_TARGET).alias("missing_in_target"),
            F.count_if(status == MISSING_IN_SOURCE).alias("missing_in_source"),
            F.count_if(differs).alias("amount_discrepancies"),
            money_sum(F.when(differs, F.col("debit_delta").cast("double"))).alias("debit_delta"),
            money_sum(F.when(differs, F.col("credit_delta").cast("double"))).alias("credit_delta"),
        )
    )


def summary_row(totals: DataFrame) -> DataFrame:
    """The nine figures from one row of status counts and summed differences."""
    matched, differ = F.col("matched"), F.col("amount_discrepancies")
    no_target, no_source = F.col("missing_in_target"), F.col("missing_in_source")
    in_source = matched + no_target + differ
    return totals.select(
        in_source.alias("total_source_transactions"),
        matched.alias("matched"),
        no_target.alias("missing_in_target"),
        no_source.alias("missing_in_source"),
        differ.alias("amount_discrepancies"),
        (no_target + no_source + differ).alias("total_discrepancies"),
        share_pct(matched, in_source, 1).alias("reconciliation_rate_pct"),
        F.round(F.coalesce("debit_delta", F.lit(0.0)), 4).alias("net_debit_delta_gbp"),
        F.round(F.coalesce("credit_delta", F.lit(0.0)), 4).alias("net_credit_delta_gbp"),
    )


def ledger_entries(summary: DataFrame) -> DataFrame:
    """Ledger rows that took part: those with a partner plus the orphans."""
    return summary.withColumn(
        "ledger_entries",
        F.col("missing_in_source") + F.col("matched") + F.col("amount_discrepancies"),
    )


def key_match_rate(source: DataFrame, target: DataFrame) -> DataFrame:
    """Share of distinct source ids that the ledger knows."""
    wanted = source.select(F.col(SOURCE_KEY).alias("id")).filter("id IS NOT NULL").distinct()
    known = target.select(F.col(TARGET_KEY).alias("id")).filter("id IS NOT NULL").distinct()
    seen = wanted.join(known.withColumn("seen", F.lit(True)), "id", "left")
    counted = seen.agg(
        F.count(F.lit(1)).alias("source_keys"), F.count("seen").alias("matched_keys")
    )
    return counted.withColumn(
        "match_rate_pct",
        share_pct(F.col("matched_keys"), F.col("source_keys"), 1),
    )
