"""Validation metrics at ingestion, on typed but unfilled tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import in_list, money_net, money_sum
from ..params import DEFAULT_RULES, Rules
from .checks import key_counts


def validate_source(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """11 rows (metric, value) about the transactions."""
    debit, credit = F.col("debit_amount"), F.col("credit_amount")
    metrics = _nulls(
        "transaction_id", "transaction_date", "gl_account", "debit_amount", "credit_amount"
    )
    metrics |= {
        "duplicate_transaction_ids": "transaction_id",
        "invalid_currency": ~in_list(F.col("currency"), rules.currencies),
        "both_amounts_zero": (debit == 0) & (credit == 0),
        "negative_debit": debit < 0,
        "negative_credit": credit < 0,
        "bad_gbp_exchange_rate": (F.col("currency") == rules.home_currency)
        & ~F.col("exchange_rate").eqNullSafe(F.lit(1.0)),
    }
    return _metrics(df, metrics)


def validate_target(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """6 rows (metric, value) about the ledger."""
    metrics = _nulls("ledger_transaction_id", "debit_amount", "credit_amount", "ledger_status")
    metrics |= {
        "duplicate_ledger_ids": "ledger_transaction_id",
        "invalid_ledger_status": ~in_list(F.col("ledger_status"), rules.ledger_statuses),
    }
    return _metrics(df, metrics)


def _nulls(*columns: str) -> dict[str, Column | str]:
    return {f"null_{c}": F.col(c).isNull() for c in columns}


def _metrics(df: DataFrame, metrics: dict[str, Column | str]) -> DataFrame:
    """Predicates are counted in one scan; a column name stands for "repeats after the first"."""
    order = {name: i for i, name in enumerate(metrics)}
    by_row = {k: v for k, v in metrics.items() if not isinstance(v, str)}

    def line(name: str, value: Column) -> Column:
        return F.struct(
            F.lit(order[name]).alias("position"),
            F.lit(name).alias("metric"),
            F.coalesce(value, F.lit(0)).cast("long").alias("value"),
        )

    counted = df.agg(*[F.count_if(pred).alias(name) for name, pred in by_row.items()])
    parts = [counted.select(F.inline(F.array(*[line(name, F.col(name)) for name in by_row])))]
    for name in metrics.keys() - by_row.keys():
        repeats = key_counts(df, metrics[name]).agg(F.sum(F.col("n") - 1).alias(name))
        parts.append(repeats.select(F.inline(F.array(line(name, F.col(name))))))
    found = reduce(DataFrame.unionByName, parts).coalesce(1).sortWithinPartitions("position")
    return found.drop("position")


def financial_summary(df: DataFrame, metrics: DataFrame, dataset: str) -> DataFrame:
    """One row: size, totals and how many of the validation ``metrics`` are above zero."""
    debit, credit = (F.coalesce(c, F.lit(0.0)) for c in ("debit_amount", "credit_amount"))
    totals = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        money_sum(debit).alias("total_debit"),
        money_sum(credit).alias("total_credit"),
        money_net(debit, credit).alias("net_balance"),
    )
    flags = metrics.agg(
        F.count(F.lit(1)).alias("checks_run"),
        F.count_if(F.col("value") > 0).alias("checks_flagged"),
    )
    # Two one-row frames side by side, without a join: each fills the columns the other lacks.
    both = totals.unionByName(flags, allowMissingColumns=True)
    row = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return row.select(
        F.lit(dataset).alias("dataset"),
        "row_count",
        *[
            F.round(F.coalesce(c, F.lit(0.0)), 4).alias(c)
            for c in ("total_debit", "total_credit", "net_balance")
        ],
        "checks_run",
        "checks_flagged",
    )
