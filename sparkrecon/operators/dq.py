"""The rule catalogue over typed tables, with SQL's treatment of null: unknown is not a failure.

Inputs carry the catalogue's own column names: the transactions also ``net_amount``,
``value_date``, ``entity`` and ``batch_id``, the ledger ``ledger_id``, ``source_ref`` and
``net_amount`` (see ``catalogue_columns``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import blank, calendar_date, exceeds, money_net, money_sum, share_pct, status_of
from ..params import DEFAULT_RULES, Rules
from ..plans.skew import anti, sorted_rows, tag_keys
from .checks import key_counts
from .masters import unlisted

SOURCE, TARGET = "source_transactions", "target_ledger"
# The table each counting rule reads; known without a running session.
COUNT_RULES = {
    "dq1a_null_mandatory_source": SOURCE,
    "dq1b_null_mandatory_target": TARGET,
    "dq1c_missing_vendor_invoice": SOURCE,
    "dq2a_duplicate_transaction_id": SOURCE,
    "dq2c_duplicate_ledger_id": TARGET,
    "dq3a_negative": SOURCE,
    "dq3b_net_amount": SOURCE,
    "dq3d_zero_value": SOURCE,
    "dq4a_future_posting": SOURCE,
    "dq4b_value_date_lag": SOURCE,
    "dq4c_out_of_period": SOURCE,
    "dq5a_gl": SOURCE,
    "dq5b_cost_centre": SOURCE,
    "dq5c_entity": SOURCE,
    "dq8a_posted_without_user": SOURCE,
}


@dataclass(frozen=True)
class CountRule:
    """Rows failing a predicate, or surplus rows of a key (``unique``)."""

    check_name: str
    failing: Column | None = None
    unique: str | None = None
    severity: str = "FAIL"


def catalogue_columns(df: DataFrame, **aliases: str) -> DataFrame:
    """Add catalogue names for existing columns: ``catalogue_columns(df, batch_id="erp_batch_id")``."""
    return df.withColumns({new: F.col(old) for new, old in aliases.items()})


def with_dates(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Parse the date columns that arrived as text, as the catalogue compares real dates."""
    names = ("transaction_date", "posting_date", "value_date")
    present = [c for c in names if c in df.columns]
    return df.withColumns({c: calendar_date(df, c, rules.date_format) for c in present})


def count_rules(rules: Rules = DEFAULT_RULES, columns: list[str] | None = None) -> dict[str, CountRule]:
    """The 15 counting rules by key of the catalogue, for a table of these columns (see ``masters``)."""
    columns = columns or []
    col = F.col
    debit, credit, posted = col("debit_amount"), col("credit_amount"), col("posting_date")
    today = F.lit(rules.today())

    def any_null(*names: str) -> Column:
        return reduce(Column.__or__, [col(n).isNull() for n in names])

    # Check names, severities.
    return {
        "dq1a_null_mandatory_source": CountRule(
            "NULL_MANDATORY_FIELDS",
            any_null("transaction_id", "posting_date", "gl_account", "debit_amount", "credit_amount"),
        ),
        "dq1b_null_mandatory_target": CountRule(
            "NULL_MANDATORY_FIELDS",
            any_null("ledger_id", "source_ref", "posting_date", "debit_amount", "credit_amount"),
        ),
        "dq1c_missing_vendor_invoice": CountRule(
            "MISSING_VENDOR_ON_INVOICE",
            (col("transaction_type") == "INVOICE") & blank(col("vendor_id")),
        ),
        "dq2a_duplicate_transaction_id": CountRule(
            "DUPLICATE_TRANSACTION_ID", unique="transaction_id"
        ),
        "dq2c_duplicate_ledger_id": CountRule("DUPLICATE_LEDGER_ID", unique="ledger_id"),
        "dq3a_negative": CountRule(
            "NEGATIVE_DEBIT_OR_CREDIT", (debit < 0) | (credit < 0)
        ),
        "dq3b_net_amount": CountRule(
            "NET_AMOUNT_INTEGRITY", exceeds(col("net_amount"), debit - credit, rules.tolerance)
        ),
        "dq3d_zero_value": CountRule(
            "ZERO_VALUE_TRANSACTIONS", (debit == 0) & (credit == 0), severity="WARNING"
        ),
        "dq4a_future_posting": CountRule("FUTURE_POSTING_DATE", posted > today),
        "dq4b_value_date_lag": CountRule(
            "VALUE_DATE_LAG_EXCESS_30D",
            F.datediff(posted, col("value_date")) > rules.max_value_lag_days,
            severity="WARNING",
        ),
        "dq4c_out_of_period": CountRule(
            "OUT_OF_PERIOD_TRANSACTIONS",
            (posted < F.lit(rules.fiscal_start)) | (posted > F.lit(rules.fiscal_end)),
            severity="WARNING",
        ),
        "dq5a_gl": CountRule(
            "INVALID_GL_ACCOUNT", unlisted(columns, "gl_account", rules.gl_accounts_dq)
        ),
        "dq5b_cost_centre": CountRule(
            "INVALID_COST_CENTRE", unlisted(columns, "cost_centre", rules.cost_centres)
        ),
        "dq5c_entity": CountRule(
            "INVALID_ENTITY_CODE", unlisted(columns, "entity", rules.entities)
        ),
        "dq8a_posted_without_user": CountRule(
            "POSTED_WITHOUT_USER",
            (col("status") == "POSTED") & blank(col("created_by")),
        ),
    }


def count_rule(df: DataFrame, key: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One rule on its own: the predicate is a filter, so it reaches the scan."""
    rule = count_rules(rules, df.columns)[key]
    if rule.unique is not None:
        # Rows less distinct non-null keys: each null row counts as surplus.
        counted = key_counts(df, rule.unique).agg(
            (F.coalesce(F.sum("n"), F.lit(0)) - F.count("key")).alias("n")
        )
    else:
        counted = df.filter(rule.failing).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.inline(F.array(_line(key, rule, F.col("n")))))


def count_report(
    source: DataFrame, target: DataFrame, rules: Rules = DEFAULT_RULES, only: Sequence[str] | None = None
) -> DataFrame:
    """All counting rules (or ``only`` some) in one table, with one scan per input plus one per
    uniqueness rule."""
    tables = {SOURCE: source, TARGET: target}
    catalogue = {k: r for k, r in count_rules(rules, source.columns).items() if only is None or k in only}
    parts = []
    for name, df in tables.items():
        fused = {
            k: r for k, r in catalogue.items() if COUNT_RULES[k] == name and r.unique is None
        }
        if fused:
            counted = df.agg(*[F.count_if(r.failing).alias(k) for k, r in fused.items()])
            lines = [_line(k, r, F.col(k)) for k, r in fused.items()]
            parts.append(counted.select(F.inline(F.array(*lines))))
    parts += [count_rule(tables[COUNT_RULES[k]], k, rules) for k, r in catalogue.items() if r.unique]
    return reduce(DataFrame.unionByName, parts)


def _line(key: str, rule: CountRule, failing: Column) -> Column:
    return F.struct(
        F.lit(COUNT_RULES[key]).alias("table_name"),
        F.lit(rule.check_name).alias("check_name"),
        failing.alias("failing_rows"),
        status_of(failing, rule.severity).alias("result"),
    )


def duplicate_audit(source: DataFrame) -> DataFrame:
    """Repeated ids with their number of rows, most frequent first."""
    counted = key_counts(source, "transaction_id").filter("n > 1")
    renamed = counted.toDF("transaction_id", "occurrence_count")
    return sorted_rows(renamed, F.desc("occurrence_count"), F.asc("transaction_id"))


def outliers(source: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    limit = rules.outlier_amount
    found = source.filter((F.col("debit_amount") > limit) | (F.col("credit_amount") > limit))
    columns = ["transaction_id", "transaction_type", "debit_amount", "credit_amount", "description"]
    return sorted_rows(found.select(*columns), F.desc("debit_amount"))


def missing_from_target(source: DataFrame, target: DataFrame) -> DataFrame:
    """Transactions whose id no ledger row refers to; those without an id are among them."""
    columns = ["transaction_id", "posting_date", "gl_account", "net_amount", "transaction_type"]
    rows = unmatched(source, "transaction_id", target, "source_ref", columns)
    found = rows.withColumn("discrepancy_type", F.lit("MISSING_FROM_TARGET"))
    return sorted_rows(found, F.asc("posting_date"))


def orphan_target(source: DataFrame, target: DataFrame) -> DataFrame:
    """Ledger rows that refer to no transaction."""
    columns = ["ledger_id", "source_ref", "posting_date", "net_amount"]
    rows = unmatched(target, "source_ref", source, "transaction_id", columns)
    found = rows.withColumn("discrepancy_type", F.lit("ORPHAN_TARGET_RECORD"))
    return sorted_rows(found, F.asc("posting_date"))


def unmatched(
    left: DataFrame,
    left_key: str,
    right: DataFrame,
    right_key: str,
    columns: list[str],
) -> DataFrame:
    """``columns`` of the left rows whose key is null or does not occur on the right."""
    rows = left.select(F.col(left_key).alias("key"), *columns)
    mine, theirs = tag_keys(rows, right.select(right_key), "key", right_key, "never")
    return anti(mine, theirs).select(*columns)


def value_discrepancies(
    source: DataFrame, target: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Pairs with the same id and different net amounts. An inner join: AQE splits hot keys."""
    s = source.select(
        "transaction_id", "posting_date", "gl_account", F.col("net_amount").alias("source_net")
    )
    t = target.select(
        F.col("source_ref").alias("transaction_id"), F.col("net_amount").alias("target_net")
    )
    found = (
        s.join(t, "transaction_id")
        .filter(exceeds(F.col("source_net"), F.col("target_net"), rules.tolerance))
        .withColumns(
            {
                "delta_abs": F.abs(F.col("source_net") - F.col("target_net")),
                "discrepancy_type": F.lit("VALUE_DISCREPANCY"),
            }
        )
    )
    return sorted_rows(found, F.desc("delta_abs"))


def recon_summary(source: DataFrame, target: DataFrame) -> DataFrame:
    """Distinct ids of the source, and how many of them the ledger refers to. Only ids meet."""
    ids = source.select(F.col("transaction_id").alias("id")).distinct().filter("id IS NOT NULL")
    refs = target.select(F.col("source_ref").alias("id")).distinct().filter("id IS NOT NULL")
    counted = ids.join(refs.withColumn("seen", F.lit(True)), "id", "left").agg(
        F.count(F.lit(1)).alias("total_source"), F.count("seen").alias("total_matched")
    )
    total, matched = F.col("total_source"), F.col("total_matched")
    return counted.select(
        total,
        matched,
        (total - matched).alias("unreconciled"),
        F.when(total > 0, share_pct(matched, total, 1)).alias("recon_rate_pct"),
    )


def balance_columns() -> list[Column]:
    """Aggregates ``debits``, ``credits`` and their absolute difference ``gap``."""
    debit, credit = F.col("debit_amount"), F.col("credit_amount")
    return [
        money_sum(debit).alias("debits"),
        money_sum(credit).alias("credits"),
        F.abs(money_net(debit, credit)).alias("gap"),
    ]


def entity_balance(source: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    balanced = F.col("gap") < rules.balance_limit
    return (
        source.groupBy("entity")
        .agg(*balance_columns())
        .select(
            "entity",
            F.round("debits", 2).alias("total_debits"),
            F.round("credits", 2).alias("total_credits"),
            F.round("gap", 2).alias("imbalance"),
            F.when(balanced, "BALANCED").otherwise("IMBALANCED").alias("balance_status"),
        )
        .orderBy("entity")
    )


def batch_integrity(source: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Journal batches whose debits and credits differ, largest gap first."""
    journals = source.filter(F.col("transaction_type") == "JOURNAL")
    sums = journals.groupBy("batch_id").agg(*balance_columns())
    uneven = sums.filter(F.col("gap") > rules.balance_limit)
    found = uneven.select(
        "batch_id",
        F.round("debits", 2).alias("batch_debits"),
        F.round("credits", 2).alias("batch_credits"),
        F.round("gap", 2).alias("imbalance"),
    )
    return sorted_rows(found, F.desc("imbalance"))


def singleton_batches(source: DataFrame) -> DataFrame:
    single = key_counts(source, "batch_id").filter("n = 1").toDF("batch_id", "record_count")
    return single.withColumn("flag", F.lit("SINGLETON_BATCH")).orderBy("batch_id")


# Catalogue names of columns that the documented schemas call otherwise.
SOURCE_ALIASES = {"batch_id": "erp_batch_id"}
TARGET_ALIASES = {"source_ref": "ledger_transaction_id"}
# Columns of the rules that return rows or groups, by table.
_NEEDS = {
    "dq2b_duplicate_audit": (["transaction_id"], []),
    "dq3c_outliers": (["transaction_id", "transaction_type", "debit_amount", "credit_amount", "description"], []),
    "dq6a_missing_from_target": (
        ["transaction_id", "posting_date", "gl_account", "net_amount", "transaction_type"], ["source_ref"],
    ),
    "dq6b_orphan_target": (["transaction_id"], ["ledger_id", "source_ref", "posting_date", "net_amount"]),
    "dq6c_value_discrepancy": (
        ["transaction_id", "posting_date", "gl_account", "net_amount"], ["source_ref", "net_amount"],
    ),
    "dq6d_recon_summary": (["transaction_id"], ["source_ref"]),
    "dq7a_entity_balance": (["entity", "debit_amount", "credit_amount"], []),
    "dq7b_batch_integrity": (["transaction_type", "batch_id", "debit_amount", "credit_amount"], []),
    "dq8b_singleton_batch": (["batch_id"], []),
}
_COUNT_NEEDS = {
    "dq1a_null_mandatory_source": ["transaction_id", "posting_date", "gl_account", "debit_amount", "credit_amount"],
    "dq1b_null_mandatory_target": ["ledger_id", "source_ref", "posting_date", "debit_amount", "credit_amount"],
    "dq1c_missing_vendor_invoice": ["transaction_type", "vendor_id"],
    "dq2a_duplicate_transaction_id": ["transaction_id"],
    "dq2c_duplicate_ledger_id": ["ledger_id"],
    "dq3a_negative": ["debit_amount", "credit_amount"],
    "dq3b_net_amount": ["net_amount", "debit_amount", "credit_amount"],
    "dq3d_zero_value": ["debit_amount", "credit_amount"],
    "dq4a_future_posting": ["posting_date"],
    "dq4b_value_date_lag": ["posting_date", "value_date"],
    "dq4c_out_of_period": ["posting_date"],
    "dq5a_gl": ["gl_account"],
    "dq5b_cost_centre": ["cost_centre"],
    "dq5c_entity": ["entity"],
    "dq8a_posted_without_user": ["status", "created_by"],
}


def with_catalogue_names(source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with the catalogue's names for columns they have under another one."""

    def named(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
        new = {k: v for k, v in aliases.items() if k not in df.columns and v in df.columns}
        return catalogue_columns(df, **new)

    return named(source, SOURCE_ALIASES), named(target, TARGET_ALIASES)


def missing_columns(source: DataFrame, target: DataFrame) -> dict[str, list[str]]:
    """The rules that cannot run on these tables, each with the columns it lacks."""
    needs = {k: (c, []) if COUNT_RULES[k] == SOURCE else ([], c) for k, c in _COUNT_NEEDS.items()} | _NEEDS
    lacking = {
        k: [f"{SOURCE}.{c}" for c in s if c not in source.columns] + [f"{TARGET}.{c}" for c in t if c not in target.columns]
        for k, (s, t) in needs.items()
    }
    return {k: c for k, c in lacking.items() if c}


def all_rules(source: DataFrame, target: DataFrame, rules: Rules = DEFAULT_RULES) -> dict[str, DataFrame]:
    """Every rule of the catalogue whose columns exist, by name, the counting rules as one table; and
    ``dq_not_run``, the rules that could not run with the columns they lack."""
    lacking = missing_columns(source, target)
    built = {
        "dq2b_duplicate_audit": lambda: duplicate_audit(source),
        "dq3c_outliers": lambda: outliers(source, rules),
        "dq6a_missing_from_target": lambda: missing_from_target(source, target),
        "dq6b_orphan_target": lambda: orphan_target(source, target),
        "dq6c_value_discrepancy": lambda: value_discrepancies(source, target, rules),
        "dq6d_recon_summary": lambda: recon_summary(source, target),
        "dq7a_entity_balance": lambda: entity_balance(source, rules),
        "dq7b_batch_integrity": lambda: batch_integrity(source, rules),
        "dq8b_singleton_batch": lambda: singleton_batches(source),
    }
    counting = [k for k in COUNT_RULES if k not in lacking]
    not_run = [(k, ", ".join(c)) for k, c in lacking.items()]
    return {
        "dq_report": count_report(source, target, rules, counting),
        **{k: build() for k, build in built.items() if k not in lacking},
        "dq_not_run": source.sparkSession.createDataFrame(not_run, "rule STRING, missing_columns STRING"),
    }
