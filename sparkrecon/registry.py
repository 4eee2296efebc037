"""Query key -> Spark query over the tables of a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fixtures import FIXTURE_RULES as RULES
from .fixtures import view
from .functions import money_sum
from .operators import checks, dq, ingest, masters, recon_sql, reconcile, report, totals
from .schemas import SOURCE_SCHEMA, TARGET_SCHEMA
from .sources import load_csv, schema_diff, shared_folder, typed, write_table

Query = Callable[[SparkSession, str], DataFrame]


def _on(names: list[str], build: Callable[..., DataFrame]) -> Query:
    """A query that builds its result from the named views."""
    return lambda spark, sf_dir: build(*[view(spark, sf_dir, n) for n in names])


_source = partial(_on, ["source_transactions"])
_target = partial(_on, ["target_ledger"])
_pair = partial(_on, ["source_transactions", "target_ledger"])
_dq_source = partial(_on, ["dq_source"])
_dq_pair = partial(_on, ["dq_source", "dq_target"])
_hot_pair = partial(_on, ["hot_source", "hot_ledger"])
_lines = partial(_on, ["line_source"])


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _ingested(key: str, df: DataFrame) -> DataFrame:
    """What a typed input holds, in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("debit_amount").alias("debits_known"),
        F.count("credit_amount").alias("credits_known"),
        F.round(money_sum(F.col("debit_amount")), 4).alias("total_debit"),
        F.round(money_sum(F.col("credit_amount")), 4).alias("total_credit"),
        F.count(key).alias("keys_known"),
        F.min(key).alias("first_key"),
        F.max(key).alias("last_key"),
        F.max("posting_date").alias("last_posting"),
    )


def _from_text(name: str, schema: T.StructType, key: str) -> Query:
    return _on([name], lambda df: _ingested(key, typed(_as_text(df), schema)))


def _from_csv(name: str, schema: T.StructType, key: str) -> Query:
    """Writes the view as CSV files into the shared folder and scans those."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}.csv"
        write_table(_as_text(view(spark, sf_dir, name)), path)
        return _ingested(key, load_csv(spark, path, schema, name))

    return run


def _rows_from_csv(name: str, schema: T.StructType) -> Query:
    """The typed rows of a CSV input, every column of them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}.csv"
        write_table(view(spark, sf_dir, name), path)
        return load_csv(spark, path, schema, name)

    return run


def _schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    both = schema_diff(source, SOURCE_SCHEMA, "source").union(
        schema_diff(target, TARGET_SCHEMA, "target")
    )
    # Column names are metadata; the row count ties the answer to the table that was read.
    sizes = _size(source, "source").union(_size(target, "target"))
    return both.join(sizes, "dataset")


def _size(df: DataFrame, dataset: str) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.lit(dataset).alias("dataset"), "row_count")


def _financial_summary(source: DataFrame, target: DataFrame) -> DataFrame:
    return ingest.financial_summary(
        source, ingest.validate_source(source, RULES), "source"
    ).unionByName(ingest.financial_summary(target, ingest.validate_target(target, RULES), "target"))


def _ingest_queries() -> dict[str, Query]:
    source, target = "source_transactions", "target_ledger"
    return {
        "ingest_source": _from_text(source, SOURCE_SCHEMA, "transaction_id"),
        "ingest_target": _from_text(target, TARGET_SCHEMA, "ledger_transaction_id"),
        "ingest_csv_source": _from_csv(source, SOURCE_SCHEMA, "transaction_id"),
        "ingest_csv_target": _from_csv(target, TARGET_SCHEMA, "ledger_transaction_id"),
        "ingest_rows_source": _on(["raw_source"], lambda df: typed(df, SOURCE_SCHEMA)),
        "ingest_rows_target": _on(["raw_ledger"], lambda df: typed(df, TARGET_SCHEMA)),
        "ingest_csv_rows_source": _rows_from_csv("raw_source", SOURCE_SCHEMA),
        "ingest_csv_rows_target": _rows_from_csv("raw_ledger", TARGET_SCHEMA),
        "ingest_schema_diff": _pair(_schema_diff),
        "ingest_validate_source": _source(lambda s: ingest.validate_source(s, RULES)),
        "ingest_validate_target": _target(lambda t: ingest.validate_target(t, RULES)),
        "ingest_financial_summary": _pair(_financial_summary),
    }


def _check_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for i in range(1, 13):
        code = f"s{i:02d}"
        found[f"qc_{code}"] = _source(partial(checks.check_source, rules=RULES, only=code))
    for i in range(1, 5):
        code = f"t{i:02d}"
        found[f"qc_{code}"] = _target(partial(checks.check_target, rules=RULES, only=code))
    found["qc_report"] = _pair(lambda s, t: checks.quality_report(s, t, RULES))
    found["qc_summary"] = _pair(
        lambda s, t: checks.quality_summary(checks.quality_report(s, t, RULES))
    )
    return found


def _dq_queries() -> dict[str, Query]:
    found = {
        key: _on(["dq_source" if table == dq.SOURCE else "dq_target"], partial(_one_rule, key))
        for key, table in dq.COUNT_RULES.items()
    }
    found |= {
        "dq_report": _dq_pair(lambda s, t: dq.count_report(s, t, RULES)),
        "dq2b_duplicate_audit": _dq_source(dq.duplicate_audit),
        "dq3c_outliers": _dq_source(lambda s: dq.outliers(s, RULES)),
        "dq6a_missing_from_target": _dq_pair(dq.missing_from_target),
        "dq6b_orphan_target": _dq_pair(dq.orphan_target),
        "dq6c_value_discrepancy": _dq_pair(lambda s, t: dq.value_discrepancies(s, t, RULES)),
        "dq6d_recon_summary": _dq_pair(dq.recon_summary),
        "dq7a_entity_balance": _dq_source(lambda s: dq.entity_balance(s, RULES)),
        "dq7b_batch_integrity": _dq_source(lambda s: dq.batch_integrity(s, RULES)),
        "dq8b_singleton_batch": _dq_source(dq.singleton_batches),
        # The same rules on order lines: four times the rows, ids that repeat by themselves.
        "dq2a_lines": _lines(partial(_one_rule, "dq2a_duplicate_transaction_id")),
        "dq2b_lines": _lines(dq.duplicate_audit),
        "dq7b_lines": _lines(lambda s: dq.batch_integrity(s, RULES)),
        "dq8b_lines": _lines(dq.singleton_batches),
    }
    return found


def _master_queries() -> dict[str, Query]:
    """Membership of transaction ids in master lists that are tables."""
    id_col = "transaction_id"
    shown = ["transaction_id", "posting_date", "gl_account"]
    listed = partial(_on, ["source_transactions", "master_list"])
    both = partial(_on, ["source_transactions", "master_list", "master_list_null"])
    return {
        "master_not_in": listed(lambda s, m: masters.rows_not_in(s, id_col, m).select(*shown)),
        "master_not_in_with_null": _on(
            ["source_transactions", "master_list_null"], lambda s, m: masters.rows_not_in(s, id_col, m).select(*shown)
        ),
        "master_not_listed": listed(lambda s, m: masters.rows_not_listed(s, id_col, m).select(*shown)),
        "master_report": both(
            lambda s, m, n: masters.master_report(s, id_col, {"master_list": m, "master_list_null": n})
        ),
    }


def _one_rule(key: str, df: DataFrame) -> DataFrame:
    return dq.count_rule(df, key, RULES)


def _recon_sql_queries() -> dict[str, Query]:
    return {
        "rq1_row_counts": _pair(recon_sql.row_counts),
        "rq2_missing_in_target": _pair(recon_sql.missing_in_target),
        "rq3_missing_in_source": _pair(recon_sql.missing_in_source),
        "rq4_amount_discrepancy": _pair(lambda s, t: recon_sql.amount_discrepancies(s, t, RULES)),
        "rq5_detail": _pair(lambda s, t: recon_sql.detail(s, t, RULES)),
        "rq6_kpis": _pair(lambda s, t: recon_sql.kpis(s, t, RULES)),
        "rq6_kpis_hot_key": _hot_pair(lambda s, t: recon_sql.kpis(s, t, RULES)),
        "rq7_balance": _pair(lambda s, t: recon_sql.balance(s, t, RULES)),
        "rq8_freshness": _pair(lambda s, t: recon_sql.freshness(s, t, RULES)),
    }


def _detail(s: DataFrame, t: DataFrame) -> DataFrame:
    return reconcile.reconcile(s, t, RULES)


def _summary(s: DataFrame, t: DataFrame) -> DataFrame:
    return totals.reconcile_totals(s, t, RULES)


_DECIMAL = replace(RULES, amounts="decimal")


def _decimal_queries() -> dict[str, Query]:
    """Amounts as DECIMAL(18,4), against a ledger that is often off by exactly a cent."""
    cents = partial(_on, ["source_transactions", "cent_ledger"])

    def rows(s: DataFrame, t: DataFrame) -> DataFrame:
        found = reconcile.reconcile(s, t, _DECIMAL)
        return found.withColumns({c: F.col(c).cast("double") for c in reconcile.DETAIL_NUMBERS})

    return {
        "recon_detail_decimal": cents(rows),
        "recon_discrepancies_decimal": cents(lambda s, t: reconcile.discrepancies(rows(s, t))),
        "recon_summary_decimal": cents(lambda s, t: totals.reconcile_totals(s, t, _DECIMAL)),
        "report_gl_analysis_decimal": cents(
            lambda s, t: report.gl_accounts(s, totals.account_discrepancies(s, t, _DECIMAL), _DECIMAL)
        ),
    }


def _gl_analysis(s: DataFrame, t: DataFrame) -> DataFrame:
    return report.gl_accounts(s, totals.account_discrepancies(s, t, RULES), RULES)


def _recon_queries() -> dict[str, Query]:
    return {
        "recon_detail": _pair(_detail),
        "recon_detail_strict_keys": _pair(lambda s, t: reconcile.reconcile(s, t, RULES, "never")),
        "recon_discrepancies": _pair(lambda s, t: reconcile.discrepancies(_detail(s, t))),
        "recon_summary": _pair(_summary),
        "recon_summary_strict_keys": _pair(
            lambda s, t: totals.reconcile_totals(s, t, RULES, "never")
        ),
        "recon_summary_hot_key": _hot_pair(_summary),
        "recon_summary_from_detail": _pair(lambda s, t: reconcile.summarize(_detail(s, t))),
        "recon_ledger_entries": _pair(lambda s, t: reconcile.ledger_entries(_summary(s, t))),
        "key_match_rate": _pair(reconcile.key_match_rate),
    }


def _report_queries() -> dict[str, Query]:
    return {
        "report_kpis": _pair(lambda s, t: report.kpi_tiles(_summary(s, t), RULES)),
        "report_statement": _pair(lambda s, t: report.statement(_summary(s, t))),
        "report_discrepancy_register": _pair(
            lambda s, t: report.discrepancy_register(_detail(s, t))
        ),
        "report_gl_analysis": _pair(_gl_analysis),
        "report_gl_analysis_hot_key": _hot_pair(_gl_analysis),
        "report_audit_trail": _pair(
            lambda s, t: report.audit_trail(_summary(s, t), s, t, checks.quality_report(s, t, RULES), RULES)
        ),
    }


def queries() -> dict[str, Query]:
    return {
        **_ingest_queries(),
        **_check_queries(),
        **_dq_queries(),
        **_master_queries(),
        **_recon_sql_queries(),
        **_recon_queries(),
        **_decimal_queries(),
        **_report_queries(),
    }
