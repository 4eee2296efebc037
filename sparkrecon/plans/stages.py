"""The stages end to end: ingest, check, reconcile, report; and the query catalogues.

Tables handed from one stage to the next are written once, in a columnar format, so a later stage
neither recomputes them nor depends on the executors that made them. Small results are CSV.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import checks, dq, ingest, recon_sql, reconcile, report
from ..params import DEFAULT_RULES, Rules
from ..schemas import SOURCE_SCHEMA, TARGET_SCHEMA
from ..sources import load_table, schema_diff, write_table
from .runs import Run, fingerprint, write_counted

DETAIL, DISCREPANCIES = "reconciliation_detail", "discrepancies"
SUMMARY, CHECKS = "reconciliation_summary", "quality_check_report"


@dataclass(frozen=True)
class Job:
    """Where a run reads and writes. ``fmt`` is the input format; ``detail_fmt`` that of the
    row-level outputs."""

    spark: SparkSession
    source_path: str
    target_path: str
    out: str
    fmt: str = "csv"
    detail_fmt: str = "parquet"
    rules: Rules = DEFAULT_RULES

    def source(self) -> DataFrame:
        return self._load(self.source_path, SOURCE_SCHEMA, "source transactions")

    def target(self) -> DataFrame:
        return self._load(self.target_path, TARGET_SCHEMA, "target ledger")

    def _load(self, path: str, schema: T.StructType, label: str) -> DataFrame:
        decimals = ("debit_amount", "credit_amount") if self.rules.amounts == "decimal" else ()
        return load_table(self.spark, path, schema, label, self.fmt, decimals)

    def path(self, name: str) -> str:
        return f"{self.out.rstrip('/')}/{name}"

    def save_small(self, df: DataFrame, name: str) -> DataFrame:
        """A result of a few rows: one CSV file."""
        write_table(df.coalesce(1), self.path(name), "csv")
        return df

    def run(self) -> Run:
        return Run(self.spark, self.out.rstrip("/"))

    def fingerprint(self) -> str:
        return fingerprint(self.spark, self.source_path, self.target_path, self.fmt, self.rules)


def run_ingestion(job: Job, land: bool = True) -> Job:
    """Validate both inputs, and land them as typed parquet tables for the later stages."""
    facts = job.run().begin("ingestion")
    source, target = job.source(), job.target()
    diff = schema_diff(source, SOURCE_SCHEMA, "source").unionByName(
        schema_diff(target, TARGET_SCHEMA, "target")
    )
    job.save_small(diff, "schema_diff")
    landed = job
    if land and job.fmt == "csv":
        facts["source_rows"] = write_counted(source, job.path("landing/source"), "parquet")
        facts["target_rows"] = write_counted(target, job.path("landing/target"), "parquet")
        landed = replace(job, source_path=job.path("landing/source"), target_path=job.path("landing/target"), fmt="parquet")
        source, target = landed.source(), landed.target()
    found = {
        "source": (source, ingest.validate_source(source, job.rules)),
        "target": (target, ingest.validate_target(target, job.rules)),
    }
    for name, (df, metrics) in found.items():
        job.save_small(metrics, f"ingestion_metrics_{name}")
        job.save_small(ingest.financial_summary(df, metrics, name), f"ingestion_summary_{name}")
        if f"{name}_rows" not in facts:  # counted for the summary
            written = job.spark.read.csv(job.path(f"ingestion_summary_{name}"), header=True)
            facts[f"{name}_rows"] = int(written.first()["row_count"])
    job.run().end("ingestion", facts)
    return landed


def run_checks(job: Job) -> DataFrame:
    found = checks.quality_report(job.source(), job.target(), job.rules)
    return job.save_small(found, CHECKS)


def run_reconciliation(job: Job, null_keys: str = "match") -> DataFrame:
    """Write detail, discrepancies and summary; the join runs once. Returns the summary.

    Discrepancies are written in the order of their keys, missing keys last: the part files in the order
    of their names are one sorted list. A run manifest is written last.
    """
    facts: dict[str, object] = job.run().begin("reconciliation")
    made_of = job.fingerprint()
    found = reconcile.reconcile(job.source(), job.target(), job.rules, null_keys)
    # By status, a reader of discrepancies opens the files of matched rows not at all.
    by = "reconciliation_status" if job.detail_fmt != "csv" else None
    facts["joined_rows"] = write_counted(found, job.path(DETAIL), job.detail_fmt, by)
    detail = _detail(job)
    ordered = reconcile.in_key_order(reconcile.discrepancies(detail))
    facts["discrepancies"] = write_counted(ordered, job.path(DISCREPANCIES), job.detail_fmt)
    summary = job.save_small(reconcile.summarize(detail), SUMMARY)
    job.run().end("reconciliation", facts | {"fingerprint": made_of, "null_keys": null_keys, "format": job.detail_fmt})
    return summary


def _detail(job: Job) -> DataFrame:
    read = job.spark.read.format(job.detail_fmt)
    if job.detail_fmt == "csv":
        number = T.DoubleType() if job.rules.amounts == "double" else T.DecimalType(19, 4)
        columns = [
            T.StructField(c, number if c in reconcile.DETAIL_NUMBERS else T.StringType())
            for c in reconcile.DETAIL_COLUMNS
        ]
        read = read.options(header=True, escape='"').schema(T.StructType(columns))
    return read.load(job.path(DETAIL)).select(*reconcile.DETAIL_COLUMNS)


def run_report(job: Job, null_keys: str | None = None) -> dict[str, DataFrame]:
    """Write the governance tables. The reconciliation runs first if there is none in the folder, or one
    of other inputs, rules, format or (if given) another treatment of missing keys."""
    done = job.run().facts("reconciliation")
    wanted = {"fingerprint": job.fingerprint(), "format": job.detail_fmt} | ({"null_keys": null_keys} if null_keys else {})
    if any(done.get(k) != v for k, v in wanted.items()):
        run_reconciliation(job, null_keys or "match")
        done = job.run().facts("reconciliation")
    job.run().begin("report")
    detail = _detail(job)
    summary = reconcile.summarize(detail)
    register = report.discrepancy_register(reconcile.in_key_order(reconcile.discrepancies(detail)))
    accounts = report.gl_analysis(job.source(), detail, job.rules)
    tables = {
        "report_kpis": report.kpi_tiles(summary, job.rules),
        "report_statement": report.statement(summary),
        "report_gl_analysis": accounts.withColumnsRenamed(report.GL_HEADERS),
    }
    for name, df in tables.items():
        job.save_small(df, name)
    shown = register.withColumnsRenamed(report.REGISTER_HEADERS)
    listed = write_counted(shown, job.path("report_discrepancy_register"), "csv")
    facts = job.run().facts("ingestion") | done | {"report_tables": len(tables) + 2, "register_rows": listed}
    trail = report.audit_trail(summary, job.source(), job.target(), _written_checks(job), job.rules, facts)
    job.save_small(trail, "report_audit_trail")
    job.run().end("report", {"tables": len(tables) + 2, "register_rows": listed})
    return tables | {"report_audit_trail": trail, "report_discrepancy_register": shown}


def _written_checks(job: Job) -> DataFrame | None:
    """The check report of this run, if the stage ran."""
    try:
        return job.spark.read.csv(job.path(CHECKS), header=True, escape='"').select("dataset", "status")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def run_queries(job: Job) -> list[str]:
    """Write the result of each reconciliation query and of each rule of the catalogue whose columns
    exist; ``dq_not_run`` lists the other rules. Returns the names of the results."""
    source = dq.with_dates(job.source(), job.rules)
    target = dq.with_dates(job.target(), job.rules)
    found = recon_sql.all_queries(source, target, job.rules)
    found |= dq.all_rules(*dq.with_catalogue_names(source, target), job.rules)
    for name, df in found.items():
        write_table(df, job.path(f"queries/{name}"), job.detail_fmt)
    return list(found)


def run_all(job: Job) -> dict[str, DataFrame]:
    landed = run_ingestion(job)
    found = run_checks(landed)
    run_reconciliation(landed)
    return {CHECKS: found, "quality_summary": checks.quality_summary(found)} | run_report(landed)
