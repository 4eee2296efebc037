"""Command line: python -m sparkrecon {ingest,check,reconcile,report,all,queries} --source .. --target .. --out .."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import SparkSession

from .operators.checks import quality_summary
from .params import DEFAULT_RULES, Rules
from .plans import stages


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sparkrecon", description=__doc__)
    parser.add_argument("stage", choices=["ingest", "check", "reconcile", "report", "all", "queries"])
    parser.add_argument("--source", required=True, help="transactions: file or folder")
    parser.add_argument("--target", required=True, help="ledger: file or folder")
    parser.add_argument("--out", required=True, help="folder for the results")
    parser.add_argument("--format", default="csv", help="input format: csv, parquet, orc")
    parser.add_argument("--detail-format", default="parquet", help="format of row-level results")
    parser.add_argument("--null-keys", choices=["match", "never"], help="whether missing ids are equal; match if not given")
    parser.add_argument("--rules", help='JSON file of rules to change, such as {"tolerance": 0.05, "as_of": "2024-06-30"}')
    args = parser.parse_args(argv)
    rules = Rules.from_json(Path(args.rules).read_text()) if args.rules else DEFAULT_RULES

    spark = SparkSession.builder.appName("sparkrecon").getOrCreate()
    job = stages.Job(spark, args.source, args.target, args.out, args.format, args.detail_format, rules)
    if args.stage == "ingest":
        stages.run_ingestion(job)
    elif args.stage == "check":
        found = stages.run_checks(job)
        found.show(100, truncate=False)
        quality_summary(found).show(truncate=False)
    elif args.stage == "reconcile":
        stages.run_reconciliation(job, args.null_keys or "match").show(truncate=False)
    elif args.stage == "report":
        stages.run_report(job, args.null_keys)["report_statement"].show(truncate=False)
    elif args.stage == "queries":
        print("\n".join(stages.run_queries(job)))
    else:
        stages.run_all(job)["report_statement"].show(truncate=False)


if __name__ == "__main__":
    main()
