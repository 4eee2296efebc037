"""Amounts as DECIMAL(18,4): a cent is a cent, in the detail, the figures and the stages."""

import csv
import glob
import random
from decimal import Decimal

import pytest
from conftest import records
from test_totals import with_attributes

from sparkrecon import __main__ as cli
from sparkrecon.operators import reconcile, totals
from sparkrecon.params import Rules
from sparkrecon.schemas import SOURCE_SCHEMA, TARGET_SCHEMA

DECIMAL = Rules(amounts="decimal")
SOURCE = "transaction_id STRING, debit_amount DOUBLE, credit_amount DOUBLE"
TARGET = "ledger_transaction_id STRING, debit_amount DOUBLE, credit_amount DOUBLE"


def _brute(source, target, tolerance="0.01"):
    cents = lambda x: Decimal(repr(x or 0.0)).quantize(Decimal("0.0001"))
    counts, sums = [0, 0, 0, 0], [Decimal(0), Decimal(0)]
    for key, *amounts in source:
        partners = [t for t in target if t[0] == key]
        counts[2] += not partners
        for p in partners:
            gaps = [cents(a) - cents(b) for a, b in zip(amounts, p[1:])]
            far = max(map(abs, gaps)) > Decimal(tolerance)
            counts[far] += 1
            sums = [s + g * far for s, g in zip(sums, gaps)]
    counts[3] = sum(all(s[0] != t[0] for s in source) for t in target)
    return counts, [float(s) for s in sums]


@pytest.mark.parametrize("tolerance", [0.01, 0.0])
def test_detail_and_figures(spark, tolerance):
    rng = random.Random(7)
    amount = lambda: rng.choice([None, 0.0, rng.randint(0, 500) / 100, 1e6 + rng.randint(0, 30) / 100, rng.randint(0, 300) / 10_000])
    source = [(rng.choice(["A", "B", "C", None, f"U{i}"]), amount(), amount()) for i in range(60)]
    target = [(rng.choice(["A", "B", "D", None, f"U{i}"]), amount(), amount()) for i in range(60)]
    s, t = spark.createDataFrame(source, SOURCE), spark.createDataFrame(target, TARGET)
    rules = Rules(amounts="decimal", tolerance=tolerance)
    counts, sums = _brute(source, target, str(tolerance))
    rows = reconcile.reconcile(with_attributes(s), with_attributes(t), rules)
    assert dict(rows.dtypes)["src_debit"] == "decimal(18,4)" and dict(rows.dtypes)["debit_delta"] == "decimal(19,4)"
    for found in (totals.reconcile_totals(s, t, rules), reconcile.summarize(rows)):
        (row,) = records(found)
        assert [row[c] for c in ("matched", "amount_discrepancies", "missing_in_target", "missing_in_source")] == counts
        assert [row["net_debit_delta_gbp"], row["net_credit_delta_gbp"]] == sums


def test_a_cent_is_never_flagged(spark):
    """Every amount against the one a cent above: doubles flag about half of them, decimals none."""
    source = [(f"T{i}", i / 100, 0.0) for i in range(1, 2000)]
    target = [(f"T{i}", (i + 1) / 100, 0.0) for i in range(1, 2000)]
    s, t = spark.createDataFrame(source, SOURCE), spark.createDataFrame(target, TARGET)
    (row,) = records(totals.reconcile_totals(s, t, DECIMAL))
    assert (row["matched"], row["amount_discrepancies"]) == (1999, 0)
    (row,) = records(totals.reconcile_totals(s, t))
    assert 0 < row["amount_discrepancies"] < 1999
    with pytest.raises(ValueError, match="amounts must be"):
        Rules(amounts="float")


@pytest.mark.parametrize("detail_fmt", ["csv", "parquet"])
def test_stages(spark, tmp_path, detail_fmt):
    """Text becomes decimals at once, so amounts of 18 digits keep them all."""
    wide = {"S1": ("12345678901234.0001", "12345678901234.0101"), "S2": ("12345678901234.0001", "12345678901234.0102"), "S3": ("0.3", "0.31")}
    for name, schema, key, side in (("s", SOURCE_SCHEMA, "transaction_id", 0), ("t", TARGET_SCHEMA, "ledger_transaction_id", 1)):
        with open(tmp_path / f"{name}.csv", "w", encoding="utf-8", newline="") as f:
            out = csv.DictWriter(f, schema.names)
            out.writeheader()
            out.writerows({key: k, "debit_amount": v[side], "credit_amount": "0"} for k, v in wide.items())
    rules = tmp_path / "rules.json"
    rules.write_text('{"amounts": "decimal"}')
    out = str(tmp_path / "out")
    cli.main(["all", "--source", str(tmp_path / "s.csv"), "--target", str(tmp_path / "t.csv"), "--out", out,
              "--rules", str(rules), "--detail-format", detail_fmt])
    (path,) = glob.glob(f"{out}/reconciliation_summary/*.csv")
    with open(path, encoding="utf-8") as f:
        (row,) = csv.DictReader(f)
    assert (row["matched"], row["amount_discrepancies"], float(row["net_debit_delta_gbp"])) == ("2", "1", -0.0101)
    found = spark.read.format(detail_fmt).options(header=True).load(f"{out}/discrepancies").collect()
    assert [(r["key"], str(r["src_debit"]), str(r["debit_delta"])) for r in found] == [("S2", "12345678901234.0001", "-0.0101")]
