"""Totals without pairs against brute force over all pairs."""

import bisect
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from conftest import records
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from sparkrecon.functions import money_net, money_sum
from sparkrecon.operators import crowded, reconcile, totals
from sparkrecon.params import Rules

SOURCE = "transaction_id STRING, debit_amount DOUBLE, credit_amount DOUBLE"
TARGET = "ledger_transaction_id STRING, debit_amount DOUBLE, credit_amount DOUBLE"

# Few keys and close amounts, so that most keys repeat and many pairs are near the tolerance.
keys = st.sampled_from(["A", "B", "C", "", None])
amounts = st.one_of(
    st.none(),
    st.sampled_from([0.0, 1.0, 1.005, 1.01, 1.02, -1.0, 500.0, 500.01, 500.02, 1e6, 1e16]),
    st.integers(-300, 300).map(lambda cents: cents / 100),
    st.integers(0, 40).map(lambda n: 7 + n / 1000),
    st.integers(0, 400).map(lambda n: 3 + n * 3 / 1000000),
)
tables = st.lists(st.tuples(keys, amounts, amounts), max_size=25)
slow = settings(
    max_examples=7,
    phases=[Phase.generate],  # no shrinking: each example costs seconds
    derandomize=True,
    database=None,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def rounded(a, b):
    """The difference of two amounts as they are written, half away from zero to 4 places."""
    with localcontext(prec=60):
        a, b = (Decimal(repr(x)).quantize(Decimal(1).scaleb(-17), ROUND_HALF_UP) for x in (a, b))
        return float((a - b).quantize(Decimal("0.0001"), ROUND_HALF_UP))


def brute(source, target, tolerance, match_null):
    """Status counts and summed differences, filled form."""
    count = dict.fromkeys(["MATCHED", "AMOUNT_DISCREPANCY", "MISSING_IN_TARGET", "MISSING_IN_SOURCE"], 0)
    sums = [0.0, 0.0]

    def same(a, b):
        return a == b and (a is not None or match_null)

    for key, *amounts in source:
        partners = [t for t in target if same(key, t[0])]
        count["MISSING_IN_TARGET"] += not partners
        for partner in partners:
            both = [(a or 0.0, b or 0.0) for a, b in zip(amounts, partner[1:])]
            if max(abs(a - b) for a, b in both) > tolerance:
                count["AMOUNT_DISCREPANCY"] += 1
                sums = [s + rounded(*p) for s, p in zip(sums, both)]
            else:
                count["MATCHED"] += 1
    count["MISSING_IN_SOURCE"] = sum(not any(same(s[0], t[0]) for s in source) for t in target)
    return count, sums


def brute_sql(source, target, tolerance):
    """Status counts, SQL form."""
    count = dict.fromkeys(["MATCHED", "AMOUNT_DISCREPANCY", "MISSING_IN_TARGET", "MISSING_IN_SOURCE"], 0)

    def far(a, b):
        return a is not None and b is not None and abs(a - b) > tolerance

    for key, *amounts in source:
        partners = [t for t in target if key is not None and key == t[0]]
        if not partners:
            count["MISSING_IN_SOURCE" if key is None else "MISSING_IN_TARGET"] += 1
        for partner in partners:
            off = any(far(a, b) for a, b in zip(amounts, partner[1:]))
            count["AMOUNT_DISCREPANCY" if off else "MATCHED"] += 1
    count["MISSING_IN_SOURCE"] += sum(
        t[0] is None or all(s[0] != t[0] for s in source) for t in target
    )
    return count


def statuses(row):
    return {
        "MATCHED": row["matched"],
        "AMOUNT_DISCREPANCY": row["amount_discrepancies"],
        "MISSING_IN_TARGET": row["missing_in_target"],
        "MISSING_IN_SOURCE": row["missing_in_source"],
    }


@pytest.mark.parametrize("null_keys", ["match", "never"])
@slow
@given(source=tables, target=tables, tolerance=st.sampled_from([0.01, 0.0, 0.5]))
def test_reconcile_totals(spark, null_keys, source, target, tolerance):
    s, t = spark.createDataFrame(source, SOURCE), spark.createDataFrame(target, TARGET)
    (row,) = records(totals.reconcile_totals(s, t, Rules(tolerance=tolerance), null_keys))
    count, sums = brute(source, target, tolerance, null_keys == "match")
    assert statuses(row) == count
    for name, want in zip(("net_debit_delta_gbp", "net_credit_delta_gbp"), sums):
        assert row[name] == pytest.approx(want, rel=1e-12, abs=1e-6)


@slow
@given(source=tables, target=tables)
def test_status_kpis(spark, source, target):
    s, t = spark.createDataFrame(source, SOURCE), spark.createDataFrame(target, TARGET)
    (row,) = records(totals.status_kpis(s, t))
    count = brute_sql(source, target, 0.01)
    assert statuses(row) == count
    assert row["total_records"] == sum(count.values())


def with_attributes(df):
    nothing = {c: "CAST(NULL AS STRING)" for c in reconcile.ATTRIBUTES}
    return df.selectExpr("*", *[f"{v} AS {k}" for k, v in nothing.items()])


@slow
@given(
    source=tables,
    target=tables,
    null_keys=st.sampled_from(["match", "never"]),
)
def test_detail(spark, source, target, null_keys):
    """The statuses of the rows are those of brute force."""
    s = with_attributes(spark.createDataFrame(source, SOURCE))
    t = with_attributes(spark.createDataFrame(target, TARGET))
    detail = reconcile.reconcile(s, t, Rules(), null_keys)
    (row,) = records(reconcile.summarize(detail))
    assert statuses(row) == brute(source, target, 0.01, null_keys == "match")[0]


unique = st.lists(st.integers(0, 40), unique=True, max_size=30)


@slow
@given(source=unique, target=unique)
def test_unique_keys_partition_and_swap(spark, source, target):
    """With unique keys the statuses partition the union of keys, and swapping the sides swaps the
    two missing statuses."""

    def run(a, b):
        s = spark.createDataFrame([(f"K{k}", float(k % 3), 0.0) for k in a], SOURCE)
        t = spark.createDataFrame([(f"K{k}", float(k % 2), 0.0) for k in b], TARGET)
        return statuses(records(totals.reconcile_totals(s, t))[0])

    there, back = run(source, target), run(target, source)
    assert sum(there.values()) == len(set(source) | set(target))
    assert there["MISSING_IN_TARGET"] == back["MISSING_IN_SOURCE"] == len(set(source) - set(target))
    assert there["MISSING_IN_SOURCE"] == back["MISSING_IN_TARGET"]


@pytest.mark.parametrize("null_keys", ["match", "never"])
@pytest.mark.parametrize("places", [2, 4, 5, 6, 17])
def test_totals_equal_their_rows(spark, places, null_keys):
    """Amounts of any number of places, some of them huge, on four keys and missing ones."""
    rng = random.Random(places)

    def rows(n):
        values = [rng.choice([1, 1, 1, 1e12]) * round(rng.uniform(0, 30), places) for _ in range(2 * n)]
        return [(rng.choice(["A", "B", "C", "D", None]), values[i], values[n + i]) for i in range(n)]

    s, t = spark.createDataFrame(rows(120), SOURCE), spark.createDataFrame(rows(90), TARGET)
    (got,) = records(totals.reconcile_totals(s, t, Rules(), null_keys))
    detail = reconcile.reconcile(with_attributes(s), with_attributes(t), Rules(), null_keys)
    (want,) = records(reconcile.summarize(detail))
    assert got == {k: v if isinstance(v, int) else pytest.approx(v, rel=1e-12, abs=1e-9) for k, v in want.items()}


def test_a_tolerance_of_any_size(spark):
    s = spark.createDataFrame([("A", 1.0, 0.0), ("A", 5e8, 0.0), ("A", 3.0, 0.0)], SOURCE)
    t = spark.createDataFrame([("A", 2.0, 0.0), ("A", 4.0, 0.0)], TARGET)
    (row,) = records(totals.reconcile_totals(s, t, Rules(tolerance=1e7)))
    assert (row["matched"], row["amount_discrepancies"], row["net_debit_delta_gbp"]) == (4, 2, 2 * 5e8 - 6)


def test_more_pairs_than_a_bigint_holds(spark):
    n = F.lit(4_000_000_000)
    (found,) = spark.range(1).select(totals.times(n, n).alias("n")).collect()
    assert int(found["n"]) == 16 * 10**18


@pytest.mark.parametrize("value, times", [(4e-9, 100_000), (1e-9, 1000), (1e15, 1000), (1e16, 1000), (0.1, 1000), (1e300, 3)])
def test_sums_drop_nothing(spark, value, times):
    df = spark.range(times).select(F.lit(value).alias("x"), (F.lit(value) * 3).alias("y"))
    total, net = df.agg(money_sum(F.col("x")), money_net(F.col("y"), F.col("x"))).first()
    assert total == pytest.approx(value * times, rel=1e-9) and net == pytest.approx(2 * value * times, rel=1e-9)


def test_fine_amounts_carry(spark):
    """Fractions of 0.0001 on both sides of a repeated key with several amounts (none half way)."""
    source = [("A", 1 + i * 0.000031, 0.0) for i in range(9)]
    target = [("A", 2 + i * 0.000072, i * 0.00002) for i in range(7)]
    s, t = spark.createDataFrame(source, SOURCE), spark.createDataFrame(target, TARGET)
    (row,) = records(totals.reconcile_totals(s, t))
    want = sum(rounded(a[1], b[1]) for a in source for b in target)
    assert row["net_debit_delta_gbp"] == pytest.approx(want, abs=1e-9)
    assert row["amount_discrepancies"] == 63


def _pair_of(spark, source, target):
    return spark.createDataFrame(source, SOURCE).repartition(4), spark.createDataFrame(target, TARGET).repartition(4)


@pytest.mark.parametrize("places", [5, 6, 17])
def test_fine_amounts_of_one_key_equal_their_rows(spark, places):
    """All pairs of a key with amounts of many places, exact halves and both signs among them."""
    rng = random.Random(places)

    def amount():
        x = rng.uniform(-3, 3) if rng.random() < 0.8 else rng.uniform(0, 0.03)
        return x if places == 17 else round(x, places)

    source = [(rng.choice(["A", None]), amount(), amount()) for _ in range(150)]
    target = [(rng.choice(["A", None]), amount(), amount()) for _ in range(120)]
    if places == 5:  # halves of 0.0001, above and below 0
        source += [("A", 0.00005 * i, -0.00005 * i) for i in range(1, 40)]
        target += [("A", 0.0001 * i, 0.00005 * i) for i in range(1, 40)]
    s, t = _pair_of(spark, source, target)
    (row,) = records(totals.reconcile_totals(s, t))
    count, sums = brute(source, target, 0.01, True)
    assert statuses(row) == count
    got = (row["net_debit_delta_gbp"], row["net_credit_delta_gbp"])
    assert got == pytest.approx(sums, rel=1e-13, abs=1e-7)
    detail = with_attributes(s), with_attributes(t)
    (rows,) = records(reconcile.summarize(reconcile.reconcile(*detail)))
    assert got == (rows["net_debit_delta_gbp"], rows["net_credit_delta_gbp"])


def test_dust_on_a_hot_key(spark):
    """50,000 rows a side of one key whose amounts carry binary dust: 2.5e9 pairs that are never formed."""
    ids = spark.range(0, 50_000, 1, 8)
    cents = (F.col("id") * 7919 % 1_000_003) / 100
    s = ids.select(F.lit("HOT").alias("transaction_id"), cents.alias("debit_amount"), F.lit(0.0).alias("credit_amount"))
    t = ids.select(
        F.lit("HOT").alias("ledger_transaction_id"), (cents + F.when(F.col("id") % 2 == 0, 0.05).otherwise(0.005)).alias("debit_amount"),
        F.lit(0.0).alias("credit_amount"),
    )
    found = totals.reconcile_totals(s, t)
    (row,) = records(found)
    # Cents on both sides: how often each distance occurs follows from sorted amounts.
    mine = sorted(i * 7919 % 1_000_003 * 10 for i in range(50_000))
    other = sorted(i * 7919 % 1_000_003 * 10 + (50 if i % 2 == 0 else 5) for i in range(50_000))
    # Half-cents apart are within a cent; a full cent apart is decided by the doubles.
    exact = sum(a - b for a, b in ((sum(mine), sum(other)),)) * 50_000
    near = sure = 0
    for x in mine:
        near += bisect.bisect_right(other, x + 10) - bisect.bisect_left(other, x - 10)
        sure += bisect.bisect_right(other, x + 9) - bisect.bisect_left(other, x - 9)
    assert row["matched"] + row["amount_discrepancies"] == 2_500_000_000
    assert sure <= row["matched"] <= near
    assert abs(row["net_debit_delta_gbp"] - exact / 1000) <= (near - sure) * 0.011 + sure * 0.01


def test_many_amounts_in_one_cell(spark):
    """100,000 amounts of one key within one tolerance: products of boxes and few rows, no square."""
    n = 100_000
    ids = spark.range(0, n, 1, 8)
    s = ids.select(F.lit("K").alias("transaction_id"), (10 + F.col("id") * 4e-7).alias("debit_amount"), F.lit(0.0).alias("credit_amount"))
    t = ids.select(F.lit("K").alias("ledger_transaction_id"), (10.00000013 + F.col("id") * 4e-7).alias("debit_amount"), F.lit(0.0).alias("credit_amount"))
    (row,) = records(totals.reconcile_totals(s, t))
    mine = [10 + i * 4e-7 for i in range(n)]
    other = [10.00000013 + i * 4e-7 for i in range(n)]
    matched, low, high = 0, 0, 0
    for x in mine:
        while low < n and x - other[low] > 0.01:
            low += 1
        while high < n and other[high] - x <= 0.01:
            high += 1
        matched += high - low
    assert (row["matched"], row["amount_discrepancies"]) == (matched, n * n - matched)
    # In units of 1e-8 the difference of rows i and j is 40 (i - j) - 13, never halfway between two roundings.
    gaps = [(n - abs(k), 40 * k - 13) for k in range(1 - n, n)]
    far = sum(times * round(gap / 10_000) for times, gap in gaps if abs(gap) > 1_000_000)
    assert row["net_debit_delta_gbp"] == pytest.approx(far / 10_000, rel=1e-12, abs=1e-4)


def test_crowded_cells_in_both_amounts(spark, monkeypatch):
    """Debits and credits that both vary within the tolerance, missing amounts and ids among them."""
    monkeypatch.setattr(totals, "CROWD", 5)
    monkeypatch.setattr(crowded, "FEW", 3)
    rng = random.Random(4)

    def side(n):
        return [(rng.choice(["A", "B", None]), rng.choice([rng.uniform(-0.02, 0.02), 0.0, 0.01]), rng.uniform(5, 5.03)) for _ in range(n)]

    source, target = side(160), side(140)
    (row,) = records(totals.reconcile_totals(*_pair_of(spark, source, target)))
    count, sums = brute(source, target, 0.01, True)
    assert statuses(row) == count
    assert (row["net_debit_delta_gbp"], row["net_credit_delta_gbp"]) == pytest.approx(sums, rel=1e-12, abs=1e-6)
    holes = [(k, d if rng.random() < 0.8 else None, c) for k, d, c in source]
    (row,) = records(totals.status_kpis(*_pair_of(spark, holes, target)))
    assert statuses(row) == brute_sql(holes, target, 0.01)


@slow
@given(source=tables, target=tables)
def test_account_discrepancies(spark, source, target):
    """Counted per account without rows, equal to the count over the detail."""
    source = [(*r, ["1000", "2100", None][i % 3]) for i, r in enumerate(source)]
    s = spark.createDataFrame(source, f"{SOURCE}, gl_account STRING")
    t = spark.createDataFrame(target, TARGET)
    got = {r["gl_account"]: r["discrepancies"] for r in records(totals.account_discrepancies(s, t)) if r["discrepancies"]}
    full = s.selectExpr("*", *[f"CAST(NULL AS STRING) AS {c}" for c in reconcile.ATTRIBUTES if c != "gl_account"])
    rows = reconcile.discrepancies(reconcile.reconcile(full, with_attributes(t)))
    want = {}
    for r in records(rows):
        if r["gl_account_src"] is not None:
            want[r["gl_account_src"]] = want.get(r["gl_account_src"], 0) + 1
    assert got == want
