"""Reconciliation figures without the rows behind them.

A key with n transactions and m ledger entries stands for n * m reconciled rows. Where only the
figures are asked for, those pairs are not formed, so a key that holds a third of both tables does
not cost the square of its rows:

1. Each side shrinks to one row per key (count and amount range). The two meet in a full outer
   join that reuses the shuffle of that aggregation and has no fan-out. Unless a repeated key has
   differing amounts, its pairs all have the same status, which follows from that row.
2. For the remaining ("mixed") keys the pairs within tolerance are counted by a band join: amounts
   are laid on a grid of twice the tolerance, and a pair within tolerance lies in neighbouring
   grid cells. Cells with very many distinct amounts are compared as boxes (``crowded``). All other
   pairs are discrepancies.
3. The sum of the discrepancies' differences is the sum over all pairs less the sum over the pairs
   within tolerance. Differences are rounded one by one, and the sum over all pairs still follows from
   sums and positions of the n + m rows, also for amounts finer than 4 places (``products``).

Rows of mixed keys are kept in a table in the shared folder between the two steps, as distinct amounts
with their number.
"""

from __future__ import annotations

from dataclasses import replace
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import difference, exceeds, share_pct
from ..functions.values import split_amount
from ..params import DEFAULT_RULES, Rules
from ..plans.skew import ID as _ID
from ..plans.skew import KEY, TAG, tag_keys
from ..sources.tables import written
from .crowded import near_boxes, placed, rows_of
from .products import AMOUNTS, COUNT_TYPE, SUM_TYPE, sums_of_differences, times
from .reconcile import SOURCE_KEY, TARGET_KEY, for_reconciliation, summary_row

_COUNTS = ["matched", "amount_discrepancies", "missing_in_target", "missing_in_source"]
_DELTAS = ["debit_delta", "credit_delta"]
# What a decimal cannot hold of a difference is added up as a double beside the exact sums.
_REST = ["debit_rest", "credit_rest"]
_AMOUNT_TYPE = "decimal(24,4)"
# Amounts are finer than 4 places if they are further than this from 4 places, or so large that a double
# cannot tell. Two amounts nearer than that differ, rounded to 4 places, by the difference of their
# roundings; that takes in the binary dust of sums such as price + 0.05.
_DUST, _PLAIN = 1e-5, 1e11
# Distinct amounts of one key in a grid cell, above which it is compared as a box.
CROWD = 64


def reconcile_totals(
    source: DataFrame, target: DataFrame, rules: Rules = DEFAULT_RULES, null_keys: str = "match"
) -> DataFrame:
    """The nine figures of ``summarize(reconcile(...))``, computed without the reconciled rows."""
    s, t, rules, unit = _units(for_reconciliation(source, rules), for_reconciliation(target, rules), rules)
    left, right = _sides(s, t, null_keys)
    found = _totals(left, right, rules, with_deltas=True, null_source_missing=False)
    return summary_row(found.withColumns({c: F.col(c) / unit for c in _DELTAS} if unit != 1 else {}))


def _units(source: DataFrame, target: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame, Rules, int]:
    """In decimal mode amounts and tolerance as whole ten-thousandths, of which doubles add and subtract
    exactly what there is: then the figures are those of the decimals. Also the units in one."""
    if rules.amounts == "double":
        return source, target, rules, 1
    unit = 10_000

    def scaled(df: DataFrame) -> DataFrame:
        return df.withColumns({a: (F.col(a) * unit).cast("double") for a in ("debit_amount", "credit_amount")})

    return scaled(source), scaled(target), replace(rules, tolerance=float(Decimal(repr(rules.tolerance)) * unit)), unit


def status_kpis(source: DataFrame, target: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Status counts under SQL's rules for null: a null key equals nothing and makes its row
    MISSING_IN_SOURCE on either side, and a null amount never differs. The rate is over all rows."""
    left, right = _sides(source, target, "never")
    counts = _totals(left, right, rules, with_deltas=False, null_source_missing=True)
    matched = F.col("matched")
    off = F.col("missing_in_target") + F.col("missing_in_source") + F.col("amount_discrepancies")
    return counts.select(
        (matched + off).alias("total_records"),
        "matched",
        "missing_in_target",
        "missing_in_source",
        "amount_discrepancies",
        off.alias("total_discrepancies"),
        F.when(matched + off > 0, share_pct(matched, matched + off, 1)).alias(
            "reconciliation_rate_pct"
        ),
    )


def account_discrepancies(
    source: DataFrame, target: DataFrame, rules: Rules = DEFAULT_RULES, null_keys: str = "match"
) -> DataFrame:
    """(gl_account, discrepancies): how many rows of the detail that are not matched come from each
    account's transactions. Transactions without an account are not counted."""
    of = source.filter(F.col("gl_account").isNotNull())
    s, t, rules, _ = _units(for_reconciliation(of, rules), for_reconciliation(target, rules), rules)
    left, right = _sides(s, t, null_keys, ["gl_account"])
    counts = _totals(left, right, rules, with_deltas=False, null_source_missing=False, by=["gl_account"])
    off = F.col("amount_discrepancies") + F.col("missing_in_target")
    return counts.filter(F.col("gl_account").isNotNull()).select("gl_account", off.alias("discrepancies"))


def _sides(source: DataFrame, target: DataFrame, null_keys: str, by: list[str] | None = None):
    def narrow(df, key, extra):
        return df.select(
            F.col(key).alias("key"),
            F.col("debit_amount").cast("double").alias("d"),
            F.col("credit_amount").cast("double").alias("c"),
            *extra,
        )

    return tag_keys(
        narrow(source, SOURCE_KEY, by or []), narrow(target, TARGET_KEY, []), "key", "key", null_keys
    )


def _totals(
    left, right, rules: Rules, with_deltas: bool, null_source_missing: bool, by: list[str] | None = None
) -> DataFrame:
    """The four status counts and, if wanted, the summed differences of discrepancies: one row, or one
    per value of the columns ``by`` of the left side (null for rows of the right side alone)."""
    by = by or []
    per_key = _ranges(left, "s", by).join(_ranges(right, "t"), _ID, "full")
    groups = written(_by_status(per_key, rules, with_deltas, null_source_missing, by), "recon-groups")

    parts = [groups.filter("NOT mixed").select(*by, *_COUNTS, *_DELTAS, *_REST)]
    mixed = groups.filter("mixed")
    any_fine = mixed.agg(F.max("fine")).first()[0]
    if any_fine is not None:
        s, t = _weighted(left, right, mixed, by)
        # Every pair of a mixed key is a discrepancy until the band join says otherwise.
        parts.append(_row(mixed.groupBy(*by).agg(F.sum("pairs").alias("n")), by, amount_discrepancies=F.col("n")))
        parts.append(_pairs_within(s, t, rules, with_deltas, by))
        if with_deltas:
            sums = sums_of_differences(s, t, _ID, any_fine)
            parts.append(_row(sums, by, debit_delta=F.col("d"), credit_delta=F.col("c"),
                              debit_rest=F.col("d_rest"), credit_rest=F.col("c_rest")))
    return reduce(DataFrame.unionByName, parts).groupBy(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in _COUNTS],
        *[
            (F.coalesce(F.sum(c), F.lit(0)).cast("double") + F.coalesce(F.sum(r), F.lit(0.0))).alias(c)
            for c, r in zip(_DELTAS, _REST)
        ],
    )


def _row(df: DataFrame, by: list[str], **values: Column) -> DataFrame:
    """The uniform shape of a partial result; what is not given is 0."""
    zero = F.lit(0)
    return df.select(
        *by,
        *[values.get(c, zero).cast(COUNT_TYPE).alias(c) for c in _COUNTS],
        *[values.get(c, zero).cast(SUM_TYPE).alias(c) for c in _DELTAS],
        *[values.get(c, zero).cast("double").alias(c) for c in _REST],
    )


def _ranges(df: DataFrame, side: str, by: list[str] | None = None) -> DataFrame:
    """One row per key (and ``by``): row count, range and number of the known amounts, and whether any
    of them is finer than 4 places or huge."""
    amounts = [
        f(a).alias(f"{side}_{a}_{name}")
        for a in ("d", "c")
        for name, f in (("lo", F.min), ("hi", F.max), ("n", F.count))
    ]

    def fine(a: str) -> Column:
        off = F.abs(F.round(F.col(a), 4) - F.col(a))
        return F.coalesce((off > _DUST) | (F.abs(F.col(a)) >= _PLAIN), F.lit(False))

    return df.groupBy(*_ID, *(by or [])).agg(
        F.count(F.lit(1)).alias(f"{side}_n"), F.max(fine("d") | fine("c")).alias(f"{side}_fine"), *amounts
    )


def _by_status(per_key, rules: Rules, with_deltas: bool, null_source_missing: bool, by: list[str]) -> DataFrame:
    """One row for all keys whose pairs share a status, and one for each mixed key."""

    def same(side: str, a: str) -> Column:
        known = F.col(f"{side}_{a}_n")
        one_value = F.col(f"{side}_{a}_lo") == F.col(f"{side}_{a}_hi")
        return (known == 0) | ((known == F.col(f"{side}_n")) & one_value)

    both = F.col("s_n").isNotNull() & F.col("t_n").isNotNull()
    uniform = same("s", "d") & same("s", "c") & same("t", "d") & same("t", "c")
    mixed = both & ~uniform
    fine = mixed & (F.col("s_fine") | F.col("t_fine"))
    pairs = times(F.col("s_n"), F.col("t_n"))
    alike = both & uniform
    differs = F.coalesce(
        exceeds(F.col("s_d_lo"), F.col("t_d_lo"), rules.tolerance), F.lit(False)
    ) | F.coalesce(exceeds(F.col("s_c_lo"), F.col("t_c_lo"), rules.tolerance), F.lit(False))
    no_target, no_source = F.col("t_n").isNull(), F.col("s_n").isNull()
    if null_source_missing:
        null_source = no_target & (F.col(TAG) != 0)
        no_target, no_source = no_target & ~null_source, no_source | null_source
    rows = F.coalesce("s_n", "t_n")

    def delta(a: str) -> Column:
        return F.when(alike & differs, difference(F.col(f"s_{a}_lo"), F.col(f"t_{a}_lo")))

    deltas = [delta("d"), delta("c")] if with_deltas else [F.lit(0.0), F.lit(0.0)]
    labelled = per_key.select(
        *by,
        F.coalesce(mixed, F.lit(False)).alias("mixed"),
        F.coalesce(fine, F.lit(False)).alias("fine"),
        F.when(mixed, F.col(KEY)).alias(KEY),
        F.when(mixed, F.col(TAG)).alias(TAG),
        F.when(mixed, pairs).alias("pairs"),
        F.when(alike & ~differs, pairs).alias("matched"),
        F.when(alike & differs, pairs).alias("amount_discrepancies"),
        F.when(no_target, rows).alias("missing_in_target"),
        F.when(no_source, rows).alias("missing_in_source"),
        *[
            (pairs.cast("decimal(20,0)") * split_amount(d, _AMOUNT_TYPE)[0]).cast(SUM_TYPE).alias(c)
            for c, d in zip(_DELTAS, deltas)
        ],
        *[
            (pairs.cast("double") * split_amount(d, _AMOUNT_TYPE)[1]).alias(c)
            for c, d in zip(_REST, deltas)
        ],
    )
    return labelled.groupBy(*by, "mixed", "fine", *_ID).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast(COUNT_TYPE).alias(c) for c in ("pairs", *_COUNTS)],
        *[F.coalesce(F.sum(c), F.lit(0)).cast(SUM_TYPE).alias(c) for c in _DELTAS],
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in _REST],
    )


def _weighted(left: DataFrame, right: DataFrame, mixed: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """The distinct (key, debit, credit) of the mixed keys of both sides, each with its number of rows
    ``n`` and whether its key holds fine amounts. Written once, read by each of the steps."""

    def counted(df: DataFrame, of: list[str], side: str) -> DataFrame:
        kept = df.join(mixed.groupBy(*of).agg(F.max("fine").alias("fine")), of)
        found = kept.groupBy(*of, "d", "c", "fine").agg(F.count(F.lit(1)).alias("n"))
        return found.withColumn("side", F.lit(side))

    both = counted(left, [*_ID, *by], "s").unionByName(counted(right, _ID, "t"), allowMissingColumns=True)
    rows = written(both, "recon-mixed")
    return rows.filter("side = 's'").drop("side"), rows.filter("side = 't'").drop("side", *by)


def _pairs_within(s: DataFrame, t: DataFrame, rules: Rules, with_deltas: bool, by: list[str]) -> DataFrame:
    """Pairs of mixed keys within tolerance, moved from discrepancy to matched."""
    width = 2 * rules.tolerance if rules.tolerance > 0 else 0.01
    if not with_deltas:  # amounts may be null
        s, t = _masked(s, mine_first=True, by=by), _masked(t, mine_first=False, by=[])
    keys = [*_ID, "mask"] if not with_deltas else list(_ID)
    at = [*keys, "x", "y"]
    s, t = placed(s, width, 0), placed(t, width, 0)

    def crowds(df: DataFrame, side: str) -> DataFrame:
        found = df.groupBy(*at).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CROWD)
        return found.select(*at, F.lit(side).alias("side"))

    crowded = crowds(s, "s").unionByName(crowds(t, "t"))
    if crowded.isEmpty():
        return _met(s, t, keys, rules, with_deltas, by)
    crowded = written(crowded, "recon-crowded")

    def apart(df: DataFrame, side: str) -> tuple[DataFrame, DataFrame]:
        full = crowded.filter(F.col("side") == side).select(*at)
        return df.join(full, at, "left_anti"), written(df.join(full, at, "left_semi"), "recon-crowd")

    (s_rest, s_full), (t_rest, t_full) = apart(s, "s"), apart(t, "t")
    # A crowded cell meets a few rows of any other cell; two crowded cells meet as boxes.
    parts = [
        _met(s, t_rest, keys, rules, with_deltas, by),
        _met(s_rest, t_full, keys, rules, with_deltas, by),
    ]
    cells = s_full.select(*at).distinct().withColumnsRenamed({"x": "s_x", "y": "s_y"})
    other = _around(t_full.select(*at).distinct(), at).select(
        *keys, F.col("x").alias("s_x"), F.col("y").alias("s_y"), F.col("x_own").alias("t_x"), F.col("y_own").alias("t_y")
    )
    pairs = cells.join(other, [*keys, "s_x", "s_y"])
    s_full, t_full = s_full.drop("x", "y"), t_full.drop("x", "y")
    near, small = near_boxes(s_full, t_full, keys, pairs, rules.tolerance, width)
    near, small = written(near, "recon-near"), written(small, "recon-small")
    parts.append(_products(s_full, t_full, near, keys, width, with_deltas, by))
    box = [*keys, "level", "t_x", "t_y"]
    few = rows_of(t_full, small.select(*box).distinct(), keys, width, "t")
    some = rows_of(s_full, small, keys, width, "s")
    parts.append(_moved(_close(some, few, box, rules), with_deltas, by))
    return reduce(DataFrame.unionByName, parts)


def _around(df: DataFrame, at: list[str]) -> DataFrame:
    """``df`` once for each of the nine cells around its own, which is kept as x_own, y_own."""
    steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
    own = df.withColumns({"x_own": F.col("x"), "y_own": F.col("y")})
    own = own.withColumn("x", F.explode(F.transform(steps, lambda i: F.col("x_own") + i)))
    return own.withColumn("y", F.explode(F.transform(steps, lambda i: F.col("y_own") + i)))


def _met(s: DataFrame, t: DataFrame, keys: list[str], rules: Rules, with_deltas: bool, by: list[str]) -> DataFrame:
    """What moves by the pairs within tolerance of these rows, joined cell by cell."""
    at = [*keys, "x", "y"]
    return _moved(_close(s, _around(t, at), at, rules), with_deltas, by)


def _close(s: DataFrame, t: DataFrame, on: list[str], rules: Rules) -> DataFrame:
    """The pairs of rows of equal ``on`` that are within tolerance."""

    def side(df: DataFrame, name: str) -> DataFrame:
        extra = [c for c in df.columns if c not in (*on, "d", "c", "n") and name == "s"]
        return df.select(*on, *extra, *[F.col(c).alias(f"{name}_{c}") for c in ("d", "c", "n")])

    far = exceeds(F.col("s_d"), F.col("t_d"), rules.tolerance) | exceeds(F.col("s_c"), F.col("t_c"), rules.tolerance)
    return side(s, "s").join(side(t, "t"), on).filter(~far)


def _moved(close: DataFrame, with_deltas: bool, by: list[str]) -> DataFrame:
    weight = times(F.col("s_n"), F.col("t_n"))
    sums = close.groupBy(*by).agg(
        F.sum(weight).alias("n"),
        *[
            F.sum(weight.cast("decimal(20,0)") * difference(F.col(f"s_{a}"), F.col(f"t_{a}")).cast(_AMOUNT_TYPE)).alias(a)
            for a in AMOUNTS
            if with_deltas
        ],
    )
    moved = {"matched": F.col("n"), "amount_discrepancies": -F.col("n")}
    if with_deltas:
        moved |= {"debit_delta": -F.col("d"), "credit_delta": -F.col("c")}
    return _row(sums, by, **moved)


def _products(
    s: DataFrame, t: DataFrame, near: DataFrame, keys: list[str], width: float, with_deltas: bool, by: list[str]
) -> DataFrame:
    """What moves by pairs of boxes that are within tolerance as a whole. A box of the right side is a
    group: it holds its rows and those of all boxes of the left side that it is near to."""
    box = [*keys, "level", "t_x", "t_y"]
    mine = rows_of(s, near, keys, width, "s")
    other = rows_of(t, near.select(*box).distinct(), keys, width, "t")
    held = mine.groupBy(*box, *by).agg(F.sum("n").alias("s_n")).join(other.groupBy(*box).agg(F.sum("n").alias("t_n")), box)
    counted = held.groupBy(*by).agg(F.sum(times(F.col("s_n"), F.col("t_n"))).alias("n"))
    found = _row(counted, by, matched=F.col("n"), amount_discrepancies=-F.col("n"))
    if not with_deltas:
        return found
    sums = sums_of_differences(mine, other, box)
    return found.unionByName(
        _row(sums, by, debit_delta=-F.col("d"), credit_delta=-F.col("c"), debit_rest=-F.col("d_rest"), credit_rest=-F.col("c_rest"))
    )


def _masked(df: DataFrame, mine_first: bool, by: list[str]) -> DataFrame:
    """Prepare amounts of which some are null, and so never differ from anything.

    A row is copied for each combination of nulls its partner may have. Where either of the two is
    null the amount is set to 0 on both, which is no difference, and rows that have become equal
    are added up. ``mask`` holds the nulls of both sides, so each pair meets under one mask only.
    """
    own = F.col("d").isNull().cast("int") + 2 * F.col("c").isNull().cast("int")
    copies = df.select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("other"))
    either = F.col("own").bitwiseOR(F.col("other"))
    first, second = ("own", "other") if mine_first else ("other", "own")
    return (
        copies.select(
            *_ID,
            *by,
            (F.col(first) * 4 + F.col(second)).alias("mask"),
            F.when(either.bitwiseAND(1) > 0, F.lit(0.0)).otherwise(F.col("d")).alias("d"),
            F.when(either.bitwiseAND(2) > 0, F.lit(0.0)).otherwise(F.col("c")).alias("c"),
            "n",
        )
        .groupBy(*_ID, *by, "mask", "d", "c")
        .agg(F.sum("n").alias("n"))
    )
