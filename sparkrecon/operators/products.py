"""Sums over all pairs of two sides that meet in a group, from n + m rows and not from n * m pairs.

The sum of ``difference`` (rounded to 4 places) over all pairs of a group is not the difference of two
sums if amounts are finer than that. Let u be 0.0001, S = A u + r and T = B u + q with 0 <= r, q < u. The
rounded difference is A - B, one more, or one less, which depends on r - q: it is rounded up if r - q is u/2
or more, and down if it is below -u/2. Put every S at the place (r + u/2) mod u and every T at q. Then, over
a group with M rows on the T side,

    sum = M sum(A) - N sum(B) + sum over S of (rows of T before S) - M (rows of S with r < u/2)

where rows of equal place stand in the order of their amounts: those are the exact halves, and it is
their sign that decides between up and down. So the pairs are counted by positions in one merged order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import WRITTEN_TYPE
from ..plans.order import PART, before, ranged

AMOUNTS = ("d", "c")
COUNT_TYPE, SUM_TYPE = "decimal(38,0)", "decimal(38,4)"
_PLACE, _HALF, _UNIT = "decimal(18,17)", "0.00005", "0.0001"


def times(n: Column, m: Column) -> Column:
    """Number of pairs, wider than a bigint."""
    return n.cast("decimal(20,0)") * m.cast("decimal(18,0)")


def _decimal(a: str) -> Column:
    return F.coalesce(F.col(a).try_cast(WRITTEN_TYPE), F.lit(0).cast(WRITTEN_TYPE))


def _side_sums(df: DataFrame, group: list[str], side: str) -> DataFrame:
    """Per group: rows, sums of the whole units, and as doubles what decimals cannot hold."""
    n = F.col("n").cast("decimal(10,0)")
    sums = []
    for a in AMOUNTS:
        whole = F.when(F.col("fine"), F.floor(_decimal(a), 4)).otherwise(F.round(_decimal(a), 4))
        rest = F.col("n") * (F.col(a) - _decimal(a).cast("double"))
        sums += [
            F.sum(n * whole.cast("decimal(24,4)")).cast("decimal(28,4)").alias(f"{side}_{a}"),
            F.sum(rest).alias(f"{side}_{a}_rest"),
        ]
    return df.groupBy(*group).agg(F.sum("n").cast("decimal(10,0)").alias(f"{side}_n"), *sums)


def sums_of_differences(s: DataFrame, t: DataFrame, group: list[str], any_fine: bool = True) -> DataFrame:
    """One row: d, c (summed differences over all pairs of all groups) and d_rest, c_rest (as doubles,
    what decimals cannot hold of them).

    Rows of both sides have the columns of ``group``, amounts ``d`` and ``c``, ``n`` equal rows, and
    ``fine``, the same for all rows of a group: whether it holds amounts finer than 4 places. In the other
    groups an amount stands for its nearest 4 places. ``any_fine`` tells whether there can be such groups.
    """
    pairs = _side_sums(s, group, "s").join(_side_sums(t, group, "t"), group)
    linear = []
    for a in AMOUNTS:
        linear.append(F.sum(F.col("t_n") * F.col(f"s_{a}") - F.col("s_n") * F.col(f"t_{a}")).alias(a))
        linear.append(
            F.sum(F.col("t_n").cast("double") * F.col(f"s_{a}_rest") - F.col("s_n").cast("double") * F.col(f"t_{a}_rest"))
            .alias(f"{a}_rest")
        )
    both = pairs.agg(*linear)
    if any_fine:
        both = both.unionByName(_moved(s.filter("fine"), t.filter("fine"), group), allowMissingColumns=True)
    return both.agg(
        *[F.coalesce(F.sum(a), F.lit(0)).cast(SUM_TYPE).alias(a) for a in AMOUNTS],
        *[F.coalesce(F.sum(f"{a}_rest"), F.lit(0.0)).alias(f"{a}_rest") for a in AMOUNTS],
    )


def _placed(df: DataFrame, group: list[str], mine: bool) -> DataFrame:
    """Each amount of each row with its place; ``low`` marks rows of S with r < u/2."""
    half = F.lit(_HALF).cast(_PLACE)
    entries = []
    for a in AMOUNTS:
        value = _decimal(a)
        r = (value - F.floor(value, 4)).cast(_PLACE)
        low = r < half
        place = F.when(low, r + half).otherwise(r - half).cast(_PLACE) if mine else r
        n, none = F.col("n").cast("long"), F.lit(0).cast("long")
        entries.append(
            F.struct(
                F.lit(a).alias("amount"), place.alias("place"), value.alias("value"),
                (n if mine else none).alias("s_n"), (none if mine else n).alias("t_n"),
                (F.when(low, n).otherwise(none) if mine else none).alias("low"),
            )
        )
    return df.select(*group, F.inline(F.array(*entries)))


def _moved(s: DataFrame, t: DataFrame, group: list[str]) -> DataFrame:
    """One row d, c: what rounding adds to the difference of the whole units."""
    of = [*group, "amount"]
    union = _placed(s, group, True).unionByName(_placed(t, group, False))
    counts = ("s_n", "t_n", "low")
    merged = union.groupBy(*of, "place", "value").agg(*[F.sum(c).alias(c) for c in counts])
    cut = ranged(merged, of, ["place", "value"], "recon-places")
    earlier = Window.partitionBy(PART, *of).orderBy("place", "value").rowsBetween(Window.unboundedPreceding, -1)
    here = cut.withColumn("ahead", F.coalesce(F.sum("t_n").over(earlier), F.lit(0)))
    shares = here.groupBy(*of, PART).agg(
        *[F.sum(c).alias(c) for c in counts], F.sum(times(F.col("s_n"), F.col("ahead"))).alias("within")
    )
    shares = before(shares, of, "t_n", "ahead")
    per_group = shares.groupBy(*of).agg(
        F.sum(F.col("within") + times(F.col("s_n"), F.col("ahead"))).alias("up"),
        F.sum("t_n").alias("t_n"),
        F.sum("low").alias("low"),
    )
    steps = F.col("up").cast(COUNT_TYPE) - times(F.col("t_n"), F.col("low"))
    unit = F.lit(_UNIT).cast("decimal(4,4)")
    return per_group.agg(
        *[
            (F.coalesce(F.sum(F.when(F.col("amount") == a, steps)), F.lit(0)).cast("decimal(33,0)") * unit)
            .cast(SUM_TYPE)
            .alias(a)
            for a in AMOUNTS
        ]
    )
