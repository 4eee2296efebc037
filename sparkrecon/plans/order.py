"""Positions and running sums within groups, of which one may hold most of the rows.

A window over such a group would sort it in one task. Here rows are cut by range over group and order,
so a large group spreads over many partitions, and what a partition has to know of the ones before it
is one number per group: the sum of their shares. Those numbers are the only thing a window runs over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written

PART = "_part"
_AT = "_at"


def ranged(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` cut by range over (group, order) and written, with the number of its partition as
    ``_part``. Partitions are in order: no row of one belongs before a row of an earlier one."""
    cut = df.repartitionByRange(*group, *order)
    return written(cut.withColumn(PART, F.spark_partition_id()), name)


def before(shares: DataFrame, group: list[str], share: str, out: str) -> DataFrame:
    """``shares`` has one row per group and partition; adds the sum of ``share`` over the group's
    earlier partitions. A group has one row per partition here, however many rows it holds."""
    earlier = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return shares.withColumn(out, F.coalesce(F.sum(share).over(earlier), F.lit(0)))


def with_positions(df: DataFrame, group: list[str], order: list[str], out: str, count: str, name: str) -> DataFrame:
    """``df`` with each row's place in its group (from 0, by ``order``, nulls first) and the group's
    number of rows. Rows equal in ``order`` are placed in any order; name enough columns to tell them
    apart where that matters. Null is a group of its own."""
    keys = [*group, *order]
    cut = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # The high bits of this number are the partition's, the low ones count its rows in their order.
    held = written(cut.withColumn(_AT, F.monotonically_increasing_id()), name)
    part = F.shiftright(_AT, 33).cast("int").alias(PART)
    shares = held.groupBy(*group, part).agg(F.min(_AT).alias("_low"), F.count(F.lit(1)).alias("_n"))
    of_group = Window.partitionBy(*group)
    shares = before(shares, group, "_n", "_before").withColumn(count, F.sum("_n").over(of_group))
    shares = written(shares.withColumnsRenamed({g: f"_of_{g}" for g in group}), f"{name}-shares")
    same: Column = F.shiftright(_AT, 33).cast("int") == F.col(PART)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return (
        held.join(shares, same)
        .withColumn(out, F.col("_before") + F.col(_AT) - F.col("_low"))
        .drop(_AT, PART, "_low", "_n", "_before", *[f"_of_{g}" for g in group])
    )
