"""Membership in master lists that are tables: vendors, accounts, cost centres by the million.

A list of a handful of codes is a literal in the plan (``Rules``). A table of codes is joined instead:
nothing of it enters the plan or the driver, it may repeat codes, and whether it is broadcast is left to
its size. Two readings of a missing value are kept apart: SQL's NOT IN finds nothing for a null value,
and nothing at all if the list holds a null; the row checks count a null value as not listed and pay no
heed to nulls in the list.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import in_list, not_in_list

_FLAG, _NULL = "_listed_", "_null_listed_"


def _codes(master: DataFrame, code: str) -> DataFrame:
    return master.select(F.col(code).cast("string").alias("_code"))


def _holds_null(master: DataFrame, code: str) -> Column:
    """Whether the list holds a null, as a scalar subquery: one aggregate beside the main plan."""
    found = _codes(master, code).agg(F.coalesce(F.max(F.col("_code").isNull()), F.lit(False)).alias("held"))
    return found.scalar()


def rows_not_in(df: DataFrame, column: str, master: DataFrame, code: str = "code") -> DataFrame:
    """Rows whose value is NOT IN the list, in SQL's sense: an anti join that knows of nulls."""
    known = df.filter(F.col(column).isNotNull() & ~_holds_null(master, code))
    codes = _codes(master, code)
    return known.join(codes, F.col(column).cast("string") == F.col("_code"), "left_anti")


def rows_not_listed(df: DataFrame, column: str, master: DataFrame, code: str = "code") -> DataFrame:
    """Rows whose value does not exist in the list; a null value never does."""
    return df.join(_codes(master, code), F.col(column).cast("string") == F.col("_code"), "left_anti")


def with_masters(df: DataFrame, masters: Mapping[str, DataFrame], code: str = "code") -> DataFrame:
    """``df`` with a mark per column of ``masters`` that it has, which the named checks and the rule
    catalogue then use instead of the lists in ``Rules``. Rows stay as many as they are: of each code
    the list gives one row. The marks are columns of their own and take part in nothing else."""
    for name, master in masters.items():
        if name in df.columns:
            codes = _codes(master, code).filter("_code IS NOT NULL").distinct().withColumn(_FLAG + name, F.lit(True))
            df = df.join(codes, F.col(name).cast("string") == F.col("_code"), "left").drop("_code")
            df = df.withColumn(_NULL + name, _holds_null(master, code))
    return df


def listed(df: DataFrame, name: str, literal: tuple[str, ...]) -> Column:
    """Whether the value is listed, false for null: by the mark of a master table or by the literals."""
    if _FLAG + name in df.columns:
        return F.coalesce(F.col(_FLAG + name), F.lit(False))
    return in_list(F.col(name).cast("string"), literal)


def unlisted(columns: list[str], name: str, literal: tuple[str, ...]) -> Column:
    """SQL's NOT IN, unknown for null, by the mark of a master table or by the literals."""
    if _FLAG + name in columns:
        known = F.col(name).isNotNull() & ~F.col(_NULL + name)
        return F.when(F.col(_FLAG + name), False).otherwise(F.when(known, True))
    return not_in_list(F.col(name), literal)


def master_report(df: DataFrame, column: str, masters: Mapping[str, DataFrame], code: str = "code") -> DataFrame:
    """Per list: how many rows are not in it in SQL's sense, and how many are not listed."""
    marked = df
    counts = []
    for i, (name, master) in enumerate(masters.items()):
        held = f"_value_{i}"
        marked = with_masters(marked.withColumn(held, F.col(column)), {held: master}, code)
        counts.append(
            F.struct(
                F.lit(name).alias("list"),
                F.count_if(unlisted(marked.columns, held, ())).alias("not_in"),
                F.count_if(~listed(marked, held, ())).alias("not_listed"),
                F.count(F.lit(1)).alias("total_rows"),
            )
        )
    return marked.agg(F.array(*counts).alias("lists")).select(F.inline("lists"))
