"""Tolerant parsing, null-aware predicates, exact money totals."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..params import NA_TOKENS

# Fixed value: the cells that count as a number. A bare try_cast would also take "12d" or "1.5f".
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# The part of an amount that is added up as a decimal; the rest is added as a double (see money_sum).
EXACT_TYPE = "decimal(28,8)"

# An amount as it is written: a double shows 17 digits, so few amounts have more places than these.
WRITTEN_TYPE = "decimal(32,17)"

# The type of amounts in decimal mode.
DECIMAL_TYPE = "decimal(18,4)"


def na_to_null(c: Column) -> Column:
    """A CSV cell with its missing-value spellings turned into null."""
    return F.when(~c.isin(*NA_TOKENS), c)


def number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as double; whatever is not a finite number becomes null."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        c = F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))
    else:
        c = c.cast("double")
    return F.when(F.abs(c) < float("inf"), c)


def decimal_number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as DECIMAL(18,4), text without a detour over doubles; whatever is not a finite
    number becomes null. A number with more than 14 digits before the point fails the query."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.when(c.rlike(NUMBER_PATTERN), c.cast(DECIMAL_TYPE))
    if isinstance(df.schema[name].dataType, T.DecimalType):
        return c.cast(DECIMAL_TYPE)
    return number(df, name).cast(DECIMAL_TYPE)


def calendar_date(df: DataFrame, name: str, fmt: str) -> Column:
    """Column ``name`` as date. Text in another format than ``fmt`` becomes null, never an error."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.to_date(F.try_to_timestamp(F.col(name), F.lit(fmt)))
    return F.col(name).cast("date")


def blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def in_list(c: Column, allowed: Iterable[str]) -> Column:
    """Membership that is false, not unknown, for null."""
    return F.coalesce(c.isin(*allowed), F.lit(False))


def not_in_list(c: Column, allowed: Iterable[str]) -> Column:
    """SQL's NOT IN: unknown, hence not counted, for null."""
    return ~c.isin(*allowed)


def exceeds(a: Column, b: Column, tolerance: float) -> Column:
    return F.abs(a - b) > F.lit(float(tolerance))


def exceeds_exactly(a: Column, b: Column, tolerance: float) -> Column:
    """As ``exceeds``, for decimals: the tolerance is the decimal that its digits say."""
    return F.abs(a - b) > F.lit(Decimal(repr(float(tolerance))))


def difference(a: Column, b: Column) -> Column:
    """``a - b`` to 4 places, half away from zero, for amounts as they are written (17 places, 15 digits).

    The binary difference of 1.00005 and 0.5 lies just above or below 0.50005, as chance will have it; the
    difference of the two decimals does not, so every pair of equal amounts is rounded alike. Amounts
    that the decimals cannot hold are subtracted as doubles.
    """
    exact = F.round(a.try_cast(WRITTEN_TYPE) - b.try_cast(WRITTEN_TYPE), 4).cast("double")
    return F.when(a == b, F.lit(0.0)).otherwise(F.coalesce(exact, F.round(a - b, 4)))


def status_of(failed: Column, severity: str = "FAIL") -> Column:
    return F.when(failed == 0, "PASS").otherwise(severity)


def share_pct(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, rounded; 0 when there is nothing to divide by."""
    return F.when(whole > 0, F.round(F.lit(100.0) * part / whole, digits)).otherwise(F.lit(0.0))


def split_amount(c: Column, kind: str = EXACT_TYPE) -> tuple[Column, Column]:
    """A double as a decimal and the double that is left: ``c`` is their sum. Nothing is left of an
    amount with the places of the decimal; all is left of one that it cannot hold."""
    exact = F.coalesce(c.try_cast(kind), F.lit(0).cast(kind))
    return F.when(c.isNotNull(), exact), c - exact.cast("double")


def _sum_parts(c: Column) -> tuple[Column, Column]:
    exact, rest = split_amount(c)
    return F.sum(exact), F.coalesce(F.sum(rest), F.lit(0.0))


def money_sum(c: Column) -> Column:
    """Sum of a double money column that does not depend on the order of the rows.

    Adding doubles gives another last digit for every partitioning, which flips roundings and the
    "balanced" test on large tables. Every amount is therefore added as a decimal with 8 places plus
    what those places leave of it, as a double. That is nothing for money; for finer or huge amounts
    nothing is lost, and the order of the rows can only touch the last digits of the remainder.
    Null if there is no value at all, as in SQL.
    """
    exact, rest = _sum_parts(c)
    return exact.cast("double") + rest


def money_net(a: Column, b: Column) -> Column:
    """``money_sum(a) - money_sum(b)``, subtracted before the result becomes a double."""
    (exact_a, rest_a), (exact_b, rest_b) = _sum_parts(a), _sum_parts(b)
    return (exact_a - exact_b).cast("double") + (rest_a - rest_b)
