"""Column expressions shared by all operators. All run inside the JVM; there is no Python UDF."""

from .values import (
    blank,
    calendar_date,
    decimal_number,
    difference,
    exceeds,
    exceeds_exactly,
    in_list,
    money_net,
    money_sum,
    na_to_null,
    not_in_list,
    number,
    share_pct,
    status_of,
)

__all__ = [
    "blank",
    "calendar_date",
    "decimal_number",
    "difference",
    "exceeds",
    "exceeds_exactly",
    "in_list",
    "money_net",
    "money_sum",
    "na_to_null",
    "not_in_list",
    "number",
    "share_pct",
    "status_of",
]
