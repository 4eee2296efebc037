"""Pairs of amounts within a tolerance where very many amounts of one key lie close together.

A grid cell of the band join may hold any number of distinct amounts, and then its pairs grow with their
square. Two crowded cells are instead compared as boxes: if the amounts of one cell all lie within the
tolerance of all amounts of the other, their pairs are a product, which needs no pair to be formed; if
none can, they are dropped; otherwise both are cut into smaller cells, four per amount, and their parts
are compared. Boxes are the true ranges of their amounts and the test on their corners is the one on
rows: subtraction of doubles is monotone, so what holds for the corners holds for all rows between.

Along one amount only the cells at the ends of a tolerance stay open, so every level adds a few
products per cell, and rows take part in products linear in their number (times the levels). If debits
and credits of one key both vary within the tolerance, the cells along the edge of a square stay open.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written

# Boxes with so few rows on both sides are left to a join of rows.
FEW = 32
# A cell is cut into 4 per amount, and never beyond what a double can tell apart.
_BITS, _LEVELS = 2, 24


def cell(c: str, width: float, level: int) -> Column:
    """Number of the grid cell of an amount. Multiplied, since a quotient counts as nullable and would
    keep two uses of the same rows from sharing one shuffle; by powers of two, so that cells nest."""
    bound = F.lit(9e18)
    return F.floor(F.greatest(F.least(F.col(c) * (1 / width) * float(1 << (_BITS * level)), bound), -bound))


def placed(rows: DataFrame, width: float, level: int) -> DataFrame:
    return rows.withColumns({"x": cell("d", width, level), "y": cell("c", width, level)})


def _boxes(rows: DataFrame, keys: list[str], width: float, level: int, side: str) -> DataFrame:
    ranges = [f(a).alias(f"{side}_{a}_{name}") for a in ("d", "c") for name, f in (("lo", F.min), ("hi", F.max))]
    found = placed(rows, width, level).groupBy(*keys, F.col("x").alias(f"{side}_x"), F.col("y").alias(f"{side}_y"))
    return found.agg(F.count(F.lit(1)).alias(f"{side}_rows"), *ranges)


def _parents(boxes: DataFrame, side: str) -> DataFrame:
    up = {f"{side}_x_up": F.shiftright(f"{side}_x", _BITS), f"{side}_y_up": F.shiftright(f"{side}_y", _BITS)}
    return boxes.withColumns(up)


def near_boxes(
    s: DataFrame, t: DataFrame, keys: list[str], pairs: DataFrame, tolerance: float, width: float
) -> tuple[DataFrame, DataFrame]:
    """(products, pairs of small boxes), each as rows of ``keys``, level, s_x, s_y, t_x, t_y.

    ``pairs`` are the pairs of level 0 cells to compare (``keys``, s_x, s_y, t_x, t_y). Every pair of
    rows of theirs that is within tolerance is in exactly one of the results.
    """
    at = [*keys, "s_x", "s_y", "t_x", "t_y"]
    limit = F.lit(float(tolerance))
    apart, within = F.lit(False), F.lit(True)
    for a in ("d", "c"):
        below, above = F.col(f"s_{a}_lo") - F.col(f"t_{a}_hi"), F.col(f"t_{a}_lo") - F.col(f"s_{a}_hi")
        apart = apart | (below > limit) | (above > limit)
        within = within & (F.col(f"s_{a}_hi") - F.col(f"t_{a}_lo") <= limit) & (F.col(f"t_{a}_hi") - F.col(f"s_{a}_lo") <= limit)
    few = (F.col("s_rows") <= FEW) & (F.col("t_rows") <= FEW)
    near, small = [], []
    for level in range(_LEVELS + 1):
        boxes = {n: written(_boxes(r, keys, width, level, n), "recon-boxes") for n, r in (("s", s), ("t", t))}
        if level:
            s_parts, t_parts = _parents(boxes["s"], "s"), _parents(boxes["t"], "t")
            pairs = (
                pairs.withColumnsRenamed({c: f"{c}_up" for c in at[len(keys) :]})
                .join(s_parts, [*keys, "s_x_up", "s_y_up"])
                .join(t_parts, [*keys, "t_x_up", "t_y_up"])
            )
        else:
            pairs = pairs.join(boxes["s"], [*keys, "s_x", "s_y"]).join(boxes["t"], [*keys, "t_x", "t_y"])
        state = F.when(within, "near").when(few | F.lit(level == _LEVELS), "small").otherwise("open")
        judged = pairs.filter(~apart).select(*keys, F.lit(level).alias("level"), *at[len(keys) :], state.alias("state"))
        judged = written(judged, "recon-box-pairs")
        near.append(judged.filter("state = 'near'").drop("state"))
        small.append(judged.filter("state = 'small'").drop("state"))
        pairs = judged.filter("state = 'open'").select(*at)
        if pairs.isEmpty():
            break
    return reduce(DataFrame.unionByName, near), reduce(DataFrame.unionByName, small)


def rows_of(rows: DataFrame, boxes: DataFrame, keys: list[str], width: float, side: str) -> DataFrame:
    """``boxes`` (with a level each) joined with the rows that lie in their cell of ``side``."""
    top = boxes.agg(F.max("level")).first()[0]
    levels = [F.struct(F.lit(k).alias("level"), cell("d", width, k).alias(f"{side}_x"), cell("c", width, k).alias(f"{side}_y"))
              for k in range((top or 0) + 1)]
    return rows.select("*", F.inline(F.array(*levels))).join(boxes, [*keys, "level", f"{side}_x", f"{side}_y"])
