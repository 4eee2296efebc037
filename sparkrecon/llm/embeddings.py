"""Embedding near-dedup: an exact metric range join.

Cosine of at least c between unit vectors is Euclidean distance of at most r = sqrt(2 - 2 c). Pivots,
a bounded sample of the vectors, cut the space into cells: a vector is at home in the cell of its
nearest pivot. It also visits the cell of each pivot i before its own, j, unless the triangle
inequality rules out a partner there: (d(x, i)^2 - d(x, j)^2) / (2 d(i, j)) is its distance to the
plane between the two, and a partner at home in i lies on the other side, so beyond r there is none.
Each cell is then joined on its own, its homes with one another and with its visitors; a pair meets in
exactly one cell. Pivots steer the work, never the result.

Equal vectors are joined as one class with a count. A full cell is cut into blocks, and each pair of
blocks is a task's worth of one matrix product; it returns numbers of links and a star per linked
group, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written
from .common import parts_for
from .components import components

LEAST_COSINE = 0.93
# Vectors of a label per pivot, the most pivots, and vectors per block.
CELL, MOST_PIVOTS, BLOCK = 1_000, 64, 1_024
# Products this near to the limit are computed again term by term.
NEAR = 1e-9


def _classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their class or null, classes): one class per distinct vector of a label."""
    as_double = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("vec_id"), as_double.alias("v"), F.col(label_col).alias("label"))
    top = F.array_max(F.transform("v", lambda x: F.abs(x)))
    usable = (
        F.col("label").isNotNull()
        & F.coalesce(F.size("v") > 0, F.lit(False))
        & ~F.coalesce(F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True))
        & F.coalesce(top > 0, F.lit(False))
    )
    rows = written(
        rows.withColumn("usable", usable)
        .withColumn("key", F.when(F.col("usable"), F.sha2(F.concat_ws(",", F.transform("v", lambda x: x.cast("string"))), 256))),
        "vector-rows",
    )
    classes = written(
        rows.filter("usable")
        .groupBy("label", "key")
        .agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"))
        .withColumn("cls", F.monotonically_increasing_id()),
        "vector-classes",
    )
    return rows, classes


def _unit(v: list) -> np.ndarray:
    """Rows of unit length, in double precision; scaled first, so that no square overflows."""
    x = np.array(v, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pivots(classes: DataFrame) -> dict[int, np.ndarray]:
    """Per number of dimensions at most ``MOST_PIVOTS`` unit vectors, by hash."""
    sizes = classes.groupBy("label", F.size("v").alias("d")).count().groupBy("d").agg(F.max("count"))
    found: dict[int, np.ndarray] = {}
    for d, most in sizes.collect():
        count = min(MOST_PIVOTS, parts_for(most, CELL))
        sample = classes.filter(F.size("v") == d).orderBy(F.xxhash64("key")).limit(count).select("v").collect()
        found[d] = _unit([r[0] for r in sample])
    return found


def _cells(pivots: dict[int, np.ndarray], least: float):
    radius = math.sqrt(2 - 2 * least) + 1e-9

    @F.pandas_udf("array<int>")
    def cells(vectors: pd.Series) -> pd.Series:
        """The home cell first, then the cells to visit."""
        out: list = [None] * len(vectors)
        sizes = vectors.map(len).to_numpy()
        for d in np.unique(sizes):
            at, p = np.flatnonzero(sizes == d), pivots[int(d)]
            x = _unit(vectors.iloc[at].tolist())
            square = np.maximum(2 - 2 * x @ p.T, 0)
            home = square.argmin(axis=1)
            apart = np.sqrt(np.maximum(2 - 2 * p @ p.T, 0))[home]
            beyond = (square - square[np.arange(len(x)), home][:, None]) / np.maximum(2 * apart, 1e-12)
            visit = (np.arange(len(p))[None] < home[:, None]) & (beyond <= radius)
            for row, i in enumerate(at):
                out[i] = [int(home[row]), *np.flatnonzero(visit[row]).tolist()]
        return pd.Series(out)

    return cells


def _linked(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of rows have a cosine of at least ``least``."""
    product = _unit(x) @ _unit(y).T
    linked = product >= least
    for i, j in zip(*np.nonzero(np.abs(product - least) < NEAR), strict=True):
        a, b = x[i] / np.abs(x[i]).max(), y[j] / np.abs(y[j]).max()
        linked[i, j] = math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b)) >= least
    return linked


def _groups(linked: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest class that each row and each column reaches through ``linked``."""
    rows, columns = low.copy(), high.copy()
    big = np.iinfo(np.int64).max
    while True:
        new_columns = np.minimum(columns, np.where(linked, rows[:, None], big).min(axis=0, initial=big))
        new_rows = np.minimum(rows, np.where(linked, new_columns[None], big).min(axis=1, initial=big))
        if (new_rows == rows).all() and (new_columns == columns).all():
            return rows, columns
        rows, columns = new_rows, new_columns


def near_duplicates(
    vectors: DataFrame,
    least: float = LEAST_COSINE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors of equal, non-null label and length are linked if their cosine is at least ``least``.
    Vectors that are null, empty or zero, or hold a null or a number that is not finite, have no link
    and are their own component. A repeated id counts as another vector with the same id. A null id is
    not the smallest of a component unless it is alone there. No vectors give no rows; other columns
    are not read.
    """
    rows, classes = _classes(vectors, id_col, vector_col, label_col)
    cells = _cells(_pivots(classes), least)
    placed = (
        classes.withColumn("cells", cells("v"))
        .select("label", F.size("v").alias("d"), "cls", "n", "v", F.posexplode("cells").alias("at", "cell"))
        .withColumn("home", F.col("at") == 0)
        .drop("at")
    )
    placed = written(placed, "vector-cells")
    cell = ["label", "d", "cell"]
    sizes = written(
        placed.groupBy(*cell).agg(
            F.ceil(F.count(F.when(F.col("home"), 1)) / BLOCK).cast("int").alias("homes"),
            F.ceil(F.count(F.when(~F.col("home"), 1)) / BLOCK).cast("int").alias("visitors"),
        ),
        "vector-cell-sizes",
    ).filter("homes > 0")
    # A home meets every block of homes and of visitors; a visitor meets every block of homes. A task is
    # (block of homes, other block), the other one counted on from the homes' blocks.
    own = F.when(F.col("home"), F.pmod(F.xxhash64("cls"), "homes")).otherwise(
        F.col("homes") + F.pmod(F.xxhash64("cls"), "visitors")
    ).cast("int")
    other = F.when(F.col("home"), F.sequence(F.lit(0), F.col("homes") + F.col("visitors") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("homes") - 1)
    )
    tasks = (
        placed.join(sizes, cell)
        .withColumn("own", own)
        .withColumn("other", F.explode(other))
        .select(
            *cell, F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"), "own", "cls", "n", "v"
        )
    )

    def join(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        block_a, block_b = key[-2], key[-1]
        a, b = part[part["own"] == block_a], part[part["own"] == block_b]
        if not len(a) or not len(b):
            return pd.DataFrame({"cls": [], "links": [], "root": []}).astype("int64")
        ca, cb = a["cls"].to_numpy(), b["cls"].to_numpy()
        linked = _linked(np.stack(a["v"].to_numpy()), np.stack(b["v"].to_numpy()), least)
        if block_a == block_b:
            np.fill_diagonal(linked, False)
        ra, rb = _groups(linked, ca, cb)
        found = [pd.DataFrame({"cls": ca, "links": linked @ b["n"].to_numpy(), "root": ra})]
        if block_a != block_b:
            found.append(pd.DataFrame({"cls": cb, "links": linked.T @ a["n"].to_numpy(), "root": rb}))
        out = pd.concat(found)
        return out[out["links"] > 0]

    met = written(
        tasks.groupBy(*cell, "block_a", "block_b").applyInPandas(join, "cls long, links long, root long"), "vector-links"
    )
    links = met.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(met.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    known = (
        classes.select("label", "key", "cls", "n", "first_id")
        .join(links, "cls", "left")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .select("label", "key", "n", "first_id", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", F.col("cls")).alias("root"))
    )
    known = written(known, "vector-known")
    lowest = written(known.groupBy("root").agg(F.min("first_id").alias("component_id")), "vector-components")
    found = written(
        known.join(lowest, "root").select(
            F.col("label").alias("of"), F.col("key").alias("of_key"), "component_id", (F.col("links") + F.col("n") - 1).alias("n_links")
        ),
        "vector-found",
    )
    joined = rows.filter("usable").select("vec_id", "label", "key").join(
        found, (F.col("label") == F.col("of")) & (F.col("key") == F.col("of_key"))
    )
    alone = rows.filter("NOT usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return joined.select("vec_id", "n_links", "component_id").unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )


ORACLE = r"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
  SELECT a AS vec_id, a AS other FROM links
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
), component AS (
  SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
), counted AS (
  SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
       coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counted USING (vec_id) LEFT JOIN component USING (vec_id)
"""
