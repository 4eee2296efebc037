"""Merkle manifest of a dataset: a digest per row, a tree per part, one root, and a proof for every row.

The children of a parent are spread into ``fanout`` columns by conditional aggregates, one per slot.
The columns concatenated are hashed into the parent; the columns without the row's own slot are its
siblings. A proof is the siblings of every level on the way to the root, and folding a row's digest
with them gives the root again if the row is the one that was listed.

Scale: rows get their place by a range partition, so a part may hold most of them. Blocks of ``SPAN``
consecutive nodes are dealt out by one shuffle, in which all levels of a block are built, and each
block hands one node to the next tier; a billion rows have three tiers. No task sees more than its
blocks, and a block never has more than ``SPAN`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.order import with_positions
from ..sources.tables import written
from .common import remainder

# The columns of a leaf, in order, and how a missing value is written.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
MISSING = "-"
# Most nodes that are built into one by a single task.
SPAN = 1024


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(values: list[Column]) -> Column:
    """Digest of a row: every value as its length in bytes, a colon and the value, or ``MISSING``."""

    def field(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit(MISSING))

    return digest(*[field(v) for v in values])


def _levels(fanout: int) -> int:
    """Levels of a block: as many as stay within ``SPAN`` nodes, one at least."""
    levels = 1
    while fanout ** (levels + 1) <= SPAN:
        levels += 1
    return levels


def _block(nodes: DataFrame, group: str, fanout: int) -> DataFrame:
    """All levels within the blocks of ``nodes`` (group, pos, count, node): adds ``block``, ``up`` (the
    node that the block becomes) and ``path`` (left and right siblings per level)."""
    levels = _levels(fanout)
    at = nodes.selectExpr("*", f"pos div {fanout**levels} AS block", "node AS up").repartition(group, "block")
    steps: list[str] = []
    for k in range(levels):
        slot = f"(pos div {fanout**k}) % {fanout}"
        # A level above the part's last node adds nothing.
        alive = f"count > {fanout**k}"
        parent = f"(PARTITION BY {group}, block, pos div {fanout ** (k + 1)})"
        at = at.selectExpr(
            *nodes.columns, "block", "up", *steps,
            *[f"coalesce(max(CASE WHEN {slot} = {j} THEN up END) OVER {parent}, '') AS slot{j}" for j in range(fanout)],
        )
        slots = ", ".join(f"slot{j}" for j in range(fanout))
        left, right = (
            ", ".join(f"CASE WHEN {j} {side} {slot} THEN slot{j} ELSE '' END" for j in range(fanout)) for side in "<>"
        )
        step = f"CASE WHEN {alive} THEN struct(concat({left}) AS left, concat({right}) AS right) END AS step{k}"
        up = f"CASE WHEN {alive} THEN sha2(concat({slots}), 256) ELSE up END AS up"
        at = at.selectExpr(*nodes.columns, "block", *steps, step, up)
        steps.append(f"step{k}")
    return at.selectExpr(*nodes.columns, "block", "up", f"array_compact(array({', '.join(steps)})) AS path")


def _tree(nodes: DataFrame, group: str, fanout: int, name: str) -> DataFrame:
    """``nodes`` with ``path``, the siblings on the way to the top of their group, and ``top`` itself."""
    most = nodes.agg(F.max("count")).first()[0] or 0
    tier = written(_block(nodes, group, fanout), name)
    span = fanout ** _levels(fanout)
    if most <= span:
        return tier.withColumn("top", F.col("up")).drop("block", "up")
    parents = tier.groupBy(group, "block").agg(
        F.max("up").alias("node"), F.max(F.expr(f"(count + {span - 1}) div {span}")).alias("count")
    )
    above = _tree(parents.withColumnRenamed("block", "pos"), group, fanout, name).select(
        F.col(group).alias("_of"), F.col("pos").alias("_block"), F.col("path").alias("_above"), "top"
    )
    joined = tier.join(above, (F.col(group) == F.col("_of")) & (F.col("block") == F.col("_block")))
    return joined.withColumn("path", F.concat("path", "_above")).drop("block", "up", "_of", "_block", "_above")


def manifest(rows: DataFrame, fanout: int = 2, id_col: str = "doc_id", part_col: str = "lang") -> DataFrame:
    """``rows`` with ``subroot``, ``root`` and ``path``; they must have a column ``leaf``.

    Within a part the leaves ascend by id, nulls first, rows of equal id by leaf (rows equal in both are
    the same leaf twice, in two places). A null part is a part of its own, the first one; parts follow by
    their bytes. ``fanout`` consecutive nodes become one, the last run may be shorter, until one is left.
    No rows give no rows; a single row is its own root, with an empty path.
    """
    if fanout < 2:
        raise ValueError("a parent has at least two children")
    names = rows.columns
    part = F.coalesce(F.concat(F.lit("="), F.col(part_col).cast("string")), F.lit(""))
    held = rows.select(
        F.struct(*names).alias("row"), part.alias("part"), F.col(id_col).alias("id"), F.col("leaf").alias("node")
    )
    placed = with_positions(held, ["part"], ["id", "node"], "pos", "count", "merkle-leaves").drop("id")
    leaves = _tree(placed, "part", fanout, "merkle-tier")
    tops = leaves.groupBy("part").agg(F.max("top").alias("node")).withColumn("whole", F.lit(0))
    parts = with_positions(tops, ["whole"], ["part"], "pos", "count", "merkle-parts")
    parts = _tree(parts, "whole", fanout, "merkle-parts-tier").select(
        F.col("part").alias("_of"), F.col("path").alias("_above"), F.col("top").alias("root")
    )
    return leaves.join(parts, F.col("part") == F.col("_of")).select(
        "row.*", F.col("top").alias("subroot"), "root", F.concat("path", "_above").alias("path")
    )


def proof_text(path: Column) -> Column:
    """The siblings of a path, level by level and left to right, as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def folded(start: Column, path: Column) -> Column:
    """The root that a digest and a path lead to."""
    return F.aggregate(path, start, lambda node, s: digest(s["left"], node, s["right"]))


def tamper_check(docs: DataFrame) -> DataFrame:
    """List ``docs`` and check each against the list after some of them were changed.

    Where 7 divides the crc32 of the id as text (a null id: of an empty text), 1 is added to n_chars; a null
    stays null and so goes unnoticed. Returns doc_id, leaf, subroot, root, proof_sha256, folded_root and
    verified. Columns other than those of the leaf change nothing. See ``manifest`` for nulls and ties.
    """
    values = {c: F.col(c) for c in LEAF_COLUMNS}
    changed = F.when(remainder(F.col("doc_id"), 7) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    listed = docs.select(
        "doc_id", "lang", leaf(list(values.values())).alias("leaf"), leaf(list((values | {"n_chars": changed}).values())).alias("claimed")
    )
    found = manifest(listed)
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        folded(F.col("claimed"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _field(x: str) -> str:
    return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || {x}, '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(n_chars if c == "n_chars" else c) for c in LEAF_COLUMNS) + ")"


# crc32 by its definition: eight steps per byte.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: ord(ch)::UBIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda i: i::UBIGINT)),
      lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END)))"""

ORACLE = f"""
WITH RECURSIVE listed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS part, {_leaf_sql('n_chars')} AS leaf,
    CASE WHEN {_CRC32} % 7 = 0 THEN {_leaf_sql('(n_chars + 1)')} ELSE {_leaf_sql('n_chars')} END AS claimed FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id) - 1 AS pos FROM listed
), tree AS (
  SELECT 0 AS level, part, pos, leaf AS h FROM placed
  UNION ALL
  SELECT level + 1, part, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY part) AS n FROM tree) WHERE n > 1 GROUP BY level, part, pos // 2
), subroots AS (
  SELECT part, h, level AS height, row_number() OVER (ORDER BY part) - 1 AS pos
  FROM (FROM tree QUALIFY level = max(level) OVER (PARTITION BY part))
), top AS (
  SELECT 0 AS level, pos, h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY level, pos // 2
), nodes AS (
  SELECT level, part, pos, h FROM tree QUALIFY level < max(level) OVER (PARTITION BY part)
  UNION ALL
  SELECT s.height + t.level, s.part, t.pos, t.h FROM top t, subroots s WHERE t.level < (SELECT max(level) FROM top)
), way AS (
  SELECT p.doc_id, p.part, p.pos AS leaf_pos, l.level,
    CASE WHEN l.level < s.height THEN p.pos >> l.level ELSE s.pos >> (l.level - s.height) END AS pos
  FROM placed p JOIN subroots s USING (part) JOIN (SELECT DISTINCT part, level FROM nodes) l USING (part)
), steps AS (
  SELECT w.part, w.leaf_pos, w.level, w.pos % 2 = 1 AS odd, n.h AS sibling
  FROM way w LEFT JOIN nodes n ON n.part = w.part AND n.level = w.level AND n.pos = xor(w.pos, 1)
), folds AS (
  SELECT part, pos AS leaf_pos, 0 AS level, claimed AS h FROM placed
  UNION ALL
  SELECT f.part, f.leaf_pos, f.level + 1,
    sha256(CASE WHEN odd THEN sibling || h WHEN sibling IS NULL THEN h ELSE h || sibling END)
  FROM folds f JOIN steps s USING (part, leaf_pos, level)
), ended AS (
  SELECT part, leaf_pos, h FROM folds QUALIFY level = max(level) OVER (PARTITION BY part, leaf_pos)
), proofs AS (
  SELECT part, leaf_pos, string_agg(sibling, '' ORDER BY level) AS proof FROM steps GROUP BY part, leaf_pos
)
SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, sha256(coalesce(proof, '')) AS proof_sha256,
  e.h AS folded_root, e.h = r.h AS verified
FROM placed p JOIN subroots s USING (part) JOIN ended e ON e.part = p.part AND e.leaf_pos = p.pos
  LEFT JOIN proofs f ON f.part = p.part AND f.leaf_pos = p.pos
  JOIN (SELECT h FROM top ORDER BY level DESC LIMIT 1) r ON true
"""
