"""Joins and sorts that keep their balance when one key or one sort value holds much of a table.

A full outer join is put together from an inner join and the unmatched rows of either side:

* In the inner join AQE splits a skewed partition of either side, which it does not in a full outer
  join.
* For unmatched rows only the keys of the other side are needed. They are made nearly distinct first,
  which no repeated key survives, and then meet the rows in an anti join of which AQE splits a skewed
  partition of the rows.

Both parts shuffle the same rows by the same key, so Spark runs that shuffle once and reuses it.

AQE judges partitions by bytes, but a few thousand rows of one key on both sides are millions of pairs.
Keys with more pairs than a task should form are therefore counted beforehand and joined in blocks of
rows (``block_pairs``): the pairs are the same, but no task has more than a few blocks of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import written

KEY, TAG = "_key", "_tag"
ID = [KEY, TAG]

# A key is kept once per this many groups of map tasks. The rest of a distinct would put an aggregate
# between shuffle and join, and AQE only splits a join that reads its shuffles directly.
_COPIES = 8

# Rows of one key in a block. A key with more pairs than two blocks have is joined block by block.
_BLOCK = 2048
_BLOCKS = ["_left_block", "_right_block"]
# Tasks that join blocks: one per pair of blocks, up to this many.
_BLOCK_TASKS = 20_000


def _common_type(left: T.DataType, right: T.DataType) -> str:
    """The type in which two key columns are compared. Text and numbers have none in common."""
    if left == right:
        return left.simpleString()
    kinds = {left.simpleString(), right.simpleString()}
    if kinds <= {"tinyint", "smallint", "int", "bigint"}:
        return "bigint"
    if all(isinstance(t, T.NumericType) for t in (left, right)):
        return "double"
    if kinds <= {"date", "timestamp", "timestamp_ntz"}:
        return "timestamp"
    raise ValueError(f"keys of types {left.simpleString()} and {right.simpleString()} cannot be compared")


def tag_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str, null_keys: str):
    """Replace the key columns by (_key, _tag), equal exactly where the keys are to match.

    ``null_keys="match"`` lets null equal null; ``"never"`` gives null another tag on each side. Keys
    of different types are brought to their common type first.
    """
    if null_keys not in ("match", "never"):
        raise ValueError(f"null_keys must be 'match' or 'never', not {null_keys!r}")
    kind = _common_type(left.schema[left_key].dataType, right.schema[right_key].dataType)

    def tagged(df, name, null_tag):
        key = F.col(name).cast(kind).cast("string")
        ids = {
            KEY: F.coalesce(key, F.lit("")),
            TAG: F.when(key.isNull(), F.lit(null_tag)).otherwise(F.lit(0)),
        }
        return df.withColumns(ids).drop(name)

    return tagged(left, left_key, 1), tagged(right, right_key, 1 if null_keys == "match" else 2)


def plain_key() -> Column:
    """The original key of a tagged row."""
    return F.when(F.col(TAG) == 0, F.col(KEY))


def full_outer(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer join of two tagged frames. Their other columns must have different names.

    Counts the rows per key first, in a job of its own that reads the keys only.
    """
    crowded = written(crowded_keys(left, right), "crowded-keys")
    products = [F.col(f"{b}s").cast("double") for b in _BLOCKS]
    blocks = crowded.agg(F.sum(products[0] * products[1])).head()[0]
    if blocks is None:
        return _outer(left, right)
    rest = [side.join(crowded, ID, "left_anti") for side in (left, right)]
    found = block_pairs(left, right, crowded, int(min(blocks, _BLOCK_TASKS)))
    return _outer(*rest).unionByName(found, allowMissingColumns=True)


def _outer(left: DataFrame, right: DataFrame) -> DataFrame:
    pairs = left.join(right, ID)
    left_only, right_only = anti(left, right), anti(right, left)
    return pairs.unionByName(left_only, allowMissingColumns=True).unionByName(
        right_only, allowMissingColumns=True
    )


def crowded_keys(left: DataFrame, right: DataFrame) -> DataFrame:
    """Keys of tagged frames with more pairs than two blocks of rows have, and into how many blocks
    their rows are to be cut on either side."""
    one, none = F.lit(1), F.lit(0)
    keys = left.select(*ID, one.alias("_l"), none.alias("_r")).union(right.select(*ID, none, one))
    counted = keys.groupBy(*ID).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    blocks = [F.ceil(F.col(n) / _BLOCK).alias(f"{b}s") for n, b in zip(("_l", "_r"), _BLOCKS)]
    return counted.filter(F.col("_l").cast("double") * F.col("_r") > float(_BLOCK**2)).select(*ID, *blocks)


def block_pairs(left: DataFrame, right: DataFrame, crowded: DataFrame, tasks: int) -> DataFrame:
    """Inner join of tagged frames on the ``crowded`` keys. Every row is copied for each block of the
    other side, and each pair of blocks is joined by itself."""
    sides = zip((left, right), _BLOCKS, reversed(_BLOCKS))
    cut = [_in_blocks(side, crowded, own, other).repartition(tasks, *ID, *_BLOCKS) for side, own, other in sides]
    # Estimates do not see the copies, so a side would be broadcast that is too large for it.
    return cut[0].join(cut[1].hint("merge"), [*ID, *_BLOCKS]).drop(*_BLOCKS)


def _in_blocks(side: DataFrame, crowded: DataFrame, own: str, other: str) -> DataFrame:
    """The block of a row is a hash of its place in a written table: as even for copies of one row as
    for others, and the same when a lost task is run again."""
    rows = written(side.join(crowded, ID), "crowded-rows").withColumn("_place", F.monotonically_increasing_id())
    return rows.select(
        *side.columns,
        F.pmod(F.xxhash64("_place"), F.col(f"{own}s")).alias(own),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}s") - 1)).alias(other),
    )


def anti(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of tagged ``left`` whose key does not occur in tagged ``right``."""
    copy = (F.spark_partition_id() % _COPIES).alias("_copy")
    keys = right.select(*ID, copy).distinct().select(*ID)
    return left.join(keys, ID, "left_anti")


def sorted_rows(df: DataFrame, *orders: Column) -> DataFrame:
    """Global sort that a popular sort value cannot skew: ties are broken by a hash of the row, so
    the range partitioner can cut within the rows of one date or one key. The partition number
    separates exact copies; unlike rand() it is the same when a lost task is run again."""
    tie = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns])
    return df.withColumn("_tie", tie).orderBy(*orders, F.col("_tie")).drop("_tie")
