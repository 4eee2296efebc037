"""Hot keys: joins that AQE splits, with the same result."""

import re
from collections import Counter

import pytest
from conftest import records
from pyspark.sql import functions as F

from sparkrecon.operators import dq
from sparkrecon.plans import skew


def sides(spark):
    """A third of the left rows has key HOT, a third of the right rows has none."""
    left = spark.range(0, 3000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("L"), "id")).alias("k"),
        F.col("id").alias("l"),
    )
    right = spark.range(0, 600, 1, 4).select(
        F.when(F.col("id") % 3 == 0, None)
        .when(F.col("id") == 1, "HOT")
        .otherwise(F.concat(F.lit("L"), "id"))
        .alias("k"),
        F.col("id").alias("r"),
    )
    return left, right


def test_null_is_not_the_empty_key(spark):
    left = spark.createDataFrame([("", 1), (None, 2)], "k STRING, l INT")
    right = spark.createDataFrame([("", 3)], "k STRING, r INT")
    for mode in ("match", "never"):
        joined = skew.full_outer(*skew.tag_keys(left, right, "k", "k", mode))
        found = joined.select(skew.plain_key().alias("key"), "l", "r")
        assert {tuple(r) for r in found.collect()} == {("", 1, 3), (None, 2, None)}


@pytest.mark.parametrize("mode", ["match", "never"])
def test_full_outer_equals_sparks(spark, mode):
    left, right = sides(spark)
    right = right.union(spark.createDataFrame([("", 1000), ("HOT", 1001)], "k STRING, r BIGINT"))
    left = left.union(spark.createDataFrame([(None, 9000), (None, 9001)], "k STRING, l BIGINT"))
    a, b = skew.tag_keys(left, right, "k", "k", mode)
    want = a.join(b, skew.ID, "full").select(*skew.ID, "l", "r")
    got = skew.full_outer(a, b).select(*skew.ID, "l", "r")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_anti_join_with_hot_keys(spark):
    left, right = sides(spark)
    known = {r["k"] for r in records(right)}
    want = sorted(r["l"] for r in records(left) if r["k"] not in known)
    assert sorted(r["l"] for r in records(dq.unmatched(left, "k", right, "k", ["l"]))) == want
    assert dq.unmatched(right, "k", left, "k", ["r"]).count() == 200


def test_anti_join_returns_null_keys_even_if_both_sides_have_them(spark):
    left = spark.createDataFrame([(None, 1), ("A", 2)], "k STRING, l INT")
    right = spark.createDataFrame([(None,), ("A",)], "q STRING")
    assert records(dq.unmatched(left, "k", right, "q", ["l"])) == [{"l": 1}]


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}


@pytest.fixture
def small_partitions(spark):
    """Settings under which a few thousand rows of one key count as a skewed partition."""
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k in SKEW:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _hot(spark, name, share):
    key = F.when(F.col("id") % share == 0, "HOT").otherwise(F.concat(F.lit("L"), "id"))
    return spark.range(0, 60000, 1, 16).select(key.alias("k"), F.col("id").alias(name))


@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_inner_part_is_split_by_aqe(spark, small_partitions, hot_side):
    """The pairs come from a join whose skewed partitions AQE cuts, on either side."""
    left = _hot(spark, "l", 3)
    right = left.filter("k != 'HOT' OR l < 10").withColumnRenamed("l", "r")
    pair = (left, right) if hot_side == "left" else (right, left)
    joined = skew.full_outer(*skew.tag_keys(*pair, "k", "k", "match"))
    assert len(joined.collect()) == 20000 * 4 + 40000
    assert re.search(r"SortMergeJoin\(skew=true\).*Inner", _plan(joined))


@pytest.mark.parametrize("other_hot", [False, True])
def test_anti_join_is_split_by_aqe(spark, small_partitions, other_hot):
    """Also where the key is hot on the other side; there it arrives as a few rows."""
    left = _hot(spark, "l", 3)
    other = _hot(spark, "r", 3).filter("k = 'HOT' OR r < 30000") if other_hot else _hot(spark, "r", 3).filter("k <> 'HOT'")
    a, b = skew.tag_keys(left, other, "k", "k", "never")
    found = skew.anti(a, b)
    assert len(found.collect()) == 20000
    assert re.search(r"SortMergeJoin\(skew=true\).*LeftAnti", _plan(found))


def test_keys_of_different_types(spark):
    ids = spark.createDataFrame([(1,), (2,), (None,)], "k BIGINT")
    amounts = spark.createDataFrame([(1.0,), (2.5,), (None,)], "k DOUBLE")
    a, b = skew.tag_keys(ids, amounts, "k", "k", "never")
    assert a.join(b, skew.ID).count() == 1 and skew.anti(a, b).count() == 2
    with pytest.raises(ValueError, match="cannot be compared"):
        skew.tag_keys(ids, spark.createDataFrame([("1",)], "k STRING"), "k", "k", "match")


def test_sort_cuts_within_one_sort_value(spark):
    same_day = spark.range(0, 20000, 1, 8).select(F.lit("2024-01-01").alias("day"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        done = skew.sorted_rows(same_day, F.desc("day"))
        # Collected rows, since an aggregate would let the optimizer drop the sort.
        places = records(done.select(F.spark_partition_id().alias("p")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = Counter(r["p"] for r in places)
    assert len(sizes) == 8 and max(sizes.values()) < 5000


def test_order_is_the_one_asked_for(spark):
    df = spark.createDataFrame([(3, "a"), (1, "b"), (2, "c"), (3, "d")], "n INT, s STRING")
    assert [r["n"] for r in skew.sorted_rows(df, F.desc("n")).collect()] == [3, 3, 2, 1]


def test_null_keys_argument_is_checked(spark):
    df = spark.createDataFrame([("A", 1)], "k STRING, v INT")
    with pytest.raises(ValueError, match="sometimes"):
        skew.tag_keys(df, df, "k", "k", "sometimes")


@pytest.mark.parametrize("mode", ["match", "never"])
def test_pairs_of_crowded_keys_are_cut_into_blocks(spark, monkeypatch, mode):
    """Rows of few bytes, copies among them: AQE sees nothing to split, yet no task has most of the pairs."""
    monkeypatch.setattr(skew, "_BLOCK", 16)
    left = spark.range(0, 400, 1, 3).select(
        F.when(F.col("id") < 200, None).when(F.col("id") < 300, "A").otherwise(F.concat(F.lit("L"), "id")).alias("k"),
        F.when(F.col("id") < 150, 0).otherwise(F.col("id")).alias("l"),
    )
    right = spark.range(0, 400, 1, 3).select(
        F.when(F.col("id") < 150, None).when(F.col("id") < 152, "A").when(F.col("id") < 155, "")
        .otherwise(F.concat(F.lit("L"), "id")).alias("k"),
        F.when(F.col("id") < 100, 0).otherwise(F.col("id")).alias("r"),
    )
    a, b = skew.tag_keys(left, right, "k", "k", mode)
    found = skew.full_outer(a, b).select(*skew.ID, "l", "r")
    rows = records(found.withColumn("task", F.spark_partition_id()))
    want = a.join(b, skew.ID, "full").select(*skew.ID, "l", "r")
    assert Counter((*(r[c] for c in found.columns),) for r in rows) == Counter(map(tuple, want.collect()))
    sizes = Counter(r["task"] for r in rows)
    assert mode == "never" or max(sizes.values()) < 200 * 150 / 8


def test_no_key_is_crowded_if_its_pairs_fit_two_blocks(spark, monkeypatch):
    monkeypatch.setattr(skew, "_BLOCK", 10)
    left = spark.createDataFrame([("A",)] * 100 + [("B",)] * 101 + [("C",)] * 900, "k STRING")
    right = spark.createDataFrame([("A",), ("B",), ("D",)], "k STRING")
    found = skew.crowded_keys(*skew.tag_keys(left, right, "k", "k", "match"))
    assert [tuple(r) for r in found.collect()] == [("B", 0, 11, 1)]
