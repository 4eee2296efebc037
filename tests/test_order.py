"""Positions and shares in groups that span many partitions."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sparkrecon.plans.order import PART, before, ranged, with_positions


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """Small tables stay in their partitions, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _rows():
    return [("hot" if i % 3 else None, (i * 7919) % 1000, i) for i in range(2000)] + [("one", 5, -1)]


def test_positions(spark):
    df = spark.createDataFrame(_rows(), "g STRING, x INT, id INT").repartition(5)
    found = with_positions(df, ["g"], ["x", "id"], "at", "size", "positions").collect()
    want = defaultdict(list)
    for g, x, i in _rows():
        want[g].append((x, i))
    assert len(found) == 2001
    for r in found:
        assert sorted(want[r["g"]])[r["at"]] == (r["x"], r["id"]) and r["size"] == len(want[r["g"]])
    assert with_positions(df.filter(F.lit(False)), ["g"], ["x", "id"], "at", "size", "none").count() == 0


def test_shares_before(spark):
    df = spark.createDataFrame(_rows(), "g STRING, x INT, id INT").repartition(5)
    cut = ranged(df, ["g"], ["x"], "ranged")
    shares = before(cut.groupBy("g", PART).agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")), ["g"], "n", "b")
    rows = shares.orderBy("g", PART).collect()
    assert len(rows) > 3
    seen = defaultdict(int)
    last = {}
    for r in rows:
        assert r["b"] == seen[r["g"]] and r["lo"] >= last.get(r["g"], -1)
        seen[r["g"]] += r["n"]
        last[r["g"]] = r["hi"]
