import math
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from conftest import SMALL
from llm_rows import records
from pyspark.sql import functions as F

from sparkrecon.llm import neighbours
from sparkrecon.llm.neighbours import Forest, _ranked, best, nearest
from sparkrecon.llm.queries import op12_neighbour_forest

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, q STRING, cls STRING, v STRING, leaf STRING, score STRING, rank INT"


def _table(spark, rows):
    full = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, "q", "c", "v", "l", "s", 7) for i, v in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def _brute(rows, asks, k):
    """{(id of the query, its vector): [(score, id)] of the best k, ties to the smaller id}"""
    good = [(i, tuple(map(float, v))) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for n, (i, x) in enumerate(good):
        if asks(i) and (i, x) not in out:
            others = [(sum(a * b for a, b in zip(x, y)), j) for m, (j, y) in enumerate(good) if m != n and len(y) == len(x)]
            others.sort(key=lambda t: (-t[0], t[1] is None, t[1] or 0))
            if others:
                out[i, x] = others[:k]
    return out


def _by_query(found):
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    out = defaultdict(list)
    for r in sorted(records(found), key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


AWKWARD = [
    (900, None), (920, []), (940, [0.0] * 4), (960, [1.0, None, 0, 0]), (980, [math.nan] + [1.0] * 3), (1000, [math.inf] + [1.0] * 3),
    (0, [1.0, 2, 3, 4]), (1, [1.0, 2, 3, 4]), (2, [1.0, 2, 3, 4]), (20, [2.0, 4, 6, 8]), (40, [-1.0, 0, 0, 0]), (40, [-1.0, 0, 0, 0]),
    (60, [5.0, 5, 5]), (61, [1.0, 0, 0]), (80, [1.0, 1]), (None, [3.0, 0, 0, 0]), (None, [3.0, 0, 0, 0]), (3, [0.0, 1, 0, -1]),
    (100, [-0.0, 1, 0, 0]), (101, [0.0, 1, 0, 0]),
]


@pytest.mark.parametrize("k", [2, 20])
def test_awkward_rows(spark, k):
    found = _by_query(nearest(_table(spark, AWKWARD), F.col("vec_id") % 20 == 0, k=k, recall=1.0))
    want = {i: v for (i, _), v in _brute(AWKWARD, lambda i: i is not None and i % 20 == 0, k).items()}
    assert found == want
    assert 80 not in found and 900 not in found


def test_no_vectors(spark):
    assert nearest(_table(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest(_table(spark, [(1, [1.0, 2])]), F.col("vec_id") % 20 == 0).count() == 0


@pytest.fixture
def many_partitions(spark):
    """Small tables stay in their partitions, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_vector_in_many_blocks(spark, monkeypatch, many_partitions):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 0.5, -1.0, 2.0]) for i in range(200)]
    rows += [(200 + i, [float(x) for x in np.float32(rng.normal(size=4))]) for i in range(400)]
    found = _by_query(nearest(_table(spark, rows), F.col("vec_id") % 20 == 0, k=5, leaf=40, recall=1.0))
    want = {i: v for (i, _), v in _brute(rows, lambda i: i % 20 == 0, 5).items()}
    assert {i: [j for _, j in v] for i, v in found.items()} == {i: [j for _, j in v] for i, v in want.items()}
    for i, v in found.items():
        assert np.allclose([s for s, _ in v], [s for s, _ in want[i]], rtol=1e-14)


def test_recall_on_many_leaves(spark, many_partitions):
    """Clusters, lengths that differ, and noise: the wanted share is found without looking at all."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 16)) * 3
    rows = [(i, (centres[i % 30] + rng.normal(size=16)) * rng.uniform(0.5, 2)) for i in range(3000)]
    df = _table(spark, [(i, [float(x) for x in np.float32(v)]) for i, v in rows])
    found = _by_query(nearest(df, F.col("vec_id") % 20 == 0, k=10, leaf=64))
    x = np.float32([v for _, v in rows]).astype(np.float64)
    hits = 0
    for i in range(0, 3000, 20):
        score = x @ x[i]
        score[i] = -np.inf
        hits += len(set(np.argsort(-score)[:10]) & {j for _, j in found[i]})
        assert len(found[i]) == 10 and all(abs(score[j] - s) < 1e-9 for s, j in found[i])
    assert hits >= 0.9 * 10 * 150


def test_recall_of_the_query(spark):
    found = _by_query(op12_neighbour_forest(spark, SMALL))
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    want = _brute(rows, lambda i: i % 20 == 0, 20)
    assert len(found) == len(want) > 0
    hits = sum(len({j for _, j in v} & {j for _, j in found[i]}) for (i, _), v in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_forest_places_and_finds():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 6))
    forest = Forest(x, 3, 20)
    leaves = forest.place(x)
    sizes = np.bincount(leaves.ravel(), minlength=forest.leaves)
    assert sizes.sum() == 1500 and sizes.max() <= 20
    ways = forest.search(x, sizes, np.inf)
    assert all(sorted(w) == sorted(np.flatnonzero(sizes)) for w in ways)
    # The leaves that hold the vector itself are not beyond any plane, so they come first.
    assert all(set(w[:3]) == set(own) for w, own in zip(ways, leaves.tolist(), strict=True))
    same = Forest(np.ones((50, 6)), 2, 8)
    assert same.leaves == 2 and (same.place(np.ones((4, 6))) == [[0, 1]] * 4).all()


def test_best_breaks_ties_by_first():
    q, x = np.array([[1.0, 0]]), np.array([[1.0, 5], [1, 7], [2, 0], [1, 1]])
    i, j, score = best(q, x, np.array([9.0, 3, 5, np.inf]), 3)
    assert j.tolist() == [2, 1, 0] and score.tolist() == [2, 1, 1] and i.tolist() == [0, 0, 0]


def test_a_query_returns_its_best_over_all_leaves_of_a_task():
    """Not its best of every leaf: rows do not grow with the leaves that it visits."""
    rng = np.random.default_rng(3)
    x, q, k, leaves = rng.normal(size=(600, 5)), rng.normal(size=(7, 5)), 4, 30
    x[300:320] = x[:20]  # classes tied in score
    leaf = rng.integers(leaves, size=(600, 2)) + [0, leaves]  # of two trees
    rows = []
    for block in (0, 1):
        rows += [(3, block, 0, -1, 9000 + i, None, v, np.arange(2 * leaves)) for i, v in enumerate(q)]
        met = [(3, block, 0, leaf[i, t], i, None if i == 5 else 2 * i, x[i], None) for i in range(600) for t in (0, 1)]
        rows += sorted(met, key=lambda r: r[3])
    part = pd.DataFrame(rows, columns=["d", "q_block", "grp", "leaf", "id", "first_id", "v", "leaves"])
    for size in (10_000, 97, 3):
        found = pd.concat(_ranked(k)(part.iloc[at : at + size] for at in range(0, len(part), size)))
        assert len(found) == 2 * len(q) * k
        for i, of in found.iloc[: len(q) * k].groupby("q"):
            score = (q[i - 9000] * x).sum(axis=1)
            assert of["cls"].tolist() == sorted(range(600), key=lambda j: (-score[j], j if j != 5 else 1e9))[:k]
