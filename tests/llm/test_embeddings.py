import math

import numpy as np
import pytest
from llm_rows import records
from pyspark.sql import functions as F

from sparkrecon.llm import embeddings
from sparkrecon.llm.components import components
from sparkrecon.llm.embeddings import near_duplicates

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, n STRING, cls STRING, v STRING, cell STRING"


def _brute(rows, least):
    good = [
        (k, i, np.array(v, np.float64), g)
        for k, (i, v, g) in enumerate(rows)
        if g is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (k, _, x, g) in enumerate(good):
        for k2, _, y, g2 in good[:n]:
            if g == g2 and len(x) == len(y) and math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y)) >= least:
                links[k] += 1
                links[k2] += 1
                root[find(k)] = find(k2)
    groups = {}
    for k, (i, *_) in enumerate(rows):
        groups.setdefault(find(k), []).append(i)
    low = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return sorted(str((i, links[k], low[find(k)])) for k, (i, *_) in enumerate(rows))


def _run(spark, rows, least=0.93):
    df = spark.createDataFrame([(r[0], r[1] and [x if x is None else float(x) for x in r[1]], r[2], "n", "c", "v", "x") for r in rows], SCHEMA).repartition(3)
    found = near_duplicates(df, least)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    out = records(found)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)
    return sorted(str((r["vec_id"], r["n_links"], r["component_id"])) for r in out)


def _rows(seed=0, n=300, d=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    out = []
    for i in range(n):
        v = centres[rng.integers(12)] * rng.uniform(0.1, 9) + rng.normal(size=d) * rng.choice([0, 0.05, 0.3, 1])
        out.append((i, [float(x) for x in np.float32(v)], int(rng.integers(3))))
    return out


AWKWARD = [
    (900, None, 1), (901, [], 1), (902, [0.0] * 8, 1), (903, [1.0, None] + [0.0] * 6, 1), (904, [float("nan")] + [1.0] * 7, 1),
    (905, [float("inf")] + [1.0] * 7, 1), (906, [1.0] * 8, None), (907, [1.0] * 8, 1), (908, [1.0] * 8, 1), (908, [1.0] * 8, 1),
    (909, [2.0] * 8, 1), (910, [1.0] * 3, 1), (911, [2.0] * 3, 1), (None, [1.0] * 8, 1), (None, [5.0] * 4, 1),
    (912, [3e38] * 8, 1), (913, [1e-38] * 8, 1), (914, [-1.0] * 8, 1), (915, [-0.0, 1.0, 0, 0], 2), (916, [0.0, 1.0, 0, 0], 2),
]


@pytest.mark.parametrize("cell, block", [(1_000, 1_024), (10, 7)])
def test_against_all_pairs(spark, monkeypatch, cell, block):
    monkeypatch.setattr(embeddings, "CELL", cell)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = _rows() + AWKWARD
    assert _run(spark, rows) == _brute(rows, 0.93)


def test_hot_vector_and_dense_cluster(spark):
    rng = np.random.default_rng(1)
    hot = [0.5] * 6
    rows = [(i, hot, 1) for i in range(400)] + [(400 + i, [float(x) for x in np.float32(np.array(hot) + rng.normal(size=6) * 0.02)], 1) for i in range(300)]
    assert _run(spark, rows) == _brute(rows, 0.93)


def test_no_vectors(spark):
    assert _run(spark, []) == []


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(9, 8), (8, 7), (7, 9)] + [(3, 3), (1, None), (None, 2)]
    df = spark.createDataFrame(edges + edges[:5], "a LONG, b LONG")
    found = {r["node"]: r["root"] for r in records(components(df))}
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 560)} | {7: 7, 8: 7, 9: 7}
    assert found == want
    assert components(df.filter(F.lit(False))).count() == 0
