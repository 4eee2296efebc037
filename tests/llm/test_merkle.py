import hashlib
import zlib

import pytest
from llm_rows import MESSY, documents, messy, nothing, records  # noqa: F401
from pyspark.sql import functions as F

from sparkrecon.llm import merkle
from sparkrecon.llm.merkle import folded, manifest, tamper_check

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(values):
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _climb(nodes, fanout):
    """Levels from the leaves up to the one node that is left."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_h(*last[i : i + fanout]) for i in range(0, len(last), fanout)])
    return levels


def _siblings(levels, at, fanout):
    out = []
    for level in levels[:-1]:
        first = at - at % fanout
        out.append(("".join(level[first:at]), "".join(level[at + 1 : first + fanout])))
        at //= fanout
    return out


def _expected(rows, fanout=2):
    """rows: (doc_id, part, leaf, claimed)"""
    parts = {}
    for r in rows:
        parts.setdefault(r[1], []).append(r)
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {}
    for p in names:
        parts[p].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees[p] = _climb([r[2] for r in parts[p]], fanout)
    top = _climb([trees[p][-1][0] for p in names], fanout)
    out = []
    for i, p in enumerate(names):
        above = _siblings(top, i, fanout)
        for at, (doc_id, _, leaf, claimed) in enumerate(parts[p]):
            path = _siblings(trees[p], at, fanout) + above
            node = claimed
            for left, right in path:
                node = _h(left, node, right)
            root = top[-1][0]
            out.append((doc_id, leaf, trees[p][-1][0], root, _h(*[x + y for x, y in path]), node, node == root))
    return out


def _rows(full):
    out = []
    for r in full:
        values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]]
        changed = zlib.crc32("" .encode() if r["doc_id"] is None else str(r["doc_id"]).encode()) % 7 == 0
        tampered = [*values[:3], values[3] + 1 if changed and values[3] is not None else values[3], values[4]]
        out.append((r["doc_id"], r["lang"], _leaf(values), _leaf(tampered)))
    return out


def _same(found, want):
    # Rows alike in id and leaf hold two places; which of them has which is not told.
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, found)) == sorted(map(key, want))


@pytest.mark.parametrize("span", [1024, 4])
def test_messy_rows(messy, monkeypatch, span):
    monkeypatch.setattr(merkle, "SPAN", span)
    found = tamper_check(messy)
    assert found.columns == COLUMNS
    want = _expected(_rows(records(messy)))
    _same([tuple(r) for r in found.collect()], want)
    assert any(not r[-1] for r in want) and any(r[-1] for r in want)


@pytest.mark.parametrize("fanout, span", [(3, 1024), (5, 30)])
def test_other_fanouts(spark, monkeypatch, fanout, span):
    monkeypatch.setattr(merkle, "SPAN", span)
    rows = [(i, f"p{i % 4}" if i % 4 else None, _h(str(i)), _h(str(i + i % 2))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id LONG, lang STRING, leaf STRING, claimed STRING").repartition(4)
    found = manifest(df, fanout).withColumn("end", folded(F.col("claimed"), F.col("path")))
    proof = F.sha2(merkle.proof_text(F.col("path")), 256)
    got = found.select("doc_id", "leaf", "subroot", "root", proof, "end", F.col("end") == F.col("root")).collect()
    _same([tuple(r) for r in got], _expected(rows, fanout))


def test_many_parts_and_a_hot_one(spark):
    rows = [(i, "hot" if i % 3 else f"p{i}", _h(str(i)), _h(str(i))) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id LONG, lang STRING, leaf STRING, claimed STRING").repartition(4)
    found = manifest(df).withColumn("end", folded(F.col("claimed"), F.col("path")))
    assert found.filter("end = root").count() == 3000
    assert {r[0] for r in found.select("root").distinct().collect()} == {_expected(rows)[0][3]}


def test_small_tables(spark, nothing):
    assert tamper_check(nothing).count() == 0
    one = tamper_check(documents(spark, [(1, "a", None, None)])).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["verified"]
    assert one["proof_sha256"] == _h("")
    with pytest.raises(ValueError, match="two children"):
        manifest(documents(spark, []).withColumn("leaf", F.lit("")), 1)
