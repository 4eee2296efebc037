import re
from collections import defaultdict

import pytest
from llm_rows import MESSY, documents, messy, nothing, records  # noqa: F401
from pyspark.sql import functions as F

from sparkrecon.llm.mixing import mix, mixed_documents, source_targets


def _targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """The rule as stated: stop at the cap, share the excess anew by weight, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, found = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > cap * sizes[s]}
        if not over:
            return found | {s: left * weight[s] / total for s in open_}
        for s in over:
            found[s] = cap * sizes[s]
            left -= found[s]
        open_ -= over
    return found


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "c": 50, None: 7}, {"x": 5}, {"é": 40, "z": 1, "Z": 900, "": 3}, {"a": 0, "b": 9}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source STRING, size LONG")
    got = {r["source"]: r["target"] for r in records(source_targets(rows))}
    assert got == pytest.approx(_targets(sizes))


def test_messy_rows(messy, nothing):
    found = records(mix(messy))
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(m[0]) for m in MESSY)
    sizes = defaultdict(int)
    for _, t, _, s in MESSY:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = _targets(sizes)
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
    assert mix(nothing).count() == 0


def _plain(spark, n=6000):
    """A source with two thirds of the documents, and sizes of 1 to 40 words."""
    source = F.when(F.col("id") % 3 < 2, "big").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string")))
    text = F.concat_ws(" ", F.array_repeat(F.lit("w"), (F.col("id") * 7919 % 40 + 1).cast("int")))
    return spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"), source.alias("source"))


def test_sources_meet_their_targets_and_reruns_agree(spark):
    docs = _plain(spark)
    found = mix(docs).cache()
    for r in records(found.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))):
        assert abs(r["taken"] - r["target"]) <= 21  # half of the largest document, and a rounding
    again = mix(docs.repartition(7, "text"))
    assert sorted(found.select("doc_id", "copies").collect()) == sorted(again.select("doc_id", "copies").collect())


def test_every_document_keeps_its_expectation(spark):
    """Over many seeds a document is taken as often as its source's rate says."""
    docs = documents(spark, [(i, "w " * (i % 9 + 1), None, "a" if i % 4 else "b") for i in range(240)])
    total, rate = defaultdict(int), {}
    for seed in range(12):
        for r in mix(docs, seed=seed).collect():
            total[r["doc_id"]] += r["copies"]
            rate[r["doc_id"]] = r["target"] / r["source_size"]
    for group in (range(0, 240, 4), range(1, 240, 4)):
        assert sum(total[i] for i in group) / 12 == pytest.approx(sum(rate[i] for i in group), rel=0.1)
    assert len({total[i] for i in range(1, 240, 4)}) > 1


def test_documents_are_repeated(messy, spark, nothing):
    found = mixed_documents(messy)
    assert found.columns == messy.columns
    want = defaultdict(int)
    for r in mix(messy).collect():
        want[str(r["doc_id"]), r["size"]] += r["copies"]
    got = defaultdict(int)
    for r in found.collect():
        got[str(r["doc_id"]), len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))] += 1
    assert got == {k: v for k, v in want.items() if v}
    assert mixed_documents(nothing).count() == 0


def test_no_python_on_the_main_path(spark, messy):
    run = mix(messy)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in run and "Arrow" not in run
