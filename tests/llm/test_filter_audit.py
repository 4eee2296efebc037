import re
from collections import defaultdict
from itertools import permutations

import pytest
from llm_rows import EXTRA, MESSY, documents, messy, nothing, records  # noqa: F401
from pyspark.sql import functions as F

from sparkrecon.llm.filter_audit import audit, combinations

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
LABELS = "doc_id LONG, quality INT, toxic INT, text STRING, part STRING"


def _labels(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], LABELS)


def _failed(text, smaller):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = {"A"} if len(words) < 100 else set()
    found |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
    found |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else set()
    found |= {"D"} if re.search(r"[#$%&*|]", text) else set()
    return found | ({"E"} if smaller else set())


def _expected(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, t, g, *_ in rows:
        smaller = i is not None and any(j is not None and j < i and (u or "") == (t or "") for j, u, *_ in rows)
        docs.append((g or "", _failed(t or "", smaller), i in good, i in toxic))
    out, removed = {}, defaultdict(int)
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            for step, name in enumerate(order, 1):
                row = [0] * 6
                for p, failed, is_good, is_toxic in docs:
                    if p == part:
                        gone, fails = bool(failed & set(order[: step - 1])), name in failed
                        row[0] += not gone and not fails
                        row[1] += fails and not gone
                        row[2] += fails and gone
                        row[3] += failed == {name}
                        row[4] += fails and not gone and is_good
                        row[5] += fails and not gone and is_toxic
                out[part, "".join(order), step] = row
                removed[part, name] += row[1]
    return {k: [*v, removed[k[0], k[1][k[2] - 1]]] for k, v in out.items()}


def _check(found, rows, labels):
    assert found.columns == COLUMNS
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS[3:]] for r in found.collect()}
    assert got == _expected(rows, labels)


LONG_ROWS = [
    (20, " ".join(f"w{i}" for i in range(150)), "en", "a"),
    (21, " ".join(f"w{i}" for i in range(150)), "fr", "a"),
    (22, " ".join(f"w{i % 9}" for i in range(150)), "", "a"),
    (23, " ".join(f"W{i % 9}#" for i in range(150)), "en", "a"),
    (24, " ".join(f"WORD{i}" for i in range(150)), "en", "a"),
    (19, " ".join(f"WORD{i}" for i in range(150)), "fr", "a"),
]


def test_messy_rows(spark, messy):
    labels = [(7, 1, 0), (7, 1, 0), (9, 0, 1), (None, 1, 1), (2, None, None), (20, 1, 1), (24, 1, None), (21, 0, 1), (77, 1, 1)]
    rows = MESSY + LONG_ROWS
    _check(audit(documents(spark, rows).repartition(3), _labels(spark, labels)), rows, labels)


def test_empty_tables(spark, messy, nothing):
    assert audit(nothing, _labels(spark, [(1, 1, 1)])).count() == 0
    _check(audit(messy, _labels(spark, [])), MESSY, [])


def test_hot_text(spark):
    docs = spark.range(0, 9000, 1, 6).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "one hot text").otherwise(F.concat(F.lit("text "), "id")).alias("text"),
        F.lit(None).cast("string").alias("lang"),
    )
    found = combinations(docs, _labels(spark, [(0, 1, 0), (3, 1, 0), (4, 0, 1)]))
    rows = {r["bits"]: (r["part"], r["n"], r["good"], r["toxic"]) for r in found.collect()}
    assert rows == {1: ("", 6001, 1, 1), 17: ("", 2999, 1, 0)}


def test_other_filters(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "b", "x")], "doc_id LONG, text STRING, lang STRING")
    found = audit(docs, _labels(spark, []), filters=lambda t: {"Q": t == "b"}).orderBy("filter_order", "step").collect()
    assert [(r["filter_order"], r["kept"], r["removed"], r["redundant"], r["shapley"]) for r in found] == [
        ("EQ", 2, 1, 0, 1), ("EQ", 1, 1, 1, 3), ("QE", 1, 2, 0, 3), ("QE", 1, 0, 1, 1),
    ]
    with pytest.raises(ValueError, match="too many orders"):
        audit(docs, _labels(spark, []), filters=lambda t: {c: t == c for c in "abcdefg"})
