import os
import sys
from collections import defaultdict

import duckdb
import pytest
from conftest import ROOT, SMALL
from llm_rows import MESSY, documents, records

import __spark_entry__ as entry
import corpus_pipeline
from sparkrecon.llm import exact_dedup, language, mixing, near_dedup
from sparkrecon.llm.queries import ORACLE_SQL, QUERIES

sys.path.insert(0, os.path.join(ROOT, "tools"))
import parity  # noqa: E402


def test_registered():
    found = entry.queries()
    for n in range(1, 14):
        assert len([k for k in found if k.startswith(f"op{n}_")]) == 1
    assert "pipeline" in found and set(QUERIES) <= set(found)
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("key", list(ORACLE_SQL))
def test_equal_to_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = QUERIES[key](spark, SMALL)
    cursor = con.execute(ORACLE_SQL[key])
    assert parity.rows(df.columns, df.collect()) == parity.rows([c[0] for c in cursor.description], cursor.fetchall())


def _stages(spark, docs):
    from sparkrecon.sources.tables import written

    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(written(stage(spark, seen[-1], "unused"), f"test-{name}"))
    return seen


@pytest.mark.parametrize("rows", [MESSY, [], [(1, None, None, None)]])
def test_stages_on_messy_rows(spark, rows):
    seen = _stages(spark, documents(spark, rows))
    assert all(df.columns == seen[0].columns for df in seen[1:-1])
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} == set(seen[-1].columns)


def test_each_stage_does_what_its_operator_says(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    _, readable, single, apart, mixed, packed = _stages(spark, docs)

    def ids(df):
        return sorted(r[0] for r in df.select("doc_id").collect())

    assert ids(readable) == ids(language.identify(docs).filter("lang_pred <> 'und'"))
    assert ids(single) == ids(exact_dedup.exact_dedup(readable).filter("kept"))
    assert ids(apart) == ids(near_dedup.near_duplicates(single).filter("kept"))
    copies = {r["doc_id"]: r["copies"] for r in records(mixing.mix(apart))}
    assert ids(mixed) == sorted(i for i, n in copies.items() for _ in range(n))
    pieces = defaultdict(int)
    for r in records(packed):
        pieces[r["doc_id"]] += r["piece"] == 0
    assert pieces == {i: n for i, n in copies.items() if n}
    rows = {r["doc_id"]: r for r in docs.collect()}
    assert all(rows[r["doc_id"]] == r for r in mixed.collect())


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.groupBy("sequence_id").sum("length").filter("`sum(length)` > 4096").count() == 0 < found.count()
