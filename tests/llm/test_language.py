import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import MESSY, documents, messy, nothing, records  # noqa: F401
from pyspark.sql import functions as F

from sparkrecon.llm.common import remainder
from sparkrecon.llm.language import BUCKETS, _expect, _fit, explained, held_out, identify, infer, learn, predict, readable_documents


def test_remainder_is_crc32_of_the_id(spark):
    import zlib

    rows = spark.createDataFrame([(i,) for i in [0, 1, 2, 3, 77, -5, 10**12, None]], "doc_id LONG")
    for r in rows.select("doc_id", remainder(F.col("doc_id"), 3).alias("m")).collect():
        assert r["m"] == zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").cache()
    out = found.filter("held_out")
    assert found.count() == docs.count()
    assert out.filter("lang = lang_pred").count() >= 0.98 * out.filter("lang IS NOT NULL").count()
    assert found.filter("score < 0 OR score > 1 OR isnan(score)").count() == 0


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lied = docs.withColumn("lang", F.when(held_out(), F.lit("zz")).otherwise(F.col("lang")))
    a = identify(docs).select("doc_id", "lang_pred", "score").collect()
    assert sorted(a) == sorted(identify(lied).select("doc_id", "lang_pred", "score").collect())


def test_messy_rows(messy, nothing):
    found = records(identify(messy))
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(m[0]) for m in MESSY)
    und = sorted(r["doc_id"] for r in found if r["lang_pred"] == "und")
    assert und == [-5, 1, 2, 4] and all(r["score"] == 0 for r in found if r["lang_pred"] == "und")
    assert identify(nothing).count() == 0
    kept = readable_documents(messy)
    assert kept.columns == messy.columns and kept.count() == len(MESSY) - 4


def test_no_language_learned(spark):
    docs = documents(spark, [(i, "some text", None, None) for i in range(5)])
    assert {(r["lang_pred"], r["score"]) for r in records(identify(docs))} == {("und", 0.0)}


def test_mixture_of_two_languages(spark):
    rows = [(r["text"], r["lang"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang IN ('en','de')").collect()]
    en, de = ([t for t, g in rows if g == x and len(t) > 1000] for x in ("en", "de"))
    train = documents(spark, [(i, t, "en", None) for i, t in enumerate(en[5:])] + [(i, t, "de", None) for i, t in enumerate(de[5:])])
    languages, probs = learn(train)
    test = documents(spark, [(1, en[0][:1000], None, None), (2, de[0][:1000], None, None), (3, en[1][:700] + " " + de[1][:300], None, None)])
    found = {r["doc_id"]: r for r in records(predict(test, languages, probs))}
    assert (found[1]["lang_pred"], found[1]["n_languages"], found[2]["lang_pred"], found[2]["n_languages"]) == ("en", 1, "de", 1)
    assert found[3]["lang_pred"] == "en" and found[3]["n_languages"] == 2 and found[3]["score"] == pytest.approx(0.7, abs=0.1)


def test_inference_against_plain_loops():
    rng = np.random.default_rng(5)
    probs = rng.dirichlet(np.full(BUCKETS, 0.1), 3)
    probs = (probs + 1e-6) / (probs + 1e-6).sum(axis=1, keepdims=True)
    truth = np.array([[1, 0, 0], [0.5, 0.5, 0], [0.2, 0.2, 0.6]])
    counts = np.stack([rng.multinomial(3000, t @ probs) for t in truth]).astype(np.float32)
    mix = _expect(counts, probs, np.full((3, 3), 1 / 3), 50)
    for i in range(3):
        pi = np.full(3, 1 / 3)
        for _ in range(50):
            share = pi[:, None] * probs
            share /= share.sum(axis=0)
            pi = (share * counts[i]).sum(axis=1) / counts[i].sum()
        assert mix[i] == pytest.approx(pi, abs=1e-4)
    assert mix == pytest.approx(truth, abs=0.05)
    assert _fit(counts, probs, mix)[1] > max(counts[1] @ np.log(p) for p in probs)
    language, score, size = infer(counts, probs)
    assert language.tolist()[0::2] == [0, 2] and size.tolist() == [1, 2, 3] and ((score >= 0) & (score <= 1)).all()


def test_texts_in_many_languages_have_all_of_them():
    rng = np.random.default_rng(6)
    probs = rng.dirichlet(np.full(BUCKETS, 0.1), 6)
    probs = (probs + 1e-6) / (probs + 1e-6).sum(axis=1, keepdims=True)
    truth = [[0.25, 0.2, 0.3, 0.25, 0, 0], [0.1, 0.1, 0.2, 0.2, 0.3, 0.1], [0, 0, 0, 0, 0.5, 0.5], [0, 1, 0, 0, 0, 0]]
    counts = np.stack([rng.multinomial(4000, np.array(t) @ probs) for t in truth]).astype(np.float32)
    language, score, size = infer(counts, probs)
    assert size.tolist() == [4, 6, 2, 1] and language.tolist()[0::3] == [2, 1] and language[1] == 4
    assert score[:2] == pytest.approx([0.3, 0.3], abs=0.05)


def test_unlabelled_documents_with_a_letter_stay(spark):
    texts = ["some text", "12 + 3", None, "", "ü"]
    docs = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    kept = readable_documents(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 4]


def test_the_stage_drops_what_no_mixture_explains(spark):
    rng = random.Random(7)
    words = "the house of that river and some other small town with water under its old bridge".split()
    rows = [(i, " ".join(rng.choices(words, k=80)), "en", "a") for i in range(60)]
    foreign = "".join(chr(rng.randrange(0x3B1, 0x3C9)) if rng.random() > 0.2 else " " for _ in range(2000))
    rows += [(100, foreign, None, "a"), (101, "the house", None, "a"), (102, "1 2 3 !", "en", "a"), (103, None, "en", "a")]
    rows += [(104, foreign + " " + " ".join(rng.choices(words, k=4000)), None, None)]
    kept = {r["doc_id"]: r for r in readable_documents(documents(spark, rows)).collect()}
    # A short text stays, as does one that is mostly in a known language.
    assert set(kept) == {*range(60), 101, 104}
    assert all(kept[i]["text"] == t and kept[i]["source"] == s for i, t, _, s in rows if i in kept)


def test_whole_rows_are_filtered_in_little_memory():
    """Beside waiting rows, 1000 short texts at a time took arrays of 16 and 32 MB in every worker."""
    texts = pa.array([f"some short text number {i}" if i % 3 else "\u4e2d\u6587" * 40 for i in range(1500)])
    drawn = np.random.default_rng(1).random((6, BUCKETS))
    probs = drawn / drawn.sum(axis=1, keepdims=True)
    tracemalloc.start()
    found = explained(texts, probs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 << 20
    alone = np.concatenate([explained(texts.slice(i, 1), probs) for i in range(len(texts))])
    assert found.tolist() == alone.tolist() and len(explained(texts.slice(0, 0), probs)) == 0
