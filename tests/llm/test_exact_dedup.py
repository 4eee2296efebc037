import hashlib
import re
from collections import defaultdict

from llm_rows import MESSY, messy, nothing, records  # noqa: F401
from pyspark.sql import functions as F

from sparkrecon.llm.exact_dedup import distinct_documents, exact_dedup, may_repeat, repeat_filter

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def _expected(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        groups[hashlib.sha256(text.encode()).hexdigest()].append(i)
    return {
        h: (min((i for i in ids if i is not None), default=None), len(ids), sorted(map(str, ids))) for h, ids in groups.items()
    }


def _check(found, rows):
    groups = defaultdict(list)
    for r in found:
        groups[r["text_sha256"]].append(r)
    got = {}
    for h, members in groups.items():
        assert len({(m["keep_id"], m["group_size"]) for m in members}) == 1
        kept = [m for m in members if m["kept"]]
        assert len(kept) == 1 and kept[0]["doc_id"] == members[0]["keep_id"]
        got[h] = (members[0]["keep_id"], members[0]["group_size"], sorted(str(m["doc_id"]) for m in members))
    assert got == _expected(rows)


def test_messy_rows(messy):
    found = exact_dedup(messy)
    assert found.columns == COLUMNS
    _check(records(found), MESSY)


def test_a_full_filter_changes_nothing(messy):
    _check(records(exact_dedup(messy, max_cells=1)), MESSY)


def test_distinct_documents_keeps_all_columns(messy, nothing):
    found = distinct_documents(messy)
    assert found.columns == messy.columns
    assert sorted(str(r["doc_id"]) for r in found.collect()) == sorted(map(str, [3, 9, None, 1, 4, 5, 6, 8, -5]))
    assert distinct_documents(nothing).count() == 0 and exact_dedup(nothing).count() == 0


def test_many_copies_of_one_text(spark):
    rows = spark.range(0, 6000, 1, 5).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot text").otherwise(F.concat(F.lit("t"), "id")).alias("text")
    )
    found = exact_dedup(rows)
    assert found.filter("kept").count() == 4001
    assert found.filter("group_size = 2000 AND keep_id = 0").count() == 2000


def test_filter_has_no_misses(spark):
    hashes = spark.range(20_000).select(F.xxhash64(F.col("id") % 15_000).alias("h"))
    probe = may_repeat(*repeat_filter(hashes, 20_000), spark)
    flagged = hashes.select("h", probe("h").alias("again"))
    twice = hashes.groupBy("h").count().filter("count > 1").select("h")
    assert flagged.filter("NOT again").join(twice, "h").count() == 0
    assert flagged.filter("again").count() < 10_000 + 500
