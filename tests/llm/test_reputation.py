import duckdb
import pytest
from llm_rows import records

from sparkrecon.llm.reputation import ORACLE, host_reputation, judge

URLS = [
    (1, "http://WWW.Example.com/en/1?x#y", "h"), (2, "https://a.example.com/en/2", "h"), (3, "https://example.com", None),
    (4, "http://b.net/es/9", "h"), (5, "http://b.net/de/9", "h"), (6, None, "h"), (7, "no scheme", "h"), (8, "x://y://z/q", "h"),
    (9, "http://spam.org:8080/a", "h"), (9, "http://spam.org:8080/a", "h"), (None, "http://spam.org/b", "h"), (10, "", "h"),
    (11, "http://net/fr/1", "h"), (12, "http://notnet/fr/1", "h"), (13, "http://example.com?en/", "h"), (14, "ftp://1.2.3.4/p", "h"),
    (15, "http://x.co.uk/", "h"), (16, "http://y.x.co.uk/", "h"), (17, "http://good.org/", "h"),
] + [(100 + i, f"http://spam.org/{i}", "h") for i in range(40)] + [(200 + i, f"http://good.org/{i}", "h") for i in range(40)]
OUTCOMES = [(100 + i, True) for i in range(40)] + [(200 + i, False) for i in range(40)] + [
    (1, False), (2, True), (4, None), (None, True), (100, False), (5, True), (15, True), (16, False), (17, None),
]


def _frames(spark, urls=URLS, outcomes=OUTCOMES):
    pages = spark.createDataFrame([(*u, "v", "r") for u in urls], "page_id LONG, url STRING, html STRING, verdict STRING, rule STRING")
    return pages, spark.createDataFrame(outcomes, "page_id LONG, bad BOOLEAN")


def test_rules_and_reputation(spark):
    pages, outcomes = _frames(spark)
    found = {r["page_id"]: r for r in records(judge(pages, outcomes))}
    assert (found[1]["host"], found[1]["path"], found[1]["rule"], found[1]["verdict"]) == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert (found[2]["rule"], found[2]["verdict"]) == ("example.com/en/", "block")
    assert (found[3]["rule"], found[3]["path"]) == (None, "")
    assert (found[4]["rule"], found[5]["rule"], found[11]["rule"], found[12]["rule"]) == ("net/es/", None, "net/fr/", None)
    assert (found[6]["host"], found[7]["path"], found[8]["host"], found[8]["path"]) == ("", "", "y:", "//z/q")
    assert found[13]["rule"] is None and found[13]["path"] == ""
    assert found[100]["verdict"] == "block" and found[200]["verdict"] == "allow"
    # The host with a port has no outcome of its own and is judged by its registered domain.
    assert found[9]["host"] == "spam.org:8080" and found[9]["bad_rate"] > 0.5
    assert judge(pages, outcomes).count() == len(URLS)


def test_equals_sql(spark):
    """With what the rules decide as the only outcomes, as in the query."""
    more = URLS + [(300 + i, f"http://x.example.net/{g}/{i}", "h") for i, g in enumerate(["es", "fr", "en", "de"] * 9)]
    pages, _ = _frames(spark, more)
    con = duckdb.connect()
    con.register("pages", pages.toPandas().astype({"page_id": "Int64"}))
    want = sorted(map(str, con.execute(ORACLE).fetchall()))
    got = sorted(str(tuple(r)) for r in judge(pages).select("page_id", "host", "path", "rule", "verdict").collect())
    assert got == want
    # Pages without a rule follow the blocked ones of their host; a host nobody knows is allowed.
    found = {r["page_id"]: r for r in records(judge(pages))}
    assert found[302]["rule"] is None and found[302]["verdict"] == "block" and found[17]["verdict"] == "allow"


def test_shrinking(spark):
    """More evidence moves a host further from its prior; an unseen host has its domain's rate."""
    rows = [("a.x.org", True)] * 30 + [("b.x.org", True)] * 2 + [("c.x.org", None)] + [("y.com", False)] * 30
    rate = {r["host"]: r for r in records(host_reputation(spark.createDataFrame(rows, "host STRING, bad BOOLEAN")))}
    assert rate["a.x.org"]["bad_rate"] > rate["b.x.org"]["bad_rate"] > rate["y.com"]["bad_rate"]
    assert rate["a.x.org"]["bad_rate_low"] > rate["b.x.org"]["bad_rate_low"]
    assert rate["c.x.org"]["n"] == 0 and 0 < rate["c.x.org"]["bad_rate"] < 1


@pytest.mark.parametrize("urls, outcomes", [([], []), (URLS, []), ([], OUTCOMES)])
def test_empty_tables(spark, urls, outcomes):
    pages, given = _frames(spark, urls, outcomes)
    found = records(judge(pages, given))
    assert len(found) == len(urls)
    assert {r["verdict"] for r in found} <= {"allow", "block"}
