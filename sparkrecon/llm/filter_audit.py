"""Filter interaction audit: what each filter of a chain removes, in every order of the chain.

Every document gets a bit per filter that it fails. Whether a text repeats one of a smaller id is found
by an existential self-join: documents left-semi joined with the first holder of each text, on the hash
of the text, the exact text and a smaller id. The failing ids of that join are united with those of the
other filters, and one aggregation makes them bit combinations: at most 2^filters per part, whatever
the number of documents. All that orders can ask follows from the combinations: a filter removes, after
the filters ``before`` it, the documents that fail it and none of those.

Scale: one scan for the filters that look at a text alone; later scans drop the texts whose hash is
surely met once (a Bloom filter of bounded size; beyond some 8 million rows it lets more of them through,
which costs their shuffle and changes nothing), so that few whole texts are shuffled. The other side of
the join holds a text once, so a text with a third of all rows is hot on the left side only, which AQE
splits, since the other side is a table.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written
from .common import WORD, text_or_empty
from .exact_dedup import may_repeat, repeat_filter

# The filter that is found by the self-join. Others are conditions on the text.
COPY = "E"
# All orders are reported, so their number grows with the factorial of the number of filters.
MOST_FILTERS = 6


def default_filters(text: Column) -> dict[str, Column]:
    """Conditions under which a text fails: too short, repetitive, shouting, special characters."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def _copies(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, sha, part) of the documents whose text a smaller id holds too."""
    twice, cells = repeat_filter(rows.select(F.xxhash64("sha")), rows.count())
    probe = may_repeat(twice, cells, docs.sparkSession)
    texts = docs.filter(probe(F.xxhash64("sha")))
    of_text = texts.groupBy("sha", "text").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    first = written(of_text.filter("n > 1").drop("n"), "audit-first")
    a, b = texts.alias("a"), first.alias("b")
    on = (F.col("a.sha") == F.col("b.sha")) & (F.col("a.text") == F.col("b.text"))
    found = a.join(b, on & (F.col("b.first_id") < F.col("a.doc_id")), "left_semi")
    return found.select("doc_id", "sha", "part")


def combinations(
    docs: DataFrame,
    labels: DataFrame,
    filters=default_filters,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """One row per part and combination of failed filters that occurs: part, bits, n, good, toxic.

    Bit i of ``bits`` stands for the i-th name of ``filters`` in order, the last bit for the copies.
    A null text counts as empty, a null part as an empty string. A null id is neither a smaller id nor
    has one; rows that repeat an id and a text are documents of their own and no copies of each other.
    Labels are those of the id: good or toxic if any of its label rows says so. No documents give no
    rows. Other columns are not read.
    """
    conditions = filters(F.col("text"))
    named = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        text_or_empty(text_col).alias("text"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
    ).withColumn("sha", F.unhex(F.sha2("text", 256)))
    bits = sum(
        (F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(conditions.values())), F.lit(0)
    )
    rows = written(named.select("doc_id", "sha", "part", bits.cast("int").alias("bits")), "audit-rows")
    own = rows.withColumn("n", F.lit(1))
    copies = _copies(rows, named).select(
        "doc_id", "sha", "part", F.lit(1 << len(conditions)).alias("bits"), F.lit(0).alias("n")
    )
    failed = own.unionByName(copies).groupBy("doc_id", "sha", "part").agg(
        F.bit_or("bits").alias("bits"), F.sum("n").alias("n")
    )
    # A label matters only where a document is removed and an id is known.
    marked = labels.groupBy(F.col(id_col).cast("long").alias("label_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    joined = failed.join(marked, F.col("doc_id") == F.col("label_id"), "left")
    return joined.groupBy("part", "bits").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def _steps(names: list[str]) -> Column:
    """Every step of every order: its filter's bit and the bits of the filters before it. One literal."""
    bit = {name: 1 << i for i, name in enumerate(names)}
    steps = []
    for order in permutations(names):
        before = 0
        for step, name in enumerate(order, start=1):
            steps.append({"filter_order": "".join(order), "step": step, "before": before, "own": bit[name]})
            before |= bit[name]
    return F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, before int, own int>>")


def audit(
    docs: DataFrame,
    labels: DataFrame,
    filters=default_filters,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost and shapley, zeros included. Names of filters have one character each.

    ``shapley`` is the number that the step's filter removes, summed over all orders. What happens to
    nulls, repeated rows and empty tables is said at ``combinations``.
    """
    names = [*filters(F.col("text")), COPY]
    if len(names) > MOST_FILTERS:
        raise ValueError(f"{len(names)} filters have too many orders; at most {MOST_FILTERS} are audited")
    found = written(combinations(docs, labels, filters, id_col, text_col, part_col), "audit-combinations")
    at = found.select("*", F.inline(_steps(names)))
    bits, before, own = F.col("bits"), F.col("before"), F.col("own")
    fails, gone = bits.bitwiseAND(own) != 0, bits.bitwiseAND(before) != 0

    def total(condition: Column, value: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(value)).otherwise(0)).cast("long")

    # Of all orders a document is removed by each of the filters that it fails equally often.
    orders = 1
    for i in range(2, len(names) + 1):
        orders *= i
    return at.groupBy("part", "filter_order", "step").agg(
        total(~gone & ~fails).alias("kept"),
        total(~gone & fails).alias("removed"),
        total(gone & fails).alias("redundant"),
        total(bits == own).alias("unique_fails"),
        total(~gone & fails, "good").alias("good_lost"),
        total(~gone & fails, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, F.expr(f"n * {orders} div greatest(bit_count(bits), 1)")).otherwise(0)).alias("shapley"),
    )


_ORDERS = ", ".join(f"'{''.join(p)}'" for p in permutations("ABCDE"))

ORACLE = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), judged AS (
  SELECT part,
    concat(CASE WHEN len(words) < 100 THEN 'A' END,
      CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' END,
      CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
      CASE WHEN EXISTS (SELECT 1 FROM texts o WHERE o.t = d.t AND o.doc_id < d.doc_id) THEN 'E' END) AS failed,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1) AS good,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1) AS bad
  FROM texts d
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS earlier
  FROM (SELECT unnest([{_ORDERS}]) AS filter_order), (SELECT unnest(range(1, 6)) AS step)
), seen AS (
  SELECT part, filter_order, CAST(step AS INT) AS step, own, good, bad, failed = own AS alone,
    contains(failed, own) AS fails,
    length(translate(failed, earlier, '')) < length(failed) AS gone
  FROM judged, steps
), told AS (
  SELECT part, filter_order, step, own, count(*) FILTER (NOT gone AND NOT fails) AS kept,
    count(*) FILTER (NOT gone AND fails) AS removed, count(*) FILTER (gone AND fails) AS redundant,
    count(*) FILTER (alone) AS unique_fails, count(*) FILTER (NOT gone AND fails AND good) AS good_lost,
    count(*) FILTER (NOT gone AND fails AND bad) AS toxic_lost
  FROM seen GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM told
"""
