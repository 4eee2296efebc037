"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only.

Every document of a source is to be taken ``target / source_size`` times: its whole part surely, its
fraction by rounding. Two documents at a time exchange expected words: mass moves from one to the
other, in a random direction chosen so that both keep their expectation, until one fraction is 0 or
1; that document is done and the other goes on to the next pair. The expected words of the pair do
not change, so a source misses its target by half the size of one document at most.

Pairs are formed by a fold over small groups of a source. The one document that each group leaves
undecided goes up to the next level, where the same fold runs over those of ``FAN`` groups: a
reduction tree of which no task holds more than a group, however many documents a source has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written
from .common import WORD, text_or_empty, uniform

# Documents of a group on average, and the most that one fold takes.
FAN, MOST = 64, 256
WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2.0


def words(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """Per source: source_size, target. ``sized`` has source and size.

    The sources, by code point and null last, take the weights in turn; together they get ``share``
    of all words. A target stops at ``cap`` times its source's size and the excess is shared anew by
    weight until none is above. That ends where every source gets the smaller of its cap and
    ``level * weight``, so the level is found in one pass over the sources in the order of
    cap / weight, the order in which they stop. One row per source goes through these windows.
    """
    turn = F.array(*[F.lit(float(w)) for w in weights])
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    by_stop = Window.orderBy("stop", F.col("source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = Window.partitionBy()
    return (
        sizes.withColumn("weight", F.element_at(turn, ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int")))
        .withColumn("most", F.lit(float(cap)) * F.col("source_size"))
        .withColumn("stop", F.col("most") / F.col("weight"))
        .withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everyone))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(onward))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("stop"), F.struct("stop", "level"))).over(everyone)["level"])
        .withColumn("target", F.least("most", F.coalesce(F.col("level") * F.col("weight"), F.col("most"))))
        .select("source", "source_size", "docs", "target")
    )


def _step(state: Column, x: Column, seed: int) -> Column:
    """One pair: the document carried along and the next one. ``p`` is a fraction, ``size`` words."""
    a = state["carry"]
    up_a, up_x = (1 - a["p"]) * a["size"], (1 - x["p"]) * x["size"]
    down_a, down_x = a["p"] * a["size"], x["p"] * x["size"]
    up, down = F.least(up_a, down_x), F.least(down_a, up_x)
    rises = uniform(a["key"], x["key"], seed) * (up + down) < down

    def kept(doc: Column, p: Column) -> Column:
        return F.struct(doc["row_no"].alias("row_no"), doc["key"].alias("key"), doc["size"].alias("size"), p.alias("p"))

    def done(doc: Column, taken: int) -> Column:
        return F.struct(doc["row_no"].alias("row_no"), F.lit(taken).alias("more"))

    def either(make: str) -> Column:
        a_one, x_zero = up_a <= down_x, down_a <= up_x
        if make == "carry":
            return F.when(
                rises, F.when(a_one, kept(x, x["p"] - up_a / x["size"])).otherwise(kept(a, a["p"] + down_x / a["size"]))
            ).otherwise(
                F.when(x_zero, kept(x, x["p"] + down_a / x["size"])).otherwise(kept(a, a["p"] - up_x / a["size"]))
            )
        return F.when(rises, F.when(a_one, done(a, 1)).otherwise(done(x, 0))).otherwise(
            F.when(x_zero, done(a, 0)).otherwise(done(x, 1))
        )

    return F.struct(either("carry").alias("carry"), F.concat(state["done"], F.array(either("done"))).alias("done"))


def _fold(level: DataFrame, seed: int) -> DataFrame:
    """Each group of ``level`` (source, grp, row_no, key, size, p) to its decided documents and the
    one left over. A group is cut after ``MOST`` documents, so that rows repeated without end do not
    meet in one array."""
    order = Window.partitionBy("source", "grp").orderBy("key", "row_no")
    empty = F.array().cast("array<struct<row_no:bigint,more:int>>")
    fields = F.struct("key", "row_no", "size", "p")
    grouped = (
        level.withColumn("cut", F.floor((F.row_number().over(order) - 1) / MOST))
        .groupBy("source", "grp", "cut")
        .agg(F.sort_array(F.collect_list(fields)).alias("docs"))
    )
    first = F.element_at("docs", 1)
    start = F.struct(
        F.struct(first["row_no"].alias("row_no"), first["key"].alias("key"), first["size"].alias("size"), first["p"].alias("p")).alias("carry"),
        empty.alias("done"),
    )
    folded = F.aggregate(F.slice("docs", F.lit(2), F.size("docs")), start, lambda s, x: _step(s, x, seed))
    return grouped.select("source", "grp", folded.alias("end")).select(
        "source", "grp", F.col("end.carry").alias("carry"), F.col("end.done").alias("done")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = 7,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken.

    ``size`` counts the words of the text, ``copies`` is how often the mix takes the document and
    ``taken`` is copies times size. A null text has size 0; documents of size 0 change no total and
    get the whole part of their source's share. A null source is a source of its own, the last one.
    The draws depend on ids, sizes and ``seed`` only. Rows repeated with one id are rows of their
    own. An empty table gives no rows; other columns are not read.
    """
    sized = written(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), words(text_col).alias("size")
        ).withColumn("row_no", F.monotonically_increasing_id()),
        "mix-sizes",
    )
    targets = written(source_targets(sized, weights, share, cap), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = (
        sized.join(targets.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
        .withColumn("whole", F.floor(rate).cast("int"))
        .withColumn("p", rate - F.col("whole"))
    )
    key = F.xxhash64(F.col("doc_id").cast("string"), F.col("size"), F.lit(seed))
    groups = F.ceil(F.col("docs") / FAN)
    level = rated.filter((F.col("p") > 0) & (F.col("size") > 0)).select(
        "source", F.pmod(F.xxhash64(key, F.lit(1)), groups).alias("grp"), "row_no", key.alias("key"),
        F.col("size").cast("double").alias("size"), "p",
    )
    decided = []
    while True:
        folded = written(_fold(level, seed + len(decided)), "mix-level")
        decided.append(folded.select(F.explode("done").alias("d")).select("d.*"))
        counted = folded.agg(F.count(F.lit(1)), F.count_distinct(F.struct("source"))).first()
        level = folded.select("source", F.floor(F.col("grp") / FAN).alias("grp"), "carry.*")
        if counted[0] == counted[1]:
            break
    # One document of each source is still undecided: it goes to the nearer side, which keeps the
    # source within half of that document of its target.
    last = level.select("row_no", (F.col("p") >= 0.5).cast("int").alias("more"))
    for rows in decided:
        last = last.unionByName(rows)
    copies = F.col("whole") + F.coalesce(F.col("more"), F.lit(0))
    return rated.join(last.filter("more > 0"), "row_no", "left").select(
        "doc_id", "source", "size", "source_size", "target",
        copies.alias("copies"), (F.col("size") * copies).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it; a row not taken goes.

    Rows are told apart by id and number of words; those that share both share their copies, the
    first of them by row hash taking one more where they do not divide.
    """
    plan = (
        mix(docs, id_col, text_col, **options)
        .groupBy("doc_id", "size")
        .agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    )
    plan = written(plan.select(F.col("doc_id").alias("id"), F.col("size").alias("words"), "copies", "rows"), "mix-copies")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), words(text_col).alias("size"))
    met = rows.join(plan, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("size") == F.col("words")))
    single = met.filter("rows = 1").select("row", F.col("copies").cast("int").alias("times"))
    order = Window.partitionBy("doc_id", "size").orderBy(F.xxhash64("row"))
    shared = met.filter("rows > 1").withColumn("turn", F.row_number().over(order))
    several = shared.select(
        "row", (F.floor(F.col("copies") / F.col("rows")) + (F.col("turn") <= F.col("copies") % F.col("rows")).cast("int")).cast("int").alias("times")
    )
    taken = single.unionByName(several).filter("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
