"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

A tree cuts the vectors of a bounded sample in two, over and over, by the plane halfway between two
centres that grow out of two random vectors; every vector of the table is then indexed, in one leaf per
tree. A query walks all trees at once through one shared priority queue: of all parts of all trees the
one least far beyond its planes comes next, until the leaves reached hold enough vectors. Those are
ranked by the inner product itself. Largest inner product becomes smallest distance by one more
coordinate, which gives all vectors the same length and is 0 for queries.

How many vectors are enough depends on the data, so it is measured: a bounded sample of the queries is
answered by comparing it with every vector, and the search goes as far as the wanted share of those
neighbours needs. Vectors without structure need a large part of the table, clustered ones little.

Scale: trees are fitted on the driver from at most ``SAMPLE_NUMBERS`` numbers of each number of dimensions;
what it learns of the table is one count per leaf, at most the sample's rows / ``LEAST`` of them per tree.
Equal vectors are one class, so copies cannot fill a leaf. Queries are held in blocks of about ``ASKING``,
those of near leaves together; a task holds one block and the vectors of the leaves that it visits (a
``GROUPS``-th of them) go by, leaf after leaf. What it returns is the best of each query over all these
leaves, ``GROUPS`` times ``k`` + 1 rows of a query however many leaves it visits. With more vectors than the sample's rows / ``LEAST`` * ``LEAF`` (8 million at
64 dimensions) leaves grow, not their number.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import written
from .words import mixed

NEAREST = 20
TREES = 4
# Numbers to fit the trees on, most vectors of them, vectors per leaf, least number of sampled ones per leaf.
SAMPLE_NUMBERS, SAMPLE, LEAF, LEAST = 1 << 22, 65_536, 1_024, 8
# Queries that are answered in full to see how far the search has to go, and the share of their
# neighbours that it has to find.
TRIED, RECALL = 256, 0.95
BLOCK = 2_048
# Queries of a task, about, and tasks that share the leaves of such a block.
ASKING, GROUPS = 4_096, 8
# Products of blocks are off by less than this share of the lengths; what is nearer than that is kept.
NEAR = 1e-9
# Sampled vectors that a plane is fitted to, rounds of that, and the least share on either side.
SEEN, ROUNDS, EVEN = 512, 4, 0.05


class Forest:
    """Trees in flat arrays. ``kids`` of a node are nodes, or leaves as -1 - leaf; leaves are numbered
    through all trees."""

    def __init__(self, sample: np.ndarray, trees: int, leaf: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.roots, self.leaves = [], 0
        normals, cuts, kids = [], [], []

        def split(at: np.ndarray):
            """A plane that parts the sampled vectors, evenly if it can; None if they are few or all alike."""
            if len(at) <= leaf:
                return None
            for last in (False, False, True):
                some = sample[at if len(at) <= SEEN else rng.choice(at, SEEN, replace=False)]
                a, b = some[rng.choice(len(some), 2, replace=False)]
                for _ in range(ROUNDS):
                    nearer = ((some - a) ** 2).sum(axis=1) < ((some - b) ** 2).sum(axis=1)
                    if nearer.all() or not nearer.any():
                        break
                    a, b = some[nearer].mean(axis=0), some[~nearer].mean(axis=0)
                length = np.linalg.norm(a - b)
                if length == 0:
                    continue
                normal = (a - b) / length
                along = sample[at] @ normal
                cut = np.median(along) if last else (a + b) @ normal / 2
                right = along >= cut
                if min(right.sum(), (~right).sum()) > (0 if last else EVEN * len(at)):
                    return normal, cut, at[~right], at[right]
            return None

        for _ in range(trees):
            waiting = [(np.arange(len(sample)), None)]
            while waiting:
                at, parent = waiting.pop()
                found = split(at)
                if found is None:
                    here = -1 - self.leaves
                    self.leaves += 1
                else:
                    here = len(normals)
                    normals.append(found[0])
                    cuts.append(found[1])
                    kids.append([0, 0])
                    waiting += [(found[2], (here, 0)), (found[3], (here, 1))]
                if parent is None:
                    self.roots.append(here)
                else:
                    kids[parent[0]][parent[1]] = here
        self.normals = np.array(normals).reshape(-1, sample.shape[1])
        self.cuts, self.kids = np.array(cuts), np.array(kids, np.int64).reshape(-1, 2)

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row in every tree, one column per tree."""
        out = np.empty((len(x), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root)
            while (moving := np.flatnonzero(at >= 0)).size:
                node = at[moving]
                beyond = np.einsum("ij,ij->i", x[moving], self.normals[node]) >= self.cuts[node]
                at[moving] = self.kids[node, beyond.astype(int)]
            out[:, t] = -1 - at
        return out

    def search(self, queries: np.ndarray, sizes: np.ndarray, enough: float) -> list[list[int]]:
        """Leaves for every query, nearest first, until they hold ``enough`` vectors, counted per tree."""
        kids, out, held = self.kids.tolist(), [], sizes.tolist()
        for query in queries:
            margins = (self.normals @ query - self.cuts).tolist()
            # How far a part is: the squares of the distances to the planes that lie between, added up.
            queue = [(0.0, root) for root in self.roots]
            heapq.heapify(queue)
            found, count = [], 0
            while queue and count < enough:
                far, node = heapq.heappop(queue)
                if node < 0:
                    if held[-1 - node]:
                        found.append(-1 - node)
                        count += held[-1 - node]
                    continue
                square, right = margins[node] ** 2, margins[node] >= 0
                heapq.heappush(queue, (far, kids[node][right]))
                heapq.heappush(queue, (far + square, kids[node][not right]))
            out.append(found)
        return out


def lengthened(x: np.ndarray, scale: float, longest: float) -> np.ndarray:
    """Vectors with the coordinate that makes them all ``longest``, in units of ``scale``."""
    x = x / scale
    rest = np.maximum(longest**2 - (x * x).sum(axis=1), 0)
    return np.column_stack([x, np.sqrt(rest)])


def best(q: np.ndarray, x: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``q``, row of ``x``, inner product) of the ``k`` largest products of every row of ``q``;
    ties go to the smaller ``first``. Products of blocks only choose what is computed one by one."""
    rough = q @ x.T
    if x.shape[0] > k:
        least = np.partition(rough, x.shape[0] - k, axis=1)[:, x.shape[0] - k]
    else:
        least = rough.min(axis=1)
    slack = NEAR * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
    i, j = np.nonzero(rough >= (least - slack)[:, None])
    score = (q[i] * x[j]).sum(axis=1)
    order = np.lexsort((first[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    return i[rank < k], j[rank < k], score[rank < k]


def _classes(vectors: DataFrame, id_col: str, vector_col: str, is_query: Column, k: int):
    """(rows with their class, classes, the ``k + 1`` smallest ids of each class)."""
    single = vectors.schema[vector_col].dataType == T.ArrayType(T.FloatType())
    v = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), is_query.alias("asks"), v.alias("v"))
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("v", lambda x: x != 0)
    usable = F.coalesce(finite & some, F.lit(False))
    key = F.sha2(F.concat_ws(",", F.transform("v", lambda x: x.cast("string"))), 256)
    rows = written(rows.filter(usable).withColumn("key", key), "neighbour-rows")
    found = rows.groupBy("key").agg(
        F.min("v").alias("v"), F.min("vec_id").alias("first_id"), F.max(F.coalesce("asks", F.lit(False))).alias("asks")
    )
    classes = written(
        found.select("*", F.size("v").alias("d"), F.monotonically_increasing_id().alias("cls")), "neighbour-classes"
    )
    # No one can have more of a class among the nearest; the limit is applied before the shuffle.
    smallest = Window.partitionBy("key").orderBy(F.asc_nulls_last("vec_id"))
    members = rows.withColumn("at", F.row_number().over(smallest)).filter(F.col("at") <= k + 1)
    # Rows alike in id and vector are numbered, so that a query can leave out one of them: itself.
    alike = Window.partitionBy("key", "vec_id").orderBy("at")
    return rows, classes, members.select("key", "vec_id", F.row_number().over(alike).alias("copy"))


def _forests(classes: DataFrame, trees: int, leaf: int) -> dict[int, tuple[Forest, float, float]]:
    """Per number of dimensions: the trees, and scale and greatest length of its vectors."""
    found = {}
    top = F.array_max(F.transform("v", lambda x: F.abs(x))).cast("double")
    for d, n, scale in classes.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.max(top).alias("scale")).collect():
        of_width = classes.filter(F.col("d") == d)
        squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / scale) * (x / scale))
        longest = float(np.sqrt(of_width.agg(F.max(squares)).first()[0]))
        most = max(1, min(SAMPLE, SAMPLE_NUMBERS // d))
        sample = of_width.orderBy(F.xxhash64("key"), "key").limit(most).select("v").collect()
        x = lengthened(np.array([r[0] for r in sample], np.float64), scale, longest)
        found[d] = Forest(x, trees, max(LEAST, leaf * len(x) // n)), scale, longest
    return found


def _directions(x: np.ndarray, scale: float, longest: float) -> np.ndarray:
    """Queries as the trees see them: of the vectors' length, without the added coordinate."""
    x = np.column_stack([x / scale, np.zeros(len(x))])
    return x * (longest / np.linalg.norm(x, axis=1, keepdims=True))


def _reach(indexed: DataFrame, d: int, forest: tuple[Forest, float, float], sizes: np.ndarray, k: int, recall: float) -> float:
    """Vectors that a search has to reach so that the share ``recall`` of a sample's neighbours is found."""
    asked = indexed.filter("asks").filter(F.col("d") == d).orderBy(F.xxhash64("key"), "key").limit(TRIED)
    asked = asked.select("cls", "v").collect()
    if not asked:
        return 0
    own = np.array([r[0] for r in asked])
    q = np.array([r[1] for r in asked], np.float64)

    def compare(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), BLOCK):
                held = part.iloc[at : at + BLOCK]
                cls = held["cls"].to_numpy()
                i, j, score = best(q, np.array(held["v"].tolist(), np.float64), cls, k + 1)
                other = own[i] != cls[j]
                yield pd.DataFrame({"q": i, "score": score, "leaf": held["leaf"].to_numpy()[j]})[other]

    top = Window.partitionBy("q").orderBy(F.desc("score"))
    met = indexed.filter(F.col("d") == d).select("cls", "v", "leaf").mapInPandas(compare, "q int, score double, leaf array<long>")
    met = met.withColumn("at", F.row_number().over(top)).filter(F.col("at") <= k)
    needed, ways = [], {}
    for i, leaves in met.select("q", "leaf").collect():  # k rows for each query of the sample
        if i not in ways:
            way = forest[0].search(_directions(q[i : i + 1], *forest[1:]), sizes, np.inf)[0]
            reached = np.cumsum(sizes[way])
            ways[i] = np.zeros(len(sizes), np.int64)
            ways[i][way] = reached
        needed.append(ways[i][leaves].min())
    return float(np.quantile(needed, recall, method="higher")) if needed else 0


def _by_width(part: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame, np.ndarray]]:
    for d, group in part.groupby("d"):
        yield int(d), group, np.array(group["v"].tolist(), np.float64)


class Asking:
    """The queries of a task, the leaves they visit, and the best vectors met so far."""

    def __init__(self, part: pd.DataFrame, k: int):
        self.q, self.x = part["id"].to_numpy(), np.stack(part["v"].to_numpy()).astype(np.float64)
        leaves = part["leaves"].to_numpy()
        row, leaf = np.repeat(np.arange(len(part)), [len(x) for x in leaves]), np.concatenate(leaves)
        order = np.argsort(leaf, kind="stable")
        self.row, self.leaf = row[order], leaf[order]
        self.score = np.full((len(part), k), -np.inf)
        self.cls, self.first = np.full((len(part), k), -1, np.int64), np.full((len(part), k), np.inf)

    def meet(self, leaf: int, x: np.ndarray, cls: np.ndarray, first: np.ndarray) -> None:
        rows = self.row[slice(*np.searchsorted(self.leaf, [leaf, leaf + 1]))]
        k = self.score.shape[1]
        for at in range(0, len(rows), BLOCK):
            some = rows[at : at + BLOCK]
            i, j, score = best(self.x[some], x, first, k)
            i = some[i]
            chosen = score >= self.score[i, -1]
            if not chosen.any():
                continue
            i, j, score = i[chosen], j[chosen], score[chosen]
            touched = np.unique(i)
            # What is known and what is new, best first; a class is met once per tree that leads to it.
            i, score = np.concatenate([np.repeat(touched, k), i]), np.concatenate([self.score[touched].ravel(), score])
            c, f = np.concatenate([self.cls[touched].ravel(), cls[j]]), np.concatenate([self.first[touched].ravel(), first[j]])
            order = np.lexsort((c, f, -score, i))
            i, score, c, f = i[order], score[order], c[order], f[order]
            once = np.append(True, (i[1:] != i[:-1]) | (c[1:] != c[:-1]) | (c[1:] < 0))
            i, score, c, f = i[once], score[once], c[once], f[once]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            i, rank, score, c, f = (a[rank < k] for a in (i, rank, score, c, f))
            self.score[i, rank], self.cls[i, rank], self.first[i, rank] = score, c, f

    def found(self) -> pd.DataFrame:
        i, at = np.nonzero(self.cls >= 0)
        return pd.DataFrame({"q": self.q[i], "cls": self.cls[i, at], "score": self.score[i, at]})


def _ranked(k: int):
    """Rows of cells one after the other, of each its queries (leaf -1), then its vectors leaf by leaf, to
    the ``k`` best of every query of a cell: q, cls, score."""

    def ranked(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, asking, waiting = None, None, []
        for part in parts:
            for (*here, leaf), run in part.groupby(["d", "q_block", "grp", "leaf"], sort=True):
                if here != cell:
                    if asking is not None:
                        yield asking.found()
                    cell, asking, waiting = here, None, []
                if leaf < 0:
                    waiting.append(run)
                    continue
                if asking is None:
                    asking, waiting = Asking(pd.concat(waiting), k), []
                for at in range(0, len(run), BLOCK):
                    some = run.iloc[at : at + BLOCK]
                    first = some["first_id"].astype("Float64").fillna(np.inf).to_numpy(np.float64)
                    asking.meet(leaf, np.stack(some["v"].to_numpy()).astype(np.float64), some["id"].to_numpy(), first)
        if asking is not None:
            yield asking.found()

    return ranked


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = NEAREST,
    trees: int = TREES,
    leaf: int = LEAF,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """For each row where ``is_query`` holds its ``k`` nearest found: query_id, rank, vec_id, score.

    Candidates are all rows but the query's own. Vectors that are null, empty or zero, or hold a null or
    a number that is not finite, take no part, and vectors are compared with those of their own number
    of dimensions only. Ties go to the smaller id, a null id comes last. Rows alike in id and vector are
    one query, for which all but one of them are candidates; an id with several vectors is a query per
    vector. A query that finds no other row has no rows, nor has an empty table. Other columns are not
    read.
    """
    rows, classes, members = _classes(vectors, id_col, vector_col, is_query, k)
    forests = _forests(classes, trees, leaf)

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for d, group, x in _by_width(part):
                forest, scale, longest = forests[d]
                yield group.assign(leaf=forest.place(lengthened(x, scale, longest)).tolist())

    # A struct type takes new fields into the list that it was made of, so the list is a new one.
    leaf_field = T.StructField("leaf", T.ArrayType(T.LongType()))
    schema = T.StructType([*classes.schema.fields, leaf_field])
    indexed = written(classes.mapInPandas(place, schema), "neighbour-index")
    sizes = indexed.select("d", F.explode("leaf").alias("leaf")).groupBy("d", "leaf").agg(F.count(F.lit(1)).alias("n"))
    sizes = written(sizes, "neighbour-leaves")
    counts = {d: np.zeros(f[0].leaves, np.int64) for d, f in forests.items()}
    for d, at, n in sizes.collect():
        counts[d][at] = n
    enough = {d: max(k + 1, _reach(indexed, d, f, counts[d], k, recall)) for d, f in forests.items()}

    # Queries in the order of their leaves in the first tree, so that those of a block visit much the same.
    homes = indexed.filter("asks").groupBy("d", F.get("leaf", F.lit(0)).alias("leaf")).agg(F.count(F.lit(1)).alias("n"))
    here = {d: np.zeros(f[0].leaves, np.int64) for d, f in forests.items()}
    for d, at, n in homes.collect():
        here[d][at] = n
    before = {d: np.cumsum(n) - n for d, n in here.items()}

    def visit(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for d, group, x in _by_width(part):
                forest, scale, longest = forests[d]
                home = group["leaf"].str[0].to_numpy(np.int64)
                drawn = mixed(group["q"].to_numpy().astype(np.uint64)) % here[d][home].astype(np.uint64)
                block = (before[d][home] + drawn.astype(np.int64)) // ASKING
                yield group.assign(leaf=forest.search(_directions(x, scale, longest), counts[d], enough[d]), q_block=block)

    asking = indexed.filter("asks").select("d", F.col("cls").alias("q"), "v", "leaf")
    schema = T.StructType([*asking.schema.fields, T.StructField("q_block", T.LongType())])
    visits = written(asking.mapInPandas(visit, schema), "neighbour-visits")

    def reached(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for (d, block), group in part.groupby(["d", "q_block"]):
                yield pd.DataFrame({"leaf": np.unique(np.concatenate(group["leaf"].to_numpy()))}).assign(d=d, q_block=block)

    grid = visits.select("d", "q_block", "leaf").mapInPandas(reached, "leaf long, d int, q_block long").distinct()
    grid = written(grid, "neighbour-grid")
    held = indexed.select("d", "cls", "first_id", "v", F.explode("leaf").alias("leaf")).join(grid, ["d", "leaf"])
    cell = ["d", "q_block", "grp"]
    passing = held.select(
        "d", "q_block", (F.col("leaf") % GROUPS).alias("grp"), "leaf", F.col("cls").alias("id"), "first_id", "v",
        F.lit(None).cast("array<long>").alias("leaves"),
    )
    waiting = visits.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1)).cast("array<long>"))).select(
        *cell, F.lit(-1).cast("long").alias("leaf"), F.col("q").alias("id"), F.lit(None).cast("long").alias("first_id"), "v",
        F.filter("leaf", lambda x: x % GROUPS == F.col("grp")).alias("leaves"),
    )
    dealt = passing.unionByName(waiting).repartition(*cell).sortWithinPartitions(*cell, "leaf")
    met = dealt.mapInPandas(_ranked(k + 1), "q long, cls long, score double")
    # A class is met once per tree that leads to it. The k + 1 best classes hold the k + 1 best ids.
    met = met.groupBy("q", "cls").agg(F.max("score").alias("score"))
    ids = members.join(classes.select("key", "cls"), "key").select("cls", "vec_id", "copy")
    # Ids are looked up only for classes that can be among them, all of equal score included.
    by_score = Window.partitionBy("q").orderBy(F.desc("score"))
    met = met.withColumn("at", F.rank().over(by_score)).filter(F.col("at") <= k + 1)
    by_class = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("first_id"), "cls")
    met = met.join(classes.select("cls", "first_id"), "cls")
    met = met.withColumn("at", F.row_number().over(by_class)).filter(F.col("at") <= k + 1)
    by_id = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "copy")
    found = met.select("q", "cls", "score").join(ids, "cls")
    found = found.withColumn("at", F.row_number().over(by_id)).filter(F.col("at") <= k + 1)
    found = written(found.select("q", "cls", "vec_id", "copy", "score"), "neighbour-found")

    queries = rows.filter("asks").select(F.col("vec_id").alias("query_id"), "key").distinct()
    queries = queries.join(classes.select("key", F.col("cls").alias("q")), "key").select("query_id", "q")
    itself = (F.col("cls") == F.col("q")) & F.col("vec_id").eqNullSafe(F.col("query_id")) & (F.col("copy") == 1)
    of_query = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "copy")
    ranked = queries.join(found, "q").filter(~itself).withColumn("rank", F.row_number().over(of_query))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
