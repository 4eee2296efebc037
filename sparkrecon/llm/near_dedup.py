"""MinHash near-dedup with DartMinHash signatures.

A text is the weighted set of its runs of five words, the weight being how often a run occurs. Darts
fall on the plane of (weight, rank) of every element as a Poisson process that depends on hashes only,
so equal regions of different texts are hit by the same darts. Each dart has a coordinate; a text
keeps, per coordinate, the earliest dart below its weights. Darts are thrown up to a rank at which
every coordinate is expected to be hit, about k ln k + 2 k of them however large the text, and further
where one is missing. Two texts agree in a coordinate with probability equal to their weighted Jaccard
similarity.

Bands of coordinates are joined on their values. In a bucket every text is compared with one centre
only; components of what was linked are formed, and only buckets that still hold several components
are looked at again, with other centres. So a group of thousands of near copies costs about one
comparison per member and round. What is left are mostly texts that share a passage and are otherwise
different: of them the pairs across components are formed, each under the smallest key that its texts
share only. Pairs whose weights cannot give the similarity are left out, and so are those whose parities
differ in more bits than the runs of texts so alike can (a run that only one of two texts has flips one
bit), which loses nothing; sketches of the signatures (eight bits a coordinate) sort out long texts that
are far from similar. The others, hardly more than the links, are verified on the whole texts.

Equal texts are one class from the start: they are linked whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written
from .common import text_or_empty
from .components import components
from .exact_dedup import fingerprint, may_repeat, repeat_filter
from .tokens import slices
from .words import mixed, occurrences, shingles, word_hashes

WIDTH, LEAST = 5, 0.8
# A pair at 0.8 shares fewer than two bands with probability 1e-6, none with 5e-8.
ROWS, BANDS = 4, 32
# Rounds with one centre per bucket before the exhaustive one.
STAR_ROUNDS = 3
# Bits in which the sketches of a pair at 0.8 differ: 102 on average, more than 200 with a probability
# below 1e-6. A pair at 0.5 differs in 256 on average.
SKETCH, MOST_DIFFERENT = 16, 200
# Words of 64 bits of a text's parities.
PARITY = 16
# Bytes of text that are signed or verified together, and pieces of cells at which darts are thrown at a
# time: a short text has a thousand of them for each of its cells, so bytes alone do not bound them.
TOGETHER, THROWN = 256 << 10, 1 << 17

# What is known of a text without reading it again. A column for each word, as a join whose condition
# takes 32 words out of lists is too long for the compiler and ten times slower.
WORDS = {"parity": PARITY, "sketch": SKETCH}
PROFILE = ("weight", *[f"{name}{i}" for name, words in WORDS.items() for i in range(words)])

# Ranks are cut into pieces: [0, 1/16), [1/16, 1/8) .. [1/2, 1), [1, 2), [2, 3) and so on.
_STARTS = np.array([0, 1 / 16, 1 / 8, 1 / 4, 1 / 2])
_SIZES = np.array([1 / 16, 1 / 16, 1 / 8, 1 / 4, 1 / 2])
_MOST_DARTS = 16


def _poisson_steps(mean: float) -> np.ndarray:
    """Below which uniform numbers a piece of this mean holds 0, at most 1, .. darts."""
    terms, term = [], np.exp(-mean)
    for i in range(_MOST_DARTS):
        terms.append(term)
        term *= mean / (i + 1)
    return np.cumsum(terms)


_STEPS = np.array([_poisson_steps(m) for m in [*_SIZES, 1.0]])


def _piece_count(rank: np.ndarray) -> np.ndarray:
    """Pieces up to a power of two that is at least ``rank``."""
    power = np.ceil(np.log2(np.maximum(rank, 1 / 16)))
    return np.where(power <= 0, power + 5, 4 + 2.0 ** np.maximum(power, 0)).astype(np.int64)


def _uniform(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _throw(cells: np.ndarray, doc: np.ndarray, first: np.ndarray, upto: np.ndarray, best: np.ndarray) -> None:
    """Throw the darts of pieces ``first`` to ``upto`` (per text) at all cells; lower ``best`` in place."""
    part = np.cumsum((upto - first)[doc]) // THROWN
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(cells)], strict=True):
        _throw_at(cells[a:b], doc[a:b], first, upto, best)


def _throw_at(cells: np.ndarray, doc: np.ndarray, first: np.ndarray, upto: np.ndarray, best: np.ndarray) -> None:
    k = best.shape[1]
    times = (upto - first)[doc]
    cell = np.repeat(np.arange(len(cells)), times)
    piece = np.arange(len(cell)) - np.repeat(np.cumsum(times) - times, times) + first[doc][cell]
    seed = mixed(cells[cell] + (piece.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    kind = np.minimum(piece, 5)
    number = (_uniform(seed)[:, None] >= _STEPS[kind, :1]).ravel().astype(np.int64)
    hit = np.flatnonzero(number)
    number = (_uniform(seed[hit])[:, None] >= _STEPS[kind[hit]]).sum(axis=1)
    for dart in range(int(number.max(initial=0))):
        at = hit[number > dart]
        value = mixed(seed[at] ^ np.uint64((dart + 1) * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF))
        where = mixed(value)
        start = np.where(piece[at] < 5, _STARTS[np.minimum(piece[at], 4)], piece[at] - 4.0)
        size = np.where(piece[at] < 5, _SIZES[np.minimum(piece[at], 4)], 1.0)
        coordinate = (where % np.uint64(k)).astype(np.int64)
        np.minimum.at(best.reshape(-1), doc[cell[at]] * k + coordinate, start + size * _uniform(value))


def cells_of(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """One hash per cell of weight one. ``hashes`` are elements with repeats, ``doc`` their texts: an
    element of weight w occurs w times, and its region is w cells."""
    return mixed(hashes + occurrences(hashes, doc).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def signatures(hashes: np.ndarray, doc: np.ndarray, texts: int, k: int) -> np.ndarray:
    """texts x k ranks of the earliest darts; a text without an element has infinite ranks."""
    return earliest(cells_of(hashes, doc), doc, texts, k)


def earliest(cells: np.ndarray, doc: np.ndarray, texts: int, k: int) -> np.ndarray:
    """The signatures of texts with these cells."""
    weight = np.bincount(doc, minlength=texts)
    best = np.full((texts, k), np.inf)
    rank = (k * np.log(k) + 2 * k) / np.maximum(weight, 1)
    first, upto = np.zeros(texts, np.int64), _piece_count(rank)
    while len(cells):
        _throw(cells, doc, first, upto, best)
        short = (weight > 0) & np.isinf(best).any(axis=1)
        keep = short[doc]
        cells, doc = cells[keep], doc[keep]
        rank = rank * 2
        first, upto = upto, np.maximum(_piece_count(rank), upto)
    return best


def band_keys(best: np.ndarray, rows: int = ROWS, bands: int = BANDS) -> np.ndarray:
    """texts x bands hashes of the bands' values."""
    bits = best.view(np.uint64).reshape(len(best), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(best), bands)).copy()
    for i in range(rows):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, i])
    return key.view(np.int64)


def sketches(best: np.ndarray) -> np.ndarray:
    """texts x SKETCH words: eight bits of a hash of every coordinate's value."""
    return (mixed(best.view(np.uint64)) >> np.uint64(56)).astype(np.uint8).view(np.int64).reshape(len(best), SKETCH)


def parities(cells: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
    """texts x PARITY words: for each bit whether an odd number of the text's cells fall on it. Those of
    two texts differ in at most as many bits as there are cells that only one of the texts has."""
    bits = np.zeros(texts * PARITY * 64, np.uint8)
    at = doc.astype(np.int64) * (PARITY * 64) + (mixed(cells) % np.uint64(PARITY * 64)).astype(np.int64)
    np.bitwise_xor.at(bits, at, np.uint8(1))
    return np.packbits(bits).view(np.int64).reshape(texts, PARITY)


def _different(name: str) -> Column:
    """In how many bits the words of two texts differ."""
    different = F.lit(0)
    for i in range(WORDS[name]):
        different += F.bit_count(F.col(f"{name}{i}").bitwiseXOR(F.col(f"{name}{i}_b")))
    return different


def _alike(least: float) -> Column:
    """Whether the parities and sketches of two texts differ in few enough bits. Of texts with v and w
    runs, of which both have s, only one has d = v + w - 2 s; s / (s + d) is the similarity."""
    most = (F.col("weight") + F.col("weight_b")) * F.lit((1 - least) / (1 + least)) + F.lit(0.001)
    return (_different("parity") <= most) & (_different("sketch") <= MOST_DIFFERENT)


def _near_weights(least: float) -> Column:
    """Whether the numbers of runs of two texts allow the similarity: it is at most their quotient."""
    return F.least("weight", "weight_b") / F.greatest("weight", "weight_b") >= least


def weighted_shingles(text: pa.Array, width: int = WIDTH) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct runs, sorted, and how often each occurs."""
    found, doc = shingles(*word_hashes(text), width)
    bounds = np.searchsorted(doc, np.arange(len(text) + 1))
    return [np.unique(found[a:b], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity; 0 if either has no run."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    whole = int(a[1].sum() + b[1].sum()) - both
    return both / whole if whole else 0.0


def _lists(words: np.ndarray) -> pa.ListArray:
    ends = pa.array(np.arange(len(words) + 1) * words.shape[1], pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(words.ravel(), pa.int64()))


def _signed(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """One row per document, written: doc_id, sha, row_no, keys (none for a text without words), sketch,
    parity, weight (its number of runs)."""
    read = docs.select(F.col(id_col).alias("doc_id"), F.unhex(fingerprint(text_col)).alias("sha"), text_or_empty(text_col).alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", TOGETHER):
                found, doc = shingles(*word_hashes(part.column("text")), width)
                cells = cells_of(found, doc)
                best = earliest(cells, doc, part.num_rows, ROWS * BANDS)
                empty = np.isinf(best[:, 0])
                keys = band_keys(best)[~empty].ravel()
                ends = np.concatenate([[0], np.cumsum(np.where(empty, 0, BANDS))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys, pa.int64()))
                sketch, parity = (_lists(x) for x in (sketches(best), parities(cells, doc, part.num_rows)))
                weight = pa.array(np.bincount(doc, minlength=part.num_rows), pa.int64())
                yield pa.record_batch(
                    [part.column("doc_id"), part.column("sha"), lists, sketch, parity, weight],
                    names=["doc_id", "sha", "keys", "sketch", "parity", "weight"],
                )

    signed = read.mapInArrow(sign, f"doc_id {kind}, sha binary, keys array<long>, sketch array<long>, parity array<long>, weight long")
    return written(signed.withColumn("row_no", F.monotonically_increasing_id()), "near-signatures")


def _texts(docs: DataFrame, wanted: DataFrame, text_col: str) -> DataFrame:
    """cls, text of the wanted classes (cls, sha), written. A Bloom filter of the wanted texts keeps the
    others out of the shuffle; copies are reduced to one where they are read."""
    spark = docs.sparkSession
    hashes = wanted.select(F.xxhash64("sha"))
    probe = may_repeat(*repeat_filter(hashes, wanted.count(), least=1), spark)
    read = docs.select(F.unhex(fingerprint(text_col)).alias("sha"), text_or_empty(text_col).alias("text"))
    one = read.filter(probe(F.xxhash64("sha"))).groupBy("sha").agg(F.first("text").alias("text"))
    return written(one.join(wanted, "sha").select("cls", "text"), "near-texts")


def _verified(pairs: DataFrame, texts: DataFrame, least: float, width: int) -> DataFrame:
    """Which of the pairs (a, b) are linked: a, b, linked; written."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a", TOGETHER):
                b_ids = part.column("b").to_numpy()
                # A centre comes with all its partners: its text is taken apart once.
                centres, where = np.unique(b_ids, return_index=True)
                of = weighted_shingles(part.column("text_b").take(pa.array(where)), width)
                centre = dict(zip(centres.tolist(), of, strict=True))
                members = weighted_shingles(part.column("text_a"), width)
                linked = [similarity(m, centre[b]) >= least for m, b in zip(members, b_ids.tolist(), strict=True)]
                yield pa.record_batch([part.column("a"), part.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    first = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
    second = first.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
    return written(
        second.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a long, b long, linked boolean"), "near-verified"
    )


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]


def _star(buckets: DataFrame, profiles: DataFrame, turn: int, least: float) -> DataFrame:
    """Each member of a bucket with the bucket's centre, drawn by hash: a, b; larger class first."""
    drawn = F.xxhash64(F.col("cls"), F.col("key"), F.lit(turn))
    centre = F.min_by(F.struct("cls", "comp", "weight"), drawn).alias("centre")
    centres = written(buckets.groupBy("key").agg(centre).select("key", "centre.*").toDF("key", "cls_b", "comp_b", "weight_b"), "near-centres")
    met = buckets.join(centres, "key").filter((F.col("comp") != F.col("comp_b")) & _near_weights(least))
    pairs = met.select(*_ordered(F.col("cls"), F.col("cls_b"))).distinct()
    first = pairs.join(profiles.withColumnRenamed("cls", "a"), "a")
    other = profiles.select(F.col("cls").alias("b"), *[F.col(c).alias(f"{c}_b") for c in PROFILE])
    return first.join(other, "b").filter(_alike(least)).select("a", "b")


def _across(buckets: DataFrame, profiles: DataFrame, least: float) -> DataFrame:
    """The pairs of a bucket whose members are in different components and have like weights, parities
    and sketches, each pair in one bucket only: that of the smallest key which both have."""
    members = written(buckets.join(profiles.drop("weight"), "cls"), "near-profiled")
    other = members.select("key", *[F.col(c).alias(f"{c}_b") for c in ("cls", "comp", *PROFILE, "keys")])
    here = F.array_min(F.array_intersect("keys", "keys_b")) == F.col("key")
    met = members.join(other, "key").filter(
        (F.col("comp") < F.col("comp_b")) & _near_weights(least) & _alike(least) & here
    )
    return met.select(*_ordered(F.col("cls"), F.col("cls_b")))


def _open(members: DataFrame) -> DataFrame:
    """The rows (key, cls, comp, weight) of buckets that hold several components, written."""
    several = members.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high")
    return written(members.join(written(several.select("key"), "near-several"), "key"), "near-buckets")


def classes_and_roots(docs: DataFrame, id_col: str, text_col: str, least: float, width: int) -> tuple[DataFrame, DataFrame]:
    """(one row per document: doc_id, sha, row_no; one row per distinct text: sha, root)."""
    signed = _signed(docs, id_col, text_col, width)
    first = [F.first(c).alias(c) for c in ("keys", "weight", *WORDS)]
    classes = written(signed.groupBy("sha").agg(F.min("row_no").alias("cls"), *first), "near-classes")
    members = classes.select("cls", "weight", F.explode("keys").alias("key"))
    shared = written(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "near-shared")
    buckets = written(members.join(shared, "key").withColumn("comp", F.col("cls")), "near-buckets")
    words = [F.get(name, F.lit(i)).alias(f"{name}{i}") for name in WORDS for i in range(WORDS[name])]
    wanted = written(
        classes.join(buckets.select("cls").distinct(), "cls").select("cls", "sha", "weight", *words, "keys"), "near-wanted"
    )
    texts = _texts(docs, wanted.select("cls", "sha"), text_col)
    tested = roots = None
    for turn in range(STAR_ROUNDS + 1):
        if turn < STAR_ROUNDS:
            pairs = _star(buckets, wanted.select("cls", *PROFILE), turn, least)
        else:
            pairs = _across(buckets, wanted.select("cls", *PROFILE, "keys"), least)
        if tested is not None:
            pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        found = _verified(written(pairs, "near-pairs"), texts, least, width)
        tested = found if tested is None else tested.unionByName(found)
        roots = written(components(tested.filter("linked").select("a", "b")), "near-roots")
        if turn < STAR_ROUNDS:
            labelled = buckets.drop("comp").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
            buckets = _open(written(labelled.select("key", "cls", "weight", F.coalesce("root", "cls").alias("comp")), "near-labelled"))
    known = classes.select("sha", "cls").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    return signed.select("doc_id", "sha", "row_no"), written(
        known.select("sha", F.coalesce("root", "cls").alias("root")), "near-known"
    )


def near_duplicates(
    docs: DataFrame, least: float = LEAST, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, group_id, group_size, kept.

    Documents are linked if the weighted Jaccard similarity of their runs of ``width`` words is at
    least ``least``, or if their texts are equal but for white space; a group is what links connect,
    and ``group_id`` its smallest id, null ids last. A text of fewer words is one run. Null and blank
    texts equal one another and nothing else. Of a group exactly one row is kept, repeated ids or not.
    An empty table gives no rows; other columns are not read.
    """
    rows, known = classes_and_roots(docs, id_col, text_col, least, width)
    rooted = written(rows.join(known, "sha"), "near-rooted")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_no")))
    groups = written(
        rooted.groupBy("root").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size")), "near-groups"
    )
    return rooted.join(groups, "root").select(
        "doc_id", F.col("first.doc_id").alias("group_id"), "group_size", (F.col("row_no") == F.col("first.row_no")).alias("kept")
    )


def distinct_documents(
    docs: DataFrame, least: float = LEAST, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one document of each group, all columns as they are.

    Documents without a partner are passed on where they are read; a Bloom filter of the texts that
    have one picks the others. Of rows repeated with the same id and text one stays.
    """
    rows, known = classes_and_roots(docs, id_col, text_col, least, width)
    rooted = written(rows.join(known, "sha"), "near-rooted")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_no"), F.col("sha")))
    groups = rooted.groupBy("root").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = written(groups.select("root", F.col("first.doc_id").alias("keep_id"), F.col("first.sha").alias("keep_sha")), "near-groups")
    # One row per text of a group of several documents: stays with this id, or goes (null flag).
    texts = written(
        known.join(groups, "root").select("sha", (F.col("sha") == F.col("keep_sha")).alias("stays"), "keep_id"), "near-members"
    )
    probe = may_repeat(*repeat_filter(texts.select(F.xxhash64("sha")), texts.count(), least=1), docs.sparkSession)
    flagged = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.unhex(fingerprint(text_col)).alias("sha")
    ).withColumn("picked", probe(F.xxhash64("sha")))
    met = flagged.filter("picked").join(texts, "sha", "left")
    alone = flagged.filter("NOT picked").select("row").unionByName(met.filter("stays IS NULL").select("row"))
    stay = (
        met.filter(F.col("stays") & F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("sha").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    )
    return alone.unionByName(stay).select("row.*")
