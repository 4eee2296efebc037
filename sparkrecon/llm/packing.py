"""Best-fit packing by length patterns fitted with non-negative least squares.

1. The histogram of piece lengths is coarsened to ``BINS`` bins, each length counted with the bin's
   upper end. A pattern is a few bins that fill a sequence exactly.
2. Non-negative least squares finds how often each pattern is to be used so that the patterns take as
   many pieces of each bin as there are. The counts are rounded and cut to what is there.
3. Pieces are numbered within their bin and take the places of the patterns in that order: a lookup
   in the list of places, which is no longer than bins times pattern length.
4. Short pieces and what rounding left over are packed best-fit into the room that remains, in
   independent shards of bounded size.

Only the histogram (one row per length) and the list of places pass through the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written
from .common import parts_for, text_or_empty
from .tokens import SLICE, remembered_encoder, slices

LIMIT, BINS, DEPTH = 4096, 512, 3
# Share of a sequence below which a piece is kept for filling gaps.
SMALL = 1 / 4
# Pieces per numbering group, and pieces and open sequences per shard of the last step.
GROUP, SHARD = 50_000, 40_000


def cut_documents(
    docs: DataFrame, path: str, limit: int = LIMIT, end_id: int = 1, trim: bool = True,
    id_col: str = "doc_id", text_col: str = "text", together: int = SLICE,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32. Ids, then ``end_id``; longer ones are
    cut after every ``limit`` ids. A null text is an empty one, that is, just the end.
    ``together`` bytes of text are worked on at a time."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = remembered_encoder(path, trim)
        for batch in batches:
            for part in slices(batch, "text", together):
                ids, sizes = encoder.encode(part.column("text"))
                ids = np.insert(ids, np.cumsum(sizes), end_id).astype("<u4")
                sizes = sizes + 1
                begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
                count = -(-sizes // limit)
                doc = np.repeat(np.arange(len(sizes)), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                length = np.minimum(sizes[doc] - piece * limit, limit)
                at = begin[doc] + piece * limit
                sums = [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
                yield pa.record_batch(
                    [part.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(piece * limit, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(sums, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    read = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


@cache
def patterns(bins: int, depth: int, least: int) -> np.ndarray:
    """All ways to fill ``bins`` units with at most ``depth`` parts of ``least`` units or more: one
    row each, parts in falling order, zeros at the end."""
    found: list[tuple[int, ...]] = []

    def extend(parts: tuple[int, ...], left: int) -> None:
        if left == 0:
            found.append(parts + (0,) * (depth - len(parts)))
        elif len(parts) < depth:
            top = min(left, parts[-1] if parts else left)
            # The remaining parts must be able to hold what is left.
            low = max(least, -(-left // (depth - len(parts))))
            for part in range(low, top + 1):
                extend((*parts, part), left - part)

    extend((), bins)
    return np.array(found, np.int64).reshape(-1, depth)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """The x >= 0 with least ||a x - b||, by active sets (Lawson and Hanson)."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    scale = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[free] = -np.inf
        j = int(slope.argmax())
        if slope[j] <= scale:
            break
        free[j] = True
        while True:
            at = np.flatnonzero(free)
            s = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if s.min() > 0:
                x[:] = 0
                x[at] = s
                break
            low = at[s <= 0]
            step = x[low] / np.maximum(x[low] - s[s <= 0], 1e-300)
            x[at] += step.min() * (s - x[at])
            x[low[step <= step.min()]] = 0
            free &= x > 1e-12
            x[~free] = 0
    return x


def fit(histogram: np.ndarray, depth: int = DEPTH, least: int = 1) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) for a histogram over bins 1.. (index 0 unused); never more pieces than there are."""
    bins = len(histogram) - 1
    ways = patterns(bins, depth, least)
    left = histogram.astype(np.int64).copy()
    left[:least] = 0
    usable = np.all((ways == 0) | (left[ways] > 0), axis=1)
    ways = ways[usable]
    if not len(ways):
        return []
    uses = np.zeros((bins + 1, len(ways)))
    for column in range(depth):
        np.add.at(uses, (ways[:, column], np.arange(len(ways))), 1)
    uses[0] = 0
    x = nnls(uses, left.astype(float))
    found = []
    for j in np.argsort(-x):
        if x[j] < 0.5:
            break
        parts, times = np.unique(ways[j][ways[j] > 0], return_counts=True)
        repeats = min(int(x[j] + 0.5), int((left[parts] // times).min()))
        if repeats > 0:
            left[parts] -= repeats * times
            found.append((tuple(int(p) for p in ways[j] if p), repeats))
    return found


def _places(fitted: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int]]:
    """(bin, first number, number after the last, sequence of the first) for each part of a pattern."""
    used: dict[int, int] = {}
    places, sequence = [], 0
    for parts, repeats in fitted:
        for part in parts:
            first = used.get(part, 0)
            places.append((part, first, first + repeats, sequence))
            used[part] = first + repeats
        sequence += repeats
    return places


def best_fit(lengths: np.ndarray, room: np.ndarray, limit: int) -> tuple[np.ndarray, int]:
    """Where each piece goes, longest first, into the open sequence with the least room that holds it.

    ``room`` is what each open sequence has left; new ones are numbered behind them. Returns the
    sequence of each piece and the number of sequences opened.
    """
    stacks: list[list[int]] = [[] for _ in range(limit + 1)]
    present = 0
    for i, r in enumerate(room.tolist()):
        stacks[r].append(i)
        present |= 1 << r
    present &= ~1
    where, opened = np.zeros(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = present >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            target = stacks[r].pop()
            if not stacks[r]:
                present &= ~(1 << r)
        else:
            r, target, opened = limit, len(room) + opened, opened + 1
        where[i] = target
        if r > n:
            stacks[r - n].append(target)
            present |= 1 << (r - n)
    return where, opened


def pack(pieces: DataFrame, limit: int = LIMIT, bins: int = BINS, depth: int = DEPTH, small: float = SMALL) -> DataFrame:
    """``pieces`` (with length from 1 to ``limit``) with sequence_id and offset added.

    Pieces of one sequence lie one behind the other, the longest first. Every piece is packed once,
    repeated rows and rows with null ids included; no pieces give no rows. Other columns are kept
    (names beginning with ``_pack`` are used inside).
    """
    spark = pieces.sparkSession
    width = -(-limit // bins)
    least = max(1, int(bins * small))
    bin_of = F.ceil(F.col("length") / F.lit(width)).cast("int")
    rows = written(
        pieces.withColumns({"_pack_no": F.monotonically_increasing_id(), "_pack_bin": bin_of}), "pack-pieces"
    )
    histogram = np.zeros(bins + 1, np.int64)
    for length_bin, count in rows.groupBy("_pack_bin").count().collect():
        histogram[length_bin] = count
    fitted = fit(histogram, depth, least)
    sequences = sum(repeats for _, repeats in fitted)

    # Numbers within a bin: first within small groups, then shifted by the groups before.
    groups = parts_for(int(histogram.sum()), GROUP)
    group = F.pmod(F.xxhash64("_pack_no"), F.lit(groups))
    grouped = rows.withColumn("_pack_group", group)
    counts = grouped.groupBy("_pack_bin", "_pack_group").agg(F.count(F.lit(1)).alias("_pack_n"))
    before = Window.partitionBy("_pack_bin").orderBy("_pack_group").rowsBetween(Window.unboundedPreceding, -1)
    shifts = written(
        counts.select("_pack_bin", "_pack_group", F.coalesce(F.sum("_pack_n").over(before), F.lit(0)).alias("_pack_shift")),
        "pack-shifts",
    )
    inside = Window.partitionBy("_pack_bin", "_pack_group").orderBy("_pack_no")
    numbered = (
        grouped.withColumn("_pack_number", F.row_number().over(inside) - 1)
        .join(shifts, ["_pack_bin", "_pack_group"])
        .withColumn("_pack_number", F.col("_pack_number") + F.col("_pack_shift"))
    )
    # No more places than bins times depth: the fit has at most one pattern per bin.
    places = F.broadcast(
        spark.createDataFrame(_places(fitted), "_pack_part int, _pack_from long, _pack_upto long, _pack_first long")
    )
    held = (F.col("_pack_bin") == F.col("_pack_part")) & (F.col("_pack_number") >= F.col("_pack_from")) & (F.col("_pack_number") < F.col("_pack_upto"))
    placed = written(
        numbered.join(places, held, "left").select(
            *rows.columns, (F.col("_pack_first") + F.col("_pack_number") - F.col("_pack_from")).alias("sequence_id")
        ),
        "pack-placed",
    )

    open_room = placed.filter("sequence_id IS NOT NULL").groupBy("sequence_id").agg((F.lit(limit) - F.sum("length")).alias("length"))
    rest = placed.filter("sequence_id IS NULL")
    to_fill = rest.count()
    shards = parts_for(to_fill + sequences, SHARD)
    items = rest.select(F.col("_pack_no").alias("no"), F.lit(False).alias("is_open"), "length").unionByName(
        open_room.filter("length > 0").select(F.col("sequence_id").alias("no"), F.lit(True).alias("is_open"), "length")
    )

    def fill(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["is_open", "no"], kind="stable")
        is_open = shard["is_open"].to_numpy(bool)
        lengths = shard["length"].to_numpy()
        numbers = shard["no"].to_numpy()
        where, opened = best_fit(lengths[~is_open], lengths[is_open], limit)
        # New sequences of a shard are numbered from a range of its own, behind all others.
        new = (int(key[0]) + 1 << 40) + np.arange(opened)
        ids = np.concatenate([numbers[is_open], new])
        return pd.DataFrame({"_pack_no": numbers[~is_open], "filled": ids[where]})

    filled = written(
        items.withColumn("shard", F.pmod(F.xxhash64("no", "is_open"), F.lit(shards)).cast("long"))
        .groupBy("shard")
        .applyInPandas(fill, "_pack_no long, filled long"),
        "pack-filled",
    )
    whole = placed.filter("sequence_id IS NOT NULL").unionByName(
        rest.drop("sequence_id").join(filled, "_pack_no").withColumnRenamed("filled", "sequence_id")
    )
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "_pack_no")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return whole.withColumn("offset", F.sum("length").over(upto) - F.col("length")).drop("_pack_no", "_pack_bin")
