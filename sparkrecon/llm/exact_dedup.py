"""Exact dedup: a two-pass Bloom filter finds the texts that may repeat; only their rows shuffle.

Pass 1 hashes every text into a counting filter of two bits a cell (never, once, more often), built
per task and merged in a tree. Pass 2 probes it: a text with a cell below two is unique for sure and
passes straight through. The rest, true repeats and a few false alarms, are grouped exactly by the
SHA-256 of the whole normalised text.

The filter has 16 cells a row up to ``max_cells`` (2 bits each; the default is 32 MB), which bounds
what is merged on the driver and sent to the executors. Beyond that, more unique rows are taken
along into the exact grouping: slower, never wrong.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written
from .common import SPACE, text_or_empty

FUNCTIONS = 4
CELLS_A_ROW = 16
MAX_CELLS = 1 << 27


def fingerprint(text: str = "text") -> Column:
    """SHA-256 of the text with each run of white space replaced by one space."""
    return F.sha2(F.regexp_replace(text_or_empty(text), f"{SPACE}+", " "), 256)


def _cells(hashes: np.ndarray, cells: int) -> list[np.ndarray]:
    """One cell of each function's own region, so that no text meets a cell twice."""
    region = np.uint64(cells // FUNCTIONS)
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32)
    return [
        ((low + np.uint64(i) * (high | np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % region
        + np.uint64(i) * region
        for i in range(FUNCTIONS)
    ]


def _counted(cells: int):
    def build(rows: Iterator) -> Iterator[tuple[bytes, bytes]]:
        counts = np.zeros(cells, np.uint8)
        held: list[int] = []

        def add() -> None:
            hashes = np.array(held, np.int64).view(np.uint64)
            held.clear()
            for cell in _cells(hashes, cells):
                hit, times = np.unique(cell.astype(np.int64), return_counts=True)
                counts[hit] = np.minimum(2, counts[hit] + np.minimum(times, 2))

        for row in rows:
            held.append(row[0])
            if len(held) == 100_000:
                add()
        if held:
            add()
        if counts.any():
            yield np.packbits(counts >= 1).tobytes(), np.packbits(counts >= 2).tobytes()

    return build


def _merged(a: tuple[bytes, bytes], b: tuple[bytes, bytes]) -> tuple[bytes, bytes]:
    """Cells met once or more, and cells met twice or more, of two filters together."""
    if not a[0] or not b[0]:
        return a if a[0] else b
    a1, a2, b1, b2 = (np.frombuffer(x, np.uint8) for x in (*a, *b))
    return (a1 | b1).tobytes(), (a2 | b2 | (a1 & b1)).tobytes()


def repeat_filter(
    hashes: DataFrame, rows: int, max_cells: int = MAX_CELLS, least: int = 2
) -> tuple[bytes, int]:
    """The cells that ``hashes`` (one bigint column) meet ``least`` (1 or 2) times or more, and the
    number of cells."""
    cells = 1 << 10
    while cells < min(max_cells, CELLS_A_ROW * rows):
        cells *= 2
    found = hashes.rdd.mapPartitions(_counted(cells)).treeAggregate((b"", b""), _merged, _merged)
    return found[least - 1], cells


def may_repeat(met: bytes, cells: int, spark) -> object:
    """A column function: false only where the hash surely was not met often enough."""
    shared = spark.sparkContext.broadcast(met)

    @F.pandas_udf("boolean")
    def probe(hashes: pd.Series) -> pd.Series:
        bits = np.frombuffer(shared.value, np.uint8)
        if not len(bits):
            return pd.Series(np.zeros(len(hashes), bool))
        found = np.ones(len(hashes), bool)
        for cell in _cells(hashes.to_numpy(np.int64).view(np.uint64), cells):
            at = cell.astype(np.int64)
            found &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return pd.Series(found)

    return probe


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One small row per document, written once: every later step reads this table only."""
    return written(
        docs.select(
            F.col(id_col).alias("doc_id"), F.unhex(fingerprint(text_col)).alias("sha")
        ).select(
            "doc_id", "sha", F.xxhash64("sha").alias("hash"),
            F.monotonically_increasing_id().alias("row_no"),
        ),
        "dedup-hashes",
    )


def _groups(again: DataFrame) -> DataFrame:
    """Per text that may repeat: its first row (null ids last) and its size; written, so that the
    join with the rows has a plain exchange on both sides and a text of many copies can be split."""
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_no")))
    return written(
        again.groupBy("sha")
        .agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
        .select("sha", F.col("first.doc_id").alias("keep_id"), F.col("first.row_no").alias("keep_row"), "group_size"),
        "dedup-groups",
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_cells: int = MAX_CELLS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    A null text counts as empty, and empty texts are equal to each other. The smallest id of a group
    stays; null ids come last. Of rows repeated with the same id and text exactly one is kept. An
    empty table gives no rows; other columns of ``docs`` are not read.
    """
    hashed = _hashed(docs, id_col, text_col)
    twice, cells = repeat_filter(hashed.select("hash"), hashed.count(), max_cells)
    flagged = hashed.withColumn("again", may_repeat(twice, cells, docs.sparkSession)("hash"))
    alone = flagged.filter(~F.col("again")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha",
    )
    again = flagged.filter("again").select("doc_id", "sha", "row_no")
    grouped = again.join(_groups(again), "sha").select(
        "doc_id", "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"), "sha"
    )
    return alone.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def distinct_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_cells: int = MAX_CELLS
) -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops, all columns as they are.

    Rows whose text is surely unique are passed on where they are read. Of rows repeated with the
    same id and text one stays; if their other columns differ, the one with the smallest row hash.
    """
    hashed = _hashed(docs, id_col, text_col)
    twice, cells = repeat_filter(hashed.select("hash"), hashed.count(), max_cells)
    probe = may_repeat(twice, cells, docs.sparkSession)
    again = hashed.filter(probe("hash")).select("doc_id", "sha", "row_no")
    groups = _groups(again).select("sha", "keep_id")
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.unhex(fingerprint(text_col)).alias("sha")
    )
    flagged = rows.withColumn("again", probe(F.xxhash64("sha")))
    alone = flagged.filter(~F.col("again")).select("row")
    first = (
        flagged.filter("again")
        .join(groups, "sha")
        .filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("sha")
        .agg(F.min_by("row", F.xxhash64("row")).alias("row"))
        .select("row")
    )
    return alone.unionByName(first).select("row.*")


ORACLE = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept,
       text_sha256
FROM n
WINDOW g AS (PARTITION BY text_sha256)
"""
