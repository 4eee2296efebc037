"""Token ids as files of fixed-width integers, bit-packed, with random access.

A file holds the ids of a run of documents in order, in blocks of ``BLOCK`` ids. Each id takes the
fewest bits that hold every id of the vocabulary, most significant bit first; a block starts on a
byte. Behind the blocks follow the documents' ids and lengths and the offset of every block, then the
fixed trailer. A reader seeks to the blocks of the range it wants and unpacks them with numpy.

    blocks | doc ids (int64) | null flags (uint8) | lengths (int64) | block offsets (int64) | trailer
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import shared_folder
from .common import parts_for, text_or_empty
from .tokens import remembered_encoder, slices

BLOCK = 1 << 16
DOCS_A_FILE = 10_000
# Number of documents, ids and blocks, bits an id, and a fixed mark at the very end.
_TRAILER = struct.Struct("<QQQB7s")
_MARK = b"BITPACK"


def width_of(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit {bits} bits")
    if bits in (8, 16, 32):  # the same layout, without spreading the bits
        return ids.astype(f">u{bits // 8}").tobytes()
    shifts = np.arange(bits - 1, -1, -1, dtype=np.uint32)
    return np.packbits((ids.astype(np.uint32)[:, None] >> shifts & 1).astype(np.uint8)).tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", count).astype(np.uint32)
    spread = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits).reshape(count, bits)
    return spread @ (np.uint32(1) << np.arange(bits - 1, -1, -1, dtype=np.uint32))


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class FileWriter:
    """Writes one file under a name of its own and gives it its final name when it is complete."""

    def __init__(self, uri: str, bits: int):
        self._fs, self._path = _place(uri)
        self._part = f"{self._path}.{uuid.uuid4().hex}"
        self._out = self._fs.open_output_stream(self._part)
        self._bits, self._rest = bits, np.zeros(0, np.uint32)
        self._offsets, self._ids, self._lengths = [0], [], []
        self.docs = self.tokens = 0

    def add(self, doc_ids: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        self._ids += doc_ids
        self._lengths.append(lengths.astype(np.int64))
        self.docs += len(doc_ids)
        self.tokens += len(ids)
        held = np.concatenate([self._rest, ids])
        whole = len(held) // BLOCK * BLOCK
        for at in range(0, whole, BLOCK):
            self._write(held[at : at + BLOCK])
        self._rest = held[whole:].copy()

    def _write(self, ids: np.ndarray) -> None:
        data = pack(ids, self._bits)
        self._out.write(data)
        self._offsets.append(self._offsets[-1] + len(data))

    def close(self) -> None:
        if len(self._rest):
            self._write(self._rest)
        self._out.write(np.array([0 if i is None else i for i in self._ids], "<i8").tobytes())
        self._out.write(np.array([i is None for i in self._ids], np.uint8).tobytes())
        self._out.write(np.concatenate([np.zeros(0, np.int64), *self._lengths]).astype("<i8").tobytes())
        self._out.write(np.array(self._offsets, "<i8").tobytes())
        blocks = len(self._offsets) - 1
        self._out.write(_TRAILER.pack(self.docs, self.tokens, blocks, self._bits, _MARK))
        self._out.close()
        self._fs.move(self._part, self._path)


class FileReader:
    """Random access to a file: ``doc_ids``, ``lengths``, ``starts`` and ``ids(start, stop)``."""

    def __init__(self, uri: str):
        fs, path = _place(uri)
        self._file = fs.open_input_file(path)
        size = self._file.size()
        docs, self.tokens, blocks, self._bits, mark = _TRAILER.unpack(self._file.read_at(_TRAILER.size, size - _TRAILER.size))
        if mark != _MARK:
            raise ValueError(f"{uri} is no token file")
        index = docs * 17 + (blocks + 1) * 8
        raw = self._file.read_at(index, size - _TRAILER.size - index)
        ids = np.frombuffer(raw, "<i8", docs)
        null = np.frombuffer(raw, np.uint8, docs, docs * 8)
        self.doc_ids = [None if n else i for i, n in zip(ids.tolist(), null.tolist(), strict=True)]
        self.lengths = np.frombuffer(raw, "<i8", docs, docs * 9)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        self._offsets = np.frombuffer(raw, "<i8", blocks + 1, docs * 17)

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (stop - 1) // BLOCK
        data = self._file.read_at(int(self._offsets[last + 1] - self._offsets[first]), int(self._offsets[first]))
        # Every block but the last of the file is full, and full blocks end on a byte.
        count = min(self.tokens, (last + 1) * BLOCK) - first * BLOCK
        return unpack(data, count, self._bits)[start - first * BLOCK : stop - first * BLOCK]

    def documents(self, most: int = 1 << 22) -> Iterator[tuple[int, np.ndarray]]:
        """(number, ids) of each document in turn, reading about ``most`` ids at a time."""
        at = 0
        while at < len(self.doc_ids):
            upto = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + most, "right")) - 1)
            held = self.ids(int(self.starts[at]), int(self.starts[upto]))
            for i in range(at, upto):
                yield i, held[self.starts[i] - self.starts[at] : self.starts[i + 1] - self.starts[at]]
            at = upto


def write_token_files(
    docs: DataFrame,
    path: str,
    folder: str,
    vocabulary: int,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    docs_a_file: int = DOCS_A_FILE,
) -> DataFrame:
    """Write ``docs`` in ascending order of id into files of ``folder``, one per range of ids.

    Returns one row per file in order: part, uri, docs, tokens, base (ids in the files before it).
    Null ids come first and ties are ordered by a hash of the text. Every document is its ids, then
    ``end_id``; a null text is just that. The row per file is all that the driver sees.
    """
    bits = width_of(max(vocabulary, end_id + 1))
    count = parts_for(docs.count(), docs_a_file)
    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
        .repartitionByRange(count, *order)
        .sortWithinPartitions(*order)
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        uri = f"{folder}/part-{part:06d}.ids"
        out, encoder = FileWriter(uri, bits), remembered_encoder(path)
        for batch in batches:
            for piece in slices(batch, "text"):
                ids, sizes = encoder.encode(piece.column("text"))
                ends = np.cumsum(sizes)
                out.add(piece.column("doc_id").to_pylist(), np.insert(ids, ends, end_id), sizes + 1)
        out.close()
        yield pa.record_batch(
            [pa.array([part], pa.int32()), pa.array([uri]), pa.array([out.docs], pa.int64()), pa.array([out.tokens], pa.int64())],
            names=["part", "uri", "docs", "tokens"],
        )

    rows = sorted(ranged.mapInArrow(write, "part int, uri string, docs long, tokens long").collect())
    base, found = 0, []
    for part, uri, n, tokens in rows:
        found.append((part, uri, n, tokens, base))
        base += tokens
    return docs.sparkSession.createDataFrame(found, "part int, uri string, docs long, tokens long, base long")


def read_token_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32, from their content.

    ``start`` counts the ids of all documents before, ``ids_crc32`` is over little-endian unsigned
    32-bit ids.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column("uri").to_pylist(), batch.column("base").to_pylist(), strict=True):
                file = FileReader(uri)
                sums = np.fromiter((zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in file.documents()), np.int64)
                yield pa.record_batch(
                    [pa.array(file.doc_ids, pa.int64()), pa.array(file.starts[:-1] + base), pa.array(file.lengths), pa.array(sums)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    n = max(1, files.count())
    spread = files.select("part", "uri", "base").repartitionByRange(n, "part")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_folder(spark: SparkSession) -> str:
    """A new folder for token files, in the shared folder."""
    folder = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    fs, path = _place(folder)
    fs.create_dir(path, recursive=True)
    return folder
