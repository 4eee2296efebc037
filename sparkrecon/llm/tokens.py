"""Whole texts to token ids with a public tokenizer, encoding each distinct piece of text once.

A text is cut in front of every run of white space. No pre-token of the tokenizers used here spans
such a cut: a run of white space starts a pre-token of its own or belongs to the word behind it. So
the ids of a text are those of its pieces one after another, and a piece that occurs a thousand times
is encoded once. Texts for which that does not hold (white space beyond ASCII, which may join a run
across a cut) go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# One thread per task; the library would start one per core.
os.environ.setdefault("RAYON_NUM_THREADS", "1")
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# White space beyond ASCII, and characters that some libraries take for it.
_WIDE_SPACE = (
    r"[\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200D}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
# Bytes of text looked at together, pieces remembered per Python worker, and words given to the library as
# one string.
SLICE = 8 << 20
REMEMBERED = 400_000
JOINED = 256


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes of text, or one row that is longer."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(sizes)], strict=True):
        yield batch.slice(int(a), int(b - a))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an array of strings, nulls as empty texts."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4) if len(texts) else np.zeros(1, np.int32)
    data = texts.buffers()[2] if len(texts) else None
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def pieces(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The pieces of all texts in turn, as a dictionary array, and where each text's pieces start."""
    data, offsets = text_bytes(texts)
    space = _IS_SPACE[data]
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    at = np.flatnonzero(start)
    bounds = np.append(at, len(data)).astype(np.int32)
    cut = pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
    return cut.dictionary_encode(), np.searchsorted(at, offsets)


class PieceEncoder:
    """Ids, or numbers of ids, of whole texts, by ``encode_many`` over distinct pieces.

    ``encode_many`` maps a list of strings to a list of id lists. ``trim`` drops the white space of
    pieces, for tokenizers that ignore it. ``encode_pieces``, if given, is used for the pieces; it
    returns their ids in one array and the number of each. ``fold`` maps an array of pieces to one
    of fewer different pieces with the same ids.
    """

    def __init__(self, encode_many, trim: bool = False, encode_pieces=None, fold=None):
        self._encode, self._trim, self._fold = encode_many, trim, fold or (lambda words: words)
        self._encode_pieces = encode_pieces or (lambda many: _in_turn(encode_many(many)))
        self._clear()

    def _clear(self) -> None:
        self._known: dict[str, int] = {}
        self._flat, self._ends, self._hits = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, np.int32)
        self._size = 0

    def _forget(self) -> None:
        """Keep what was met most often, half of the room at most; rare pieces hardly come again."""
        least = 2
        while np.count_nonzero(self._hits >= least) > REMEMBERED // 2:
            least += 1
        keep = np.flatnonzero(self._hits >= least)
        words = list(self._known)
        sizes = np.diff(self._ends)[keep]
        self._flat = self._flat[_ranges(self._ends[keep], sizes)]
        self._ends = np.concatenate([[0], np.cumsum(sizes)])
        self._hits = np.ones(len(keep), np.int32)
        self._known = {words[i]: at for at, i in enumerate(keep.tolist())}
        self._size = sum(map(len, self._known))

    def _remember(self, words: list[str]) -> np.ndarray:
        """The number of each word among the remembered ones, after adding the new ones."""
        if self._size > REMEMBERED * 32:  # pieces that are long without a space
            self._clear()
        elif len(self._known) > REMEMBERED:
            self._forget()
        known = self._known
        new = list(dict.fromkeys(filterfalse(known.__contains__, words)))
        if new:
            ids, sizes = self._encode_pieces(new)
            self._flat = np.concatenate([self._flat, ids])
            self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(sizes)])
            self._hits = np.concatenate([self._hits, np.zeros(len(new), np.int32)])
            self._size += sum(map(len, new))
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        numbers = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        self._hits[numbers] += 1
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, number of ids of each text). A null text has none."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, _WIDE_SPACE).to_numpy(zero_copy_only=False)
        if whole.any():
            return self._mixed(texts, whole)
        coded, starts = pieces(texts)
        words = pc.ascii_trim_whitespace(coded.dictionary) if self._trim else coded.dictionary
        numbers = self._remember(self._fold(words).to_pylist())[coded.indices.to_numpy()]
        sizes = np.diff(self._ends)[numbers]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return self._flat[_ranges(self._ends[numbers], sizes)], np.diff(upto[starts])

    def _mixed(self, texts: pa.Array, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts, sizes = [], []
        for run in np.split(np.arange(len(whole)), np.flatnonzero(np.diff(whole)) + 1):
            part = texts.slice(int(run[0]), len(run))
            if whole[run[0]]:
                found = [np.array(i, np.uint32) for i in self._encode(part.to_pylist())]
                parts += found
                sizes.append(np.array([len(i) for i in found], np.int64))
            else:
                ids, n = self.encode(part)
                parts.append(ids)
                sizes.append(n)
        return np.concatenate(parts), np.concatenate(sizes)


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, .. of each of several runs, one run after the other."""
    upto = np.concatenate([[0], np.cumsum(sizes)])
    return np.repeat(first - upto[:-1], sizes) + np.arange(upto[-1])


def _in_turn(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in one array, and how many each list has."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes


_loaded: dict = {}


def library_encoder(path: str):
    """``encode_many`` of the tokenizers library for a .json file, as the library does by default but
    without tokens added around a text, truncation or padding. Loaded once per Python worker."""
    return _library(path)[1]


def _library(path: str):
    """(the tokenizer of a file, its ``encode_many``)."""
    if path not in _loaded:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        added = tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word for t in added) and not _trims(tokenizer):
            raise ValueError(f"{path}: added tokens that look at their neighbours cannot be cut at spaces")
        _loaded[path] = tokenizer, lambda many: [e.ids for e in tokenizer.encode_batch_fast(many, add_special_tokens=False)]
    return _loaded[path]


def _separator(tokenizer) -> str | None:
    """A special token at which the library cuts a string before it does anything else, and which no
    special token can overlap, so that strings joined with it are encoded as each is alone."""
    added = tokenizer.get_added_tokens_decoder().values()
    if any(t.lstrip or t.rstrip or t.single_word or t.normalized or not t.special for t in added):
        return None
    names = [t.content for t in added]
    for name in names:
        inside = any(name in other or other in name for other in names if other != name)
        meets = any(a[-n:] == b[:n] for other in names for a, b in ((name, other), (other, name)) for n in range(1, min(len(a), len(b))))
        if not inside and not meets:
            return name
    return None


def _lowered(tokenizer) -> str | None:
    """An expression for the words of which the tokenizer's normalizer makes nothing but lower case: printable
    ASCII that cannot hold a special token. None if it does anything else to them."""
    spec = json.loads(tokenizer.to_str())["normalizer"] or {}
    steps = spec.get("normalizers", [spec])
    spaces = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    if {"type": "Lowercase"} not in steps or any(s not in ({"type": "NFC"}, {"type": "Lowercase"}, spaces) for s in steps):
        return None
    first = {t.content[0] for t in tokenizer.get_added_tokens_decoder().values()}
    if any(c.isalnum() or not c.isascii() for c in first):
        return None
    return "^[" + "".join(f"\\x{n:02x}" for n in range(0x21, 0x7F) if chr(n) not in first) + "]*$"


def folding(path: str):
    """A function that puts words in lower case where the tokenizer of the file tells no cases apart."""
    plain = _lowered(_library(path)[0])
    if plain is None:
        return lambda words: words
    return lambda words: pc.if_else(pc.match_substring_regex(words, plain), pc.ascii_lower(words), words)


def joined_encoder(path: str):
    """As ``library_encoder``, for many short strings: ``JOINED`` of them go to the library as one string with
    a special token between them, which costs it less than one string at a time. Returns all ids in one
    array and the number of each string. Strings that hold that token themselves are encoded singly, and
    words that the normalizer only puts in lower case come to the library so and pass it by."""
    tokenizer, encode_many = _library(path)
    separator = _separator(tokenizer)
    if separator is None:
        return lambda many: _in_turn(encode_many(many))
    mark = tokenizer.token_to_id(separator)

    def joined(by, many: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [many[at : at + JOINED] for at in range(0, len(many), JOINED)]
        found = by.encode_batch_fast([separator.join(part) for part in parts], add_special_tokens=False)
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for part, one in zip(parts, found, strict=True):
            flat = np.array(one.ids, np.uint32)
            marks = np.flatnonzero(flat == mark)
            if len(marks) == len(part) - 1:
                flat, each = np.delete(flat, marks), np.diff(marks, prepend=-1, append=len(flat)) - 1
            else:
                flat, each = _in_turn(encode_many(part))
            ids.append(flat)
            sizes.append(each)
        return np.concatenate(ids), np.concatenate(sizes)

    expression = _lowered(tokenizer)
    if expression is None:
        return lambda many: joined(tokenizer, many)
    plain = re.compile(expression[1:-1])
    bare = type(tokenizer).from_str(tokenizer.to_str())
    bare.normalizer = None

    def encode(many: list[str]) -> tuple[np.ndarray, np.ndarray]:
        is_plain = np.fromiter((plain.fullmatch(w) is not None for w in many), bool, len(many))
        at, rest = np.flatnonzero(is_plain), np.flatnonzero(~is_plain)
        ids, sizes = zip(joined(bare, [many[i].lower() for i in at]), joined(tokenizer, [many[i] for i in rest]), strict=True)
        ids, sizes = np.concatenate(ids), np.concatenate(sizes)
        place = np.argsort(np.concatenate([at, rest]))
        return ids[_ranges((np.cumsum(sizes) - sizes)[place], sizes[place])], sizes[place]

    return encode


def _trims(tokenizer) -> bool:
    return not tokenizer.encode(" \n", add_special_tokens=False).ids


def remembered_encoder(path: str, trim: bool = False) -> PieceEncoder:
    """The encoder of a file, kept by the Python worker so that later tasks find its pieces known."""
    key = (path, trim)
    if key not in _loaded:
        _loaded[key] = PieceEncoder(library_encoder(path), trim, *((joined_encoder(path), folding(path)) if trim else ()))
    return _loaded[key]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
