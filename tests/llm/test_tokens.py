"""Token counts, token files and packing against the tokenizers library on whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import MESSY, documents, messy, nothing, records  # noqa: F401
from tokenizers import Tokenizer

from sparkrecon.llm import tokens
from sparkrecon.llm.packing import best_fit, cut_documents, fit, nnls, pack, patterns
from sparkrecon.llm.token_counts import ShortcutCounter, token_counts, whole_tokens
from sparkrecon.llm.token_files import BLOCK, FileReader, FileWriter, read_token_files, token_folder, unpack, width_of, write_token_files
from sparkrecon.llm.token_files import pack as pack_bits
from sparkrecon.llm.tokens import JOINED, PieceEncoder, joined_encoder, library_encoder, remembered_encoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
_library = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}


def whole(path, text):
    return _library[path].encode(text or "", add_special_tokens=False).ids


_chars = st.one_of(st.sampled_from(list(" \n\t\r\x0b\x1c  '<|endoftext>aAsS1é\u0301\u00a0\u2003\u3000.,!漢ß\U0001f600")), st.characters(codec="utf-8"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(_chars, max_size=40), st.just("x <|endoftext|>  y")), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    for path, trim in ((BYTE, False), (WORD, True)):
        ids, sizes = remembered_encoder(path, trim).encode(pa.array(texts, pa.string()))
        want = [whole(path, t) for t in texts]
        assert sizes.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


@settings(max_examples=300, deadline=None)
@given(st.text(_chars, max_size=60))
def test_shortcut_counts_as_the_library(text):
    counter = ShortcutCounter(BYTE, public_tokenizers.PATTERN, _proven)
    counts, pieces = PieceEncoder(counter).encode(pa.array([text]))
    assert int(counts.sum()) == len(whole(BYTE, text)) and pieces.sum() == len(counts)


_proven = whole_tokens(BYTE)


def test_proven_strings_are_most_of_the_vocabulary():
    assert len(_proven) > 40_000 and " the" in _proven and "<|endoftext|>" not in _proven
    counter = ShortcutCounter(BYTE, public_tokenizers.PATTERN, _proven)
    counter([" the", " and", " unheardofword"])
    assert counter.direct == 2 and counter.merged == 1


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    encoder = PieceEncoder(library_encoder(BYTE))
    for i in range(40):
        texts = [f"common words here w{i} {'w' * i} v{i % 7}", "common words"]
        assert encoder.encode(pa.array(texts))[0].tolist() == [x for t in texts for x in whole(BYTE, t)]
    assert len(encoder._known) < 120


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.text(_chars, max_size=9), st.sampled_from(["", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "Word", "IT'S", "H\u0331", "Σ"])), max_size=8))
def test_joined_words_have_the_ids_of_each_alone(words):
    for path in (BYTE, WORD):
        ids, sizes = _joined[path](words * 90)
        want = [whole(path, w) for w in words * 90]
        assert sizes.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


_joined = {p: joined_encoder(p) for p in (BYTE, WORD)}


def test_new_words_go_to_the_library_many_at_a_time(monkeypatch):
    """A string for each word costs the library more than the words themselves."""
    given_strings = []

    class Counted:
        def __init__(self, tokenizer):
            self._of = tokenizer

        def __getattr__(self, name):
            return getattr(self._of, name)

        @staticmethod
        def from_str(text):
            return Counted(Tokenizer.from_str(text))

        def __setattr__(self, name, value):
            object.__setattr__(self if name == "_of" else self._of, name, value)

        def encode_batch_fast(self, many, **options):
            given_strings.append(len(many))
            return self._of.encode_batch_fast(many, **options)

    monkeypatch.setattr("tokenizers.Tokenizer.from_file", lambda path: Counted(_library[path]))
    monkeypatch.setattr(tokens, "_loaded", {})
    words = [f"word{i}x" for i in range(3000)]
    ids, sizes = remembered_encoder(WORD, True).encode(pa.array([" ".join(words)]))
    assert ids.tolist() == whole(WORD, " ".join(words)) and sizes.tolist() == [len(ids)]
    assert 0 < sum(given_strings) <= len(words) // JOINED + 1


def test_token_counts(messy, nothing):
    got = token_counts(messy, BYTE, public_tokenizers.PATTERN)
    want = [(i, len((t or "").encode()), len(whole(BYTE, t)), len(whole(BYTE, t)) > 1024) for i, t, *_ in MESSY]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert token_counts(nothing, BYTE, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1000, dtype=np.uint32)
    data = pack_bits(ids, bits)
    assert len(data) == -(-1000 * bits // 8) and (unpack(data, 1000, bits) == ids).all()
    with pytest.raises(ValueError):
        pack_bits(np.array([2**bits], np.uint64), bits)


def test_widths():
    assert [width_of(v) for v in (1, 2, 3, 256, 257, 50_257, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_random_access(tmp_path):
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 50_000, n, dtype=np.uint32) for n in (5, 0, BLOCK, 3 * BLOCK + 17, 1)]
    out = FileWriter(f"file://{tmp_path}/a.ids", 17)
    for i, d in enumerate(docs):
        out.add([None if i == 1 else i], d, np.array([len(d)]))
    out.close()
    file, whole_ids = FileReader(f"file://{tmp_path}/a.ids"), np.concatenate(docs)
    assert file.doc_ids == [0, None, 2, 3, 4] and file.lengths.tolist() == [len(d) for d in docs]
    for a, b in [(0, 0), (0, 5), (BLOCK - 1, BLOCK + 2), (3, 3 * BLOCK), (len(whole_ids) - 1, len(whole_ids)), (0, len(whole_ids))]:
        assert (file.ids(a, b) == whole_ids[a:b]).all()
    assert all((x == docs[i]).all() for i, x in file.documents(most=100))


@pytest.mark.parametrize("each", [4, 10_000])
def test_token_files(spark, messy, nothing, each):
    files = write_token_files(messy, BYTE, token_folder(spark), 50_257, docs_a_file=each)
    got = sorted(records(read_token_files(spark, files)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((m[0] for m in MESSY), key=lambda i: (i is not None, i or 0))
    left, at = list(MESSY), 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        sums = {zlib.crc32(np.array([*whole(BYTE, t), 0], "<u4").tobytes()): (i, t, g, s) for i, t, g, s in left if i == r["doc_id"]}
        assert r["ids_crc32"] in sums
        left.remove(sums[r["ids_crc32"]])
    assert read_token_files(spark, write_token_files(nothing, BYTE, token_folder(spark), 50_257)).count() == 0


def _check_packing(rows, limit=4096):
    """No gap, no overlap, nothing above the limit. Returns the number of sequences."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(sequences)


def test_packing(messy, nothing):
    rows = records(pack(cut_documents(messy, WORD)))
    _check_packing(rows)
    want = []
    for i, t, *_ in MESSY:
        ids = np.array([*whole(WORD, t), 1], "<u4")
        want += [(i, n, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for n, a in enumerate(range(0, len(ids), 4096))]
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert pack(cut_documents(nothing, WORD)).count() == 0


@pytest.mark.parametrize("shape", ["wide", "one length", "halves", "tiny"])
def test_packing_is_near_the_least_number(spark, shape):
    rng = np.random.default_rng(3)
    lengths = {
        "wide": np.clip(rng.lognormal(6.5, 1, 4000).astype(int), 1, 4096), "one length": np.full(3000, 1365),
        "halves": rng.integers(2000, 2097, 3000), "tiny": rng.integers(1, 30, 3000),
    }[shape]
    pieces = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "doc_id LONG, length LONG")
    rows = records(pack(pieces))
    assert sorted(r["doc_id"] for r in rows) == list(range(len(lengths)))
    plain, opened = best_fit(lengths, np.zeros(0, np.int64), 4096)
    # Lengths around half a sequence pair to within a few ids, which bins of eight ids do not see.
    slack = 1.07 if shape == "halves" else 1.005
    assert _check_packing(rows) <= opened * slack + 1


def test_patterns_fill_a_sequence():
    found = patterns(12, 3, 2)
    assert {tuple(sorted(p[p > 0])) for p in found} == {(12,), (2, 10), (3, 9), (4, 8), (5, 7), (6, 6), (2, 2, 8), (2, 3, 7), (2, 4, 6), (2, 5, 5), (3, 3, 6), (3, 4, 5), (4, 4, 4)}


def test_nnls_satisfies_its_conditions():
    rng = np.random.default_rng(1)
    a, b = rng.random((20, 40)), rng.random(20) * 10
    x = nnls(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and slope.max() < 1e-6 and abs(slope[x > 0]).max() < 1e-6


def test_fit_takes_no_more_than_there_is():
    histogram = np.array([0, 0, 5, 9, 40, 3, 17, 0, 30, 2])
    left = histogram.copy()
    for parts, repeats in fit(histogram, 3, 2):
        assert sum(parts) == 9
        for p in parts:
            left[p] -= repeats
    assert (left >= 0).all() and left.sum() < histogram.sum()


def test_repeated_rows_are_packed_each(spark):
    docs = documents(spark, [(1, "same text", None, None)] * 50)
    rows = records(pack(cut_documents(docs, WORD)))
    assert len(rows) == 50 and _check_packing(rows) == 1
