import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import EXTRA, MESSY, documents, messy, nothing, records  # noqa: F401

from sparkrecon.llm import near_dedup
from sparkrecon.llm.near_dedup import (
    BANDS,
    MOST_DIFFERENT,
    ROWS,
    band_keys,
    cells_of,
    distinct_documents,
    near_duplicates,
    parities,
    signatures,
    sketches,
    weighted_shingles,
)
from sparkrecon.llm.near_dedup import similarity as fast_similarity
from sparkrecon.llm.words import shingles, word_hashes


def _bag(text):
    words = [w for w in (text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def similarity(a, b):
    whole = sum((a | b).values())
    return sum((a & b).values()) / whole if whole else 0.0


def _brute(rows):
    """Groups by comparing all pairs of texts."""
    texts = [" ".join((t or "").replace("\n", " ").replace("\t", " ").split(" ")) for _, t, *_ in rows]
    blank = [not t.strip() for t in texts]
    bags = [_bag(t) for t in texts]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][1] == rows[j][1] or (blank[i] and blank[j] and (rows[i][1] or "") == (rows[j][1] or ""))
            if same or similarity(bags[i], bags[j]) >= 0.8:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r[0])
    return sorted((sorted(map(str, ids)), min((i for i in ids if i is not None), default=None)) for ids in groups.values())


def _found(df):
    rows = records(near_duplicates(df))
    groups, kept = defaultdict(list), defaultdict(int)
    for r in rows:
        groups[r["group_id"], r["group_size"]].append(r["doc_id"])
        kept[r["group_id"]] += r["kept"]
    assert all(len(ids) % size == 0 for (_, size), ids in groups.items())
    assert all(r["doc_id"] == r["group_id"] for r in rows if r["kept"])
    return sorted((sorted(map(str, ids)), i) for (i, _), ids in groups.items()), kept


def _edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def _corpus(seed=0, families=25):
    rng = random.Random(seed)
    rows, i = [], 0
    for f in range(families):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 8, 60, 200, 900]))]
        for _ in range(rng.choice([1, 2, 3, 6])):
            rows.append((i, _edited(rng, words, rng.choice([0, 0, 1, 2, 5])), "en", f"s{f}"))
            i += 1
    passage = " ".join(f"shared{k}" for k in range(60))
    rows += [(i + k, passage + " " + " ".join(f"own{k}x{m}" for m in range(80)), None, None) for k in range(20)]
    return rows


def test_against_all_pairs(spark):
    rows = _corpus()
    got, kept = _found(documents(spark, rows).repartition(4))
    assert got == _brute(rows) and set(kept.values()) == {1}


def test_chain_through_links(spark):
    """Each text is linked to the next one only; the chain is one group."""
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 20 : i * 20 + 200]), None, None) for i in range(11)]
    assert similarity(_bag(rows[0][1]), _bag(rows[2][1])) < 0.8 <= similarity(_bag(rows[0][1]), _bag(rows[1][1]))
    got, _ = _found(documents(spark, rows))
    assert got == _brute(rows) and len(got) == 1


def test_a_large_group(spark):
    rng = random.Random(2)
    words = [f"h{rng.randrange(5000)}" for _ in range(300)]
    rows = [(i, _edited(rng, words, 3), None, None) for i in range(600)] + [(1000 + i, " ".join(words), None, None) for i in range(300)]
    got, kept = _found(documents(spark, rows).repartition(5))
    assert len(got) == 1 and kept == {0: 1}


def test_messy_rows(messy, nothing):
    got, kept = _found(messy)
    by_id = {i: g for ids, g in got for i in ids}
    # One text but for white space, and with two words added: all linked.
    assert by_id["7"] == by_id["3"] == by_id["9"] == 3
    assert by_id["1"] == by_id["2"] == 1 and by_id["5"] == 5 and by_id["6"] == 6
    assert sum(len(ids) for ids, _ in got) == len(MESSY)
    assert near_duplicates(nothing).count() == 0


def test_one_document_of_each_group_stays(messy, nothing):
    rows = distinct_documents(messy)
    assert rows.columns == messy.columns
    kept = sorted(str(r["doc_id"]) for r in rows.collect())
    want = sorted(str(r["doc_id"]) for r in near_duplicates(messy).filter("kept").collect())
    assert kept == want and all(r[c] in (c, None) for r in rows.collect() for c in EXTRA)
    assert distinct_documents(nothing).count() == 0


@pytest.mark.parametrize("share", [0.3, 0.6, 0.8, 0.95])
def test_signatures_estimate_weighted_similarity(share):
    rng = random.Random(7)
    pairs = []
    for _ in range(40):
        words = [f"x{rng.randrange(50)}" for _ in range(rng.choice([20, 300]))] * rng.choice([1, 3])
        cut = int(len(words) * share)
        pairs += [" ".join(words), " ".join(words[:cut] + [f"y{rng.randrange(10**6)}" for _ in words[cut:]])]
    texts = pa.array(pairs)
    best = signatures(*shingles(*word_hashes(texts), 5), len(pairs), 96)
    assert np.isfinite(best).all()
    bags, fast = [_bag(t) for t in pairs], weighted_shingles(texts)
    truth = np.array([similarity(bags[i], bags[i + 1]) for i in range(0, len(pairs), 2)])
    assert [fast_similarity(fast[i], fast[i + 1]) for i in range(0, len(pairs), 2)] == pytest.approx(truth)
    different = np.unpackbits((sketches(best128(texts))[0::2] ^ sketches(best128(texts))[1::2]).view(np.uint8), axis=1).sum(axis=1)
    assert (different - 4 * 128 * (1 - truth)).mean() == pytest.approx(0, abs=12)
    assert (different[truth >= 0.8] <= MOST_DIFFERENT).all()
    seen = (best[0::2] == best[1::2]).mean(axis=1)
    assert (seen - truth).mean() == pytest.approx(0, abs=0.02)


def best128(texts):
    return signatures(*shingles(*word_hashes(texts), 5), len(texts), ROWS * BANDS)


def test_signature_does_not_depend_on_company():
    texts = ["a b c d e f g h", "", None, "a b c", "q " * 5000, "a b c d e f g h"]
    together = signatures(*shingles(*word_hashes(pa.array(texts)), 5), 6, ROWS * BANDS)
    for i, t in enumerate(texts):
        alone = signatures(*shingles(*word_hashes(pa.array([t], pa.string())), 5), 1, ROWS * BANDS)
        assert (alone[0] == together[i]).all()
    assert np.isinf(together[1]).all() and (together[0] == together[5]).all()
    assert (band_keys(together)[0] == band_keys(together)[5]).all()


def test_darts_at_short_texts_take_little_memory():
    """A text of one word has a thousand pieces for its cell, a text of many words a few for each."""
    texts = pa.array([f"w{i}" for i in range(4000)])
    found, doc = shingles(*word_hashes(texts), 5)
    tracemalloc.start()
    best = signatures(found, doc, len(texts), ROWS * BANDS)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.isfinite(best).all() and peak < 64 << 20


@pytest.mark.parametrize("thrown", [1, 700])
def test_throwing_darts_a_few_at_a_time_changes_nothing(monkeypatch, thrown):
    texts = pa.array(["a b c d e f g h", "", None, "a b c", "one", " ".join(f"x{i % 90}" for i in range(900))])
    together = signatures(*shingles(*word_hashes(texts), 5), 6, ROWS * BANDS)
    monkeypatch.setattr(near_dedup, "THROWN", thrown)
    assert (signatures(*shingles(*word_hashes(texts), 5), 6, ROWS * BANDS) == together).all()


def test_parities_differ_in_no_more_bits_than_runs():
    rng = random.Random(5)
    words = [f"p{rng.randrange(60)}" for _ in range(400)]
    texts = pa.array([_edited(rng, words, n) for n in (0, 1, 4, 15, 40, 150)] + [" ".join(words[:50] * 3), "one", ""])
    found, doc = shingles(*word_hashes(texts), 5)
    bits = np.unpackbits(parities(cells_of(found, doc), doc, len(texts)).view(np.uint8), axis=1)
    bags = [_bag(t) for t in texts.to_pylist()]
    for a in range(len(bags)):
        for b in range(len(bags)):
            only = sum(((bags[a] - bags[b]) + (bags[b] - bags[a])).values())
            assert only / 3 <= (bits[a] != bits[b]).sum() <= only


def test_pairs_of_a_crowded_bucket_that_are_too_far_apart_are_not_verified(spark, monkeypatch):
    """Edited copies of one text, most of them at 0.6 to 0.75 of one another, as near as sketches tell."""
    rng = random.Random(3)
    words = [f"e{i}" for i in range(150)]
    rows = [(i, _edited(rng, words, 5), None, None) for i in range(150)]
    tried = []

    def counted(pairs, *rest):
        tried.append(pairs.count())
        return verified(pairs, *rest)

    verified = near_dedup._verified
    monkeypatch.setattr(near_dedup, "_verified", counted)
    got, _ = _found(documents(spark, rows))
    links = sum(similarity(_bag(rows[i][1]), _bag(rows[j][1])) >= 0.8 for i in range(150) for j in range(i))
    assert got == _brute(rows) and len(got) > 1
    assert sum(tried) <= 2 * links + 150
