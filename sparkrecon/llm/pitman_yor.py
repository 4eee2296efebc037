"""Language-model scoring with a hierarchical Pitman-Yor model of words.

Every context (the word before) is a restaurant whose customers are the words that follow it in the
training text. All context restaurants share one parent, the restaurant without context: each of
their tables sends one customer there. Its parent is uniform over the known words and one unknown.
Each sweep draws anew at how many tables all customers of a word sit in each context (``seating``),
and a word's probability is the mean of the predictive probabilities of several samples.

How the work is laid out:

* The text is read once. Each block of documents becomes, per partition, packed arrays of its word
  pairs and of the documents they occur in. Pairs are dealt by context, so a restaurant is in one
  place; contexts that are a good part of the text (a short list, found on a sample, that steers the
  layout only) are dealt by pair, and their totals are added up.
* The shuffled blocks stay where Spark keeps shuffle files and are read again by each sweep; only
  numbers travel between sweeps: tables per word to the owner of the word, who seats them in the
  parent restaurant, and the word's counts back to the partitions that asked for it.
* Seats of a sweep are drawn with the parent's state of the sweep before, in all places at once.
* Random numbers depend on sweep and partition only and blocks are put in order first, so a task that
  is run again after a loss sends the same messages.

Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import RDD, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts_for, text_or_empty
from .seating import table_counts
from .words import mixed, word_hashes

BEGIN, END = np.uint64(0x1D8AF066C5E3A10B), np.uint64(0x5F3C9B72E4D18A67)
# Characters of text per block, bytes of text per partition.
BLOCK, PARTITION = 6 << 20, 12 << 20
# One document in so many looks for frequent contexts; one is frequent from this part of a partition.
SAMPLED, FREQUENT = 50, 0.25
CONCENTRATION = 1.0
BURN_IN, SAMPLES = 1, 2
# The side of messages that only the driver reads.
SUMS = 2


def _pack(value: object) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value, protocol=5))


def _unpack(data: bytes) -> object:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def _small(a: np.ndarray) -> np.ndarray:
    """Non-negative whole numbers in as few bytes as they need."""
    return a.astype(np.min_scalar_type(int(a.max(initial=0))))


def _deltas(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


def _same(key: int) -> int:
    return key


def _dealt(messages: RDD, parts: int, side: int = 0) -> RDD:
    """The messages in the partitions they are for, marked with a side. RDDs dealt alike can be united
    partition by partition, so one worker reads both sides straight from their shuffles. Sums among them
    are a side of their own, for the driver."""
    marked = messages.mapPartitions(lambda it: ((k, (SUMS if isinstance(v, Sums) else side, v)) for k, v in it))
    return marked.partitionBy(parts, _same)


def _told(dealt: RDD) -> Sums:
    """The sums among the messages, added up."""
    return dealt.mapPartitions(lambda it: (v for _, (side, v) in it if side == SUMS)).treeReduce(Sums.plus)


def _work(dealt: RDD, run) -> RDD:
    """``run`` over each partition's (messages of side 0, messages of side 1)."""

    def both(messages: Iterable[tuple[int, tuple[int, bytes]]]) -> Iterator:
        sides: tuple[list, list, list] = ([], [], [])
        for _, (side, message) in messages:
            sides[side].append(message)
        return run([sides[:SUMS]])

    return dealt.mapPartitions(both)


# -- reading the text -------------------------------------------------------------------------------


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, word, text) of every token: the words, then the end."""
    hashes, starts = word_hashes(texts, lower=True)
    word = np.insert(hashes, starts[1:], END)
    counts = np.diff(starts) + 1
    doc = np.repeat(np.arange(len(counts)), counts)
    context = np.concatenate([[BEGIN], word[:-1]]) if len(word) else word
    context[(np.cumsum(counts) - counts)] = BEGIN
    return context, word, doc


def _route(parts: int, heavy: np.ndarray):
    """Blocks of documents to messages per partition: packed pairs, and once the documents."""

    def route(rows: Iterable[tuple]) -> Iterator[tuple[int, bytes]]:
        block = TaskContext.get().partitionId() << 24
        held, size = [], 0
        for row in rows:
            held.append(row)
            size += len(row[2])
            if size >= BLOCK:
                yield from _messages(block, held, parts, heavy)
                block, held, size = block + 1, [], 0
        if held:
            yield from _messages(block, held, parts, heavy)

    return route


def _messages(block: int, rows: list[tuple], parts: int, heavy: np.ndarray) -> Iterator[tuple[int, bytes]]:
    ids, held = [r[0] for r in rows], np.array([r[1] for r in rows], bool)
    context, word, doc = _tokens(pa.array([r[2] for r in rows], pa.string()))
    to = mixed(context) % np.uint64(parts)
    if len(heavy):
        often = np.isin(context, heavy)
        to[often] = mixed(context[often] ^ mixed(word[often])) % np.uint64(parts)
    yield block % parts, _pack(("docs", block, ids, held, np.bincount(doc, minlength=len(ids))))
    # Numbers of two bytes are put in order without comparisons.
    to = to.astype(np.min_scalar_type(parts))
    order = np.argsort(to, kind="stable").astype(np.int32)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(to, minlength=parts))])
    for pid in np.flatnonzero(np.diff(bounds)):
        at = order[bounds[pid] : bounds[pid + 1]]
        yield int(pid), _pairs(block, context[at], word[at], doc[at], held)


def _pairs(block: int, context: np.ndarray, word: np.ndarray, doc: np.ndarray, held: np.ndarray) -> bytes:
    contexts, u = np.unique(context, return_inverse=True)
    words, w = np.unique(word, return_inverse=True)
    pair = u.astype(np.int64) * len(words) + w
    if len(contexts) * len(words) * len(held) < 1 << 62:
        pair, doc = np.divmod(np.sort(pair * len(held) + doc), len(held))  # pair and text as one number
    else:
        order = np.argsort(pair, kind="stable")  # texts stay in order within a pair
        pair, doc = pair[order], doc[order]
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    pair, times = pair[first], np.diff(np.append(first, len(doc)))
    return _pack(
        ("pairs", block, _deltas(contexts), _deltas(words), _small(_deltas(pair)), _small(times), _small(doc), np.packbits(~held))
    )


@dataclass
class Part:
    """The pairs of a partition: numbers of context and word, and training customers."""

    contexts: np.ndarray
    words: np.ndarray
    u: np.ndarray
    w: np.ndarray
    customers: np.ndarray
    docs: list = field(default_factory=list)
    # For scoring: per block (number, pairs, times, texts).
    blocks: list = field(default_factory=list)

    def per_word(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.w, values, len(self.words))

    def per_context(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.u, values, len(self.contexts))

    def owners(self, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """The words in the order of their owners, and where each owner's begin."""
        to = mixed(self.words + np.uint64(1)) % np.uint64(parts)
        to = to.astype(np.min_scalar_type(parts))
        return np.argsort(to, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(to, minlength=parts))])


def _load(messages: list[bytes], scoring: bool = False) -> Part:
    loaded = sorted((_unpack(m) for m in messages), key=lambda m: m[:2])
    docs = [m[1:] for m in loaded if m[0] == "docs"]
    blobs = [m for m in loaded if m[0] == "pairs"]
    none = np.zeros(0, np.uint64)
    context_lists = [np.cumsum(b[2], dtype=np.uint64) for b in blobs]
    word_lists = [np.cumsum(b[3], dtype=np.uint64) for b in blobs]
    contexts, cu = np.unique(np.concatenate([none, *context_lists]), return_inverse=True)
    words, cw = np.unique(np.concatenate([none, *word_lists]), return_inverse=True)
    keys, known, blocks, i, j = [], [], [], 0, 0
    for b, cs, ws in zip(blobs, context_lists, word_lists, strict=True):
        pair, times, texts = np.cumsum(b[4], dtype=np.int64), b[5].astype(np.int64), b[6]
        train = np.unpackbits(b[7]).astype(bool)
        keys.append(cu[i : i + len(cs)][pair // len(ws)] * len(words) + cw[j : j + len(ws)][pair % len(ws)])
        i, j = i + len(cs), j + len(ws)
        known.append(np.add.reduceat(train[texts].astype(np.int64), np.cumsum(times) - times))
        if scoring:
            blocks.append((b[1], times, texts))
    key, at = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_inverse=True)
    customers = np.bincount(at, np.concatenate([np.zeros(0), *known]), len(key)).astype(np.int64)
    width = max(1, len(words))
    part = Part(contexts, words, key // width, key % width, customers, docs)
    upto = 0
    for number, times, texts in blocks:
        part.blocks.append((number, at[upto : upto + len(times)], times, texts))
        upto += len(times)
    return part


# -- seating ----------------------------------------------------------------------------------------


def _pick(weight: np.ndarray, first: np.ndarray, group: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """One table per group, drawn by weight. Tables lie group by group; every group has one with weight."""
    with np.errstate(divide="ignore"):
        key = rng.standard_exponential(len(weight)) / np.maximum(weight, 0)
    hit = np.flatnonzero(key == np.minimum.reduceat(key, first)[group])
    return hit[np.unique(group[hit], return_index=True)[1]]


def seat(customers: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Seat the customers of each dish in turn: (group, size) of all tables, group by group.

    ``fresh`` is the weight of a new table. The first eight sit down one by one, later ones in small
    parties that choose together. The sweeps do not use this: ``table_counts`` is exact.
    """
    groups = np.flatnonzero(customers > 0)
    group, size = groups.copy(), np.ones(len(groups), np.int64)
    done_group, done_size = [], []
    seated, tables = np.ones(len(customers), np.int64), np.ones(len(customers), np.int64)
    while len(group):
        finished = seated[group] >= customers[group]
        done_group.append(group[finished])
        done_size.append(size[finished])
        group, size = group[~finished], size[~finished]
        if not len(group):
            break
        dishes, first, number = np.unique(group, return_index=True, return_inverse=True)
        party = np.minimum(np.maximum(1, seated[dishes] // 8), customers[dishes] - seated[dishes])
        alone = fresh[dishes] / (fresh[dishes] + seated[dishes] - discount * tables[dishes])
        new = rng.binomial(party, alone)
        size[_pick(size - discount, first, number, rng)] += party - new
        seated[dishes] += party
        tables[dishes] += new
        group = np.concatenate([group, np.repeat(dishes, new)])
        size = np.concatenate([size, np.ones(int(new.sum()), np.int64)])
        order = np.argsort(group, kind="stable")
        group, size = group[order], size[order]
    group, size = np.concatenate([groups[:0], *done_group]), np.concatenate([np.zeros(0, np.int64), *done_size])
    order = np.argsort(group, kind="stable")
    return group[order], size[order]


def gibbs(group: np.ndarray, size: np.ndarray, fresh: np.ndarray, discount: float, moves: int, rng: np.random.Generator):
    """``moves`` times, one customer of every dish with several leaves its table and sits down anew.
    The chain that ``table_counts`` is tested against; the sweeps do not use it."""
    total = np.bincount(group, size, len(fresh))
    several = total[group] > 1
    rest_group, rest_size = group[~several], size[~several]
    group, size = group[several], size[several].copy()
    for _ in range(moves if len(group) else 0):
        dishes, first, number = np.unique(group, return_index=True, return_inverse=True)
        size[_pick(size.astype(float), first, number, rng)] -= 1
        tables = np.bincount(number, size > 0)
        weight = total[dishes] - 1 - discount * tables
        new = rng.random(len(dishes)) * (fresh[dishes] + weight) < fresh[dishes]
        chosen = _pick(np.where(size > 0, size - discount, 0), first, number, rng)
        size[chosen[~new]] += 1
        group = np.concatenate([group, dishes[new]])
        size = np.concatenate([size, np.ones(int(new.sum()), np.int64)])
        alive = size > 0
        group, size = group[alive], size[alive]
        order = np.argsort(group, kind="stable")
        group, size = group[order], size[order]
    group, size = np.concatenate([rest_group, group]), np.concatenate([rest_size, size])
    order = np.argsort(group, kind="stable")
    return group[order], size[order]


# -- sums over all partitions -------------------------------------------------------------------------


@dataclass
class Sums:
    """Numbers added over partitions; ``heavy`` holds customers and tables of the split contexts."""

    tokens: int = 0
    vocabulary: int = 0
    pair_once: int = 0
    pair_twice: int = 0
    tables: int = 0
    once: int = 0
    twice: int = 0
    parent_tables: int = 0
    heavy: dict = field(default_factory=dict)

    def plus(self, other: Sums) -> Sums:
        heavy = dict(self.heavy)
        for k, (c, t) in other.heavy.items():
            mine = heavy.get(k, (0, 0))
            heavy[k] = (mine[0] + c, mine[1] + t)
        numbers = {k: v + getattr(other, k) for k, v in vars(self).items() if k != "heavy"}
        return Sums(**numbers, heavy=heavy)

    def discounts(self) -> tuple[float, float]:
        """Of the contexts and of their parent, from how many counts are one and two."""

        def of(once: int, twice: int) -> float:
            return min(0.95, max(0.05, once / (once + 2 * twice))) if once + twice else 0.5

        return of(self.pair_once, self.pair_twice), of(self.once, self.twice)


def _parent(sums: Sums, tables: np.ndarray, parent_tables: np.ndarray) -> np.ndarray:
    """The parent restaurant's predictive probability of words with these customers and tables."""
    discount = sums.discounts()[1]
    base = (CONCENTRATION + discount * sums.parent_tables) / (sums.vocabulary + 1)
    return (tables - discount * parent_tables + base) / (CONCENTRATION + sums.tables)


def _context(part: Part, tables: np.ndarray, sums: Sums) -> tuple[np.ndarray, np.ndarray]:
    """Customers and tables of each context, of the split ones over all partitions."""
    customers, seated = part.per_context(part.customers), part.per_context(tables)
    if sums.heavy:
        names = np.array(sorted(sums.heavy), np.uint64)
        totals = np.array([sums.heavy[int(n)] for n in names], float)
        at = np.flatnonzero(np.isin(part.contexts, names))
        customers[at], seated[at] = totals[np.searchsorted(names, part.contexts[at])].T
    return customers, seated


def _heavy_sums(part: Part, tables: np.ndarray, heavy: np.ndarray) -> dict:
    at = np.flatnonzero(np.isin(part.contexts, heavy))
    customers, seated = part.per_context(part.customers), part.per_context(tables)
    return {int(part.contexts[i]): (int(customers[i]), int(seated[i])) for i in at}


# -- the sweeps ---------------------------------------------------------------------------------------


@dataclass
class Inbox:
    """What a partition knows of its words after a sweep: training count, customers and tables in the
    parent restaurant, per sample; and the tables of its own pairs."""

    counts: np.ndarray
    tables: np.ndarray
    parent_tables: np.ndarray
    seated: np.ndarray | None
    samples: list


def _read_inbox(part: Part, messages: list[bytes], parts: int) -> Inbox:
    order, bounds = part.owners(parts)
    counts, tables, parent_tables = (np.zeros(len(part.words), np.int64) for _ in range(3))
    own: tuple = (None, [])
    for message in messages:
        kind, sender, *rest = _unpack(message)
        if kind == "own":
            own = rest[0]
        else:
            at = order[bounds[sender] : bounds[sender + 1]]
            counts[at], tables[at], parent_tables[at] = rest
    return Inbox(counts, tables, parent_tables, *own)


def _ask(parts: int, heavy: np.ndarray):
    """First pass: each partition tells the owners of its words how often they occur and, each pair
    at one table, how many customers they have in the parent restaurant."""

    def ask(pairs: Iterable[tuple[list[bytes], list[bytes]]]) -> Iterator[tuple[int, bytes]]:
        me = TaskContext.get().partitionId()
        for messages, _ in pairs:
            part = _load(messages)
            one = (part.customers > 0).astype(np.int64)
            counts, tables = part.per_word(part.customers).astype(np.int64), part.per_word(one).astype(np.int64)
            order, bounds = part.owners(parts)
            for to in np.flatnonzero(np.diff(bounds)):
                at = order[bounds[to] : bounds[to + 1]]
                yield int(to), _pack(("words", me, _deltas(part.words[at]), _small(counts[at]), _small(tables[at])))
            sums = Sums(
                pair_once=int((part.customers == 1).sum()), pair_twice=int((part.customers == 2).sum()),
                heavy=_heavy_sums(part, one, heavy),
            )
            yield me, _pack(("own", me, (None, []), sums))

    return ask


def _owner(asked: list[bytes], sent: list[bytes], sums: Sums | None, seed: int):
    """The owner's view: its words, their counts, customers and tables, per sender its words, and what
    was sent along. Before the first sums are known every word has one table."""
    first = [_unpack(m) for m in asked]
    loaded = sorted((m for m in first if m[0] == "words"), key=lambda m: m[1])
    # Before the first sweep nothing was sent but what was asked.
    extra = [_unpack(m) for m in sent] or first
    lists = [np.cumsum(m[2], dtype=np.uint64) for m in loaded]
    words, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *lists]), return_inverse=True)
    later = {m[1]: m[2] for m in extra if m[0] == "tables"}
    counts = np.bincount(at, np.concatenate([np.zeros(0), *[m[3] for m in loaded]]), len(words)).astype(np.int64)
    tables = np.bincount(
        at, np.concatenate([np.zeros(0), *[later.get(m[1], m[4]) for m in loaded]]), len(words)
    ).astype(np.int64)
    parent_tables = (tables > 0).astype(np.int64)
    if sums is not None:
        discount = sums.discounts()[1]
        base = (CONCENTRATION + discount * sums.parent_tables) / (sums.vocabulary + 1)
        rng = np.random.default_rng([seed, TaskContext.get().partitionId(), 1])
        parent_tables = table_counts(tables, np.full(len(words), base), discount, rng)
    per_sender = dict(zip([m[1] for m in loaded], np.split(at, np.cumsum([len(x) for x in lists])[:-1]), strict=True)) if loaded else {}
    return counts, tables, parent_tables, per_sender, [m for m in extra if m[0] == "own"]


def _owned(counts: np.ndarray, tables: np.ndarray, parent_tables: np.ndarray, own: list) -> Sums:
    found = Sums(
        tokens=int(counts.sum()), vocabulary=int((counts > 0).sum()), tables=int(tables.sum()),
        once=int((tables == 1).sum()), twice=int((tables == 2).sum()), parent_tables=int(parent_tables.sum()),
    )
    for message in own:
        found = found.plus(message[3])
    return found


def _first_sums(pairs: Iterable[tuple[list[bytes], list[bytes]]]) -> Iterator[Sums]:
    for asked, sent in pairs:
        counts, tables, parent_tables, _, own = _owner(asked, sent, None, 0)
        yield _owned(counts, tables, parent_tables, own)


def _reply(sums: Sums, seed: int):
    """The owner's answers to the partitions that asked for its words; their own state goes back too, and
    with it the sums, so that the parent's tables are drawn once a turn."""

    def reply(pairs: Iterable[tuple[list[bytes], list[bytes]]]) -> Iterator[tuple[int, bytes | Sums]]:
        me = TaskContext.get().partitionId()
        for asked, sent in pairs:
            counts, tables, parent_tables, per_sender, own = _owner(asked, sent, sums, seed)
            for sender, at in per_sender.items():
                yield sender, _pack(("words", me, _small(counts[at]), _small(tables[at]), _small(parent_tables[at])))
            for message in own:
                yield me, _pack(("own", me, message[2]))
            yield me, _owned(counts, tables, parent_tables, own)

    return reply


def _sweep(parts: int, heavy: np.ndarray, sums: Sums, seed: int, keep: bool):
    """All customers of every context restaurant sit down anew, given the parent's probabilities of the
    sweep before. With ``keep`` the seating before that is remembered as a sample, with its parent's numbers."""

    def sweep(pairs: Iterable[tuple[list[bytes], list[bytes]]]) -> Iterator[tuple[int, bytes]]:
        me = TaskContext.get().partitionId()
        for messages, inbox in pairs:
            part = _load(messages)
            known = _read_inbox(part, inbox, parts)
            discount = sums.discounts()[0]
            rng = np.random.default_rng([seed, me, 0])
            before = _tables(part, known)
            samples = [*known.samples, _sample(known, before, sums)] if keep else known.samples
            _, seated = _context(part, before, sums)
            fresh = (CONCENTRATION + discount * seated[part.u]) * _parent(sums, known.tables, known.parent_tables)[part.w]
            tables = table_counts(part.customers, fresh, discount, rng)
            per_word = part.per_word(tables).astype(np.int64)
            order, bounds = part.owners(parts)
            for to in np.flatnonzero(np.diff(bounds)):
                yield int(to), _pack(("tables", me, _small(per_word[order[bounds[to] : bounds[to + 1]]])))
            found = Sums(
                pair_once=int((part.customers == 1).sum()), pair_twice=int((part.customers == 2).sum()),
                heavy=_heavy_sums(part, tables, heavy),
            )
            yield me, _pack(("own", me, (_small(tables), samples), found))

    return sweep


def _tables(part: Part, known: Inbox) -> np.ndarray:
    return (part.customers > 0).astype(np.int64) if known.seated is None else known.seated.astype(np.int64)


def _sample(known: Inbox, tables: np.ndarray, sums: Sums) -> tuple:
    return _small(tables), _small(known.tables), _small(known.parent_tables), sums


def _predict(part: Part, sample: tuple) -> np.ndarray:
    """The probability of each pair's word in its context, under one sample."""
    tables, word_tables, word_parents, sums = sample
    discount = sums.discounts()[0]
    tables = tables.astype(np.int64)
    customers, seated = _context(part, tables, sums)
    parent = _parent(sums, word_tables.astype(float), word_parents.astype(float))[part.w]
    backed = (CONCENTRATION + discount * seated[part.u]) * parent
    return (part.customers - discount * tables + backed) / (CONCENTRATION + customers[part.u])


def _score(parts: int, sums: Sums):
    """Last pass: each pair's mean probability over the samples, added up per document."""

    def score(pairs: Iterable[tuple[list[bytes], list[bytes]]]) -> Iterator[tuple[int, bytes]]:
        for messages, inbox in pairs:
            part = _load(messages, scoring=True)
            known = _read_inbox(part, inbox, parts)
            samples = [*known.samples, _sample(known, _tables(part, known), sums)]
            mean = sum(_predict(part, s) for s in samples) / len(samples)
            log_mean = np.log10(mean)
            count = known.counts[part.w]
            log_base = np.log10((count + 1) / (sums.tokens + sums.vocabulary + 1))
            for number, at, times, texts in part.blocks:
                at = np.repeat(at, times)
                there, doc = np.unique(texts, return_inverse=True)
                found = [np.bincount(doc, x[at], len(there)) for x in (log_mean, log_base, (count > 0).astype(np.int64))]
                yield number % parts, _pack(("sums", number, there, *found))
            for number, *docs in part.docs:
                yield number % parts, _pack(("docs", number, *docs))

    return score


def _finish(train_tokens: int):
    def finish(pairs: Iterable[tuple[list[bytes], list[bytes]]]) -> Iterator[tuple]:
        for messages, _ in pairs:
            loaded = sorted((m for m in map(_unpack, messages)), key=lambda m: m[:2])
            of: dict[int, list] = {}
            for _, number, ids, held, n in (m for m in loaded if m[0] == "docs"):
                of[number] = [ids, held, n, np.zeros((3, len(ids)))]
            for _, number, there, *found in (m for m in loaded if m[0] == "sums"):
                of[number][3][:, there] += found
            for ids, held, n, (score, base, known) in of.values():
                for row in zip(ids, held.tolist(), n.tolist(), known.tolist(), base.tolist(), score.tolist(), strict=True):
                    yield row[0], row[1], row[2], int(row[3]), train_tokens, row[4], row[5]

    return finish


def frequent_contexts(docs: DataFrame, parts: int) -> np.ndarray:
    """Words that are a good part of a partition, from one document in ``SAMPLED`` (all columns: text).
    It decides where pairs go, never what is counted; a word it misses makes a partition fuller. The
    beginning, a context of every text, is always among them, whatever the sample holds."""

    def count(rows: Iterable[tuple]) -> Iterator[tuple[int, int]]:
        found: dict[int, int] = {}
        for texts in _chunks((r[0] for r in rows), BLOCK):
            words, n = np.unique(word_hashes(pa.array(texts, pa.string()), lower=True)[0], return_counts=True)
            most = n >= n.sum() * FREQUENT / parts / 2
            for w, c in [(-1, int(n.sum())), *zip(words[most].tolist(), n[most].tolist(), strict=True)]:
                found[w] = found.get(w, 0) + c
        yield from found.items()

    sample = docs.filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0)
    rows = dict(sample.rdd.mapPartitions(count).reduceByKey(lambda a, b: a + b).collect())
    total = rows.pop(-1, 0)
    found = np.array([w for w, n in rows.items() if n >= total * FREQUENT / parts], np.uint64)
    return np.sort(np.append(found, BEGIN))


def _chunks(texts: Iterable[str], most: int) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def score_documents(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    burn_in: int = BURN_IN,
    samples: int = SAMPLES,
    partition_bytes: int = PARTITION,
    seed: int = 11,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows that are not ``held_out`` (null counts as not). Tokens are the words
    with A-Z in lower case, then one end; a null text is just the end. ``n_known`` counts tokens that
    occur in training. ``base_score`` is the log10 probability under add-one word frequencies and
    ``score`` under the model: the mean predictive probability over ``samples`` seatings, taken after
    ``burn_in`` sweeps. Ids may be null or repeat. Without training text every word is unknown; an
    empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    read = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"), text_or_empty(text_col).alias("text")
    )
    size = read.agg(F.sum(F.octet_length("text")).cast("long")).first()[0] or 0
    parts = parts_for(size, partition_bytes)
    heavy = frequent_contexts(read.select("text"), parts) if parts > 1 else np.zeros(0, np.uint64)
    blocks = _dealt(read.rdd.mapPartitions(_route(parts, heavy)), parts)
    asked = _dealt(_work(blocks, _ask(parts, heavy)), parts)
    # The first numbers only need what was asked; each further round needs its own messages.
    view, state = asked, None
    sums = _work(view, _first_sums).treeReduce(Sums.plus)
    for turn in range(burn_in + samples):
        replies = _dealt(_work(view, _reply(sums, seed + turn)), parts, 1)
        state, sums = blocks.union(replies), _told(replies)
        if turn == burn_in + samples - 1:
            break
        messages = _work(state, _sweep(parts, heavy, sums, seed + turn, keep=turn >= burn_in))
        view = asked.union(_dealt(messages, parts, 1))
    scored = _work(_dealt(_work(state, _score(parts, sums)), parts), _finish(sums.tokens))
    kind = read.schema["doc_id"].dataType.simpleString()
    return spark.createDataFrame(
        scored,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def perplexity(scored: DataFrame) -> DataFrame:
    """Per value of held_out: tokens, and perplexity of the model and of the word frequencies."""

    def of(score: str) -> Column:
        return F.pow(F.lit(10.0), -F.sum(score) / F.sum("n_tokens"))

    return scored.groupBy("held_out").agg(
        F.sum("n_tokens").alias("tokens"), of("score").alias("perplexity"), of("base_score").alias("base_perplexity")
    )
