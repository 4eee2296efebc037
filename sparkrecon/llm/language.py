"""Language ID by multilingual mixture inference.

Each language is a distribution over hashed byte trigrams of lower-cased text, counted over all
labelled training documents. A document is a mixture of languages: expectation-maximisation finds
the proportions under which its trigrams are likeliest. The set of languages is chosen by penalised
likelihood: the best single one first, and another one only if the gain in log-likelihood is above
``PENALTY`` times the logarithm of the number of trigrams.

The model has ``BUCKETS`` numbers per language and is all that is collected and sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, text_or_empty
from .tokens import slices, text_bytes

BUCKETS = 4096
SMOOTHING = 0.5
ROUNDS = 12
# Trigrams overlap, so their evidence counts about three times over: six times the usual half.
PENALTY = 3.0
UNDETERMINED = "und"
LETTER = r"\p{L}"
# Documents predicted together.
TOGETHER = 1000
# Documents and bytes of text worked on together where a model is learned or whole rows are passed on:
# arrays of documents x BUCKETS stay at 2 MB, beside rows that wait in the same worker.
FEW, FEW_BYTES = 128, 1 << 19

# Letters stay, every other ASCII byte separates words, bytes of other characters stay as they are.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """documents x BUCKETS: how often each hashed trigram occurs in each text."""
    data, offsets = text_bytes(texts)
    n = len(offsets) - 1
    if len(data) < 3:
        return np.zeros((n, BUCKETS), np.float32)
    folded = _FOLD[data]
    code = folded.astype(np.uint32)
    gram = code[:-2] | code[1:-1] << np.uint32(8) | code[2:] << np.uint32(16)
    bucket = (gram * np.uint32(2654435761) >> np.uint32(20)).astype(np.int64)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    # Within one document, and around a letter.
    use = (doc[:-2] == doc[2:]) & (folded[1:-1] != 32)
    counts = np.bincount(doc[:-2][use] * BUCKETS + bucket[use], minlength=n * BUCKETS)
    return counts.reshape(n, BUCKETS).astype(np.float32)


def _padded(text_col: str):
    """The text in lower case between two spaces, so that a word at either end has its trigrams."""
    return F.concat(F.lit(" "), F.lower(text_or_empty(text_col)), F.lit(" "))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, languages x BUCKETS probabilities) from all rows with a text and a language. The
    languages are ordered by the size of their training text, the largest first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text", FEW_BYTES):
                for at in range(0, part.num_rows, FEW):
                    some = part.slice(at, FEW)
                    counts = trigram_counts(some.column("text"))
                    names = np.array(some.column("lang").to_pylist(), object)
                    for name in set(names.tolist()):
                        held = totals.setdefault(name, np.zeros(BUCKETS))
                        held += counts[names == name].sum(axis=0, dtype=np.float64)
        for name, held in totals.items():
            seen = np.flatnonzero(held)
            yield pa.record_batch(
                [pa.array([name] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(held[seen].astype(np.int64))],
                names=["lang", "bucket", "n"],
            )

    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), _padded(text_col).alias("text")
    )
    found = labelled.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n")).collect()
    sizes: dict[str, int] = {}
    for name, _, n in found:
        sizes[name] = sizes.get(name, 0) + n
    languages = sorted(sizes, key=lambda name: (-sizes[name], name))
    counts = np.zeros((len(languages), BUCKETS))
    at = {name: i for i, name in enumerate(languages)}
    for name, bucket, n in found:
        counts[at[name], bucket] = n
    smooth = counts + SMOOTHING
    return languages, smooth / smooth.sum(axis=1, keepdims=True) if languages else counts


def _expect(counts: np.ndarray, probs: np.ndarray, mix: np.ndarray, rounds: int) -> np.ndarray:
    """Proportions after ``rounds`` of expectation-maximisation; languages at zero stay at zero. A
    document without a trigram keeps the proportions it had."""
    total = counts.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        new = mix * ((counts / (mix @ probs)) @ probs.T) / np.maximum(total, 1)
        mix = np.where(total > 0, new, mix)
    return mix


def _fit(counts: np.ndarray, probs: np.ndarray, mix: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", counts, np.log(mix @ probs))


def infer(counts: np.ndarray, probs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language, its proportion, number of languages) per row of ``counts``. Among equally likely
    languages the first one, that is, the one with the largest training text."""
    n, k = len(counts), len(probs)
    probs = probs.astype(np.float32)
    single = counts @ np.log(probs).T
    best = single.argmax(axis=1)
    level = single[np.arange(n), best].astype(np.float64)
    mix = _expect(counts, probs, np.full((n, k), 1 / k, np.float32), ROUNDS)
    chosen = np.zeros((n, k), np.float32)
    chosen[np.arange(n), best] = 1
    size = np.ones(n, np.int64)
    cost = PENALTY * np.log(np.maximum(counts.sum(axis=1), 2))
    rank = np.argsort(-mix, axis=1, kind="stable")
    for languages in range(2, k + 1):
        # Only documents that took every language so far, and have some of the next one.
        at = np.flatnonzero((size == languages - 1) & (mix[np.arange(n), rank[:, languages - 1]] > 0.01))
        if not len(at):
            break
        held = np.zeros((len(at), k), np.float32)
        np.put_along_axis(held, rank[at, :languages], np.take_along_axis(mix[at], rank[at, :languages], 1), 1)
        held = _expect(counts[at], probs, held / held.sum(axis=1, keepdims=True), ROUNDS // 2)
        gain = _fit(counts[at], probs, held)
        better = gain - level[at] > cost[at]
        took = at[better]
        chosen[took], level[took], size[took] = held[better], gain[better], languages
    language = chosen.argmax(axis=1)
    return language, np.clip(mix[np.arange(n), language], 0, 1), size


def predict(
    docs: DataFrame,
    languages: list[str],
    probs: np.ndarray,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, n_languages.

    Only the text is an input of the prediction. A text that is null or has no letter, and every text
    if no language was learned, is ``und`` with score 0. ``score`` is the share of the text that is
    in the predicted language.
    """
    model = docs.sparkSession.sparkContext.broadcast(probs)
    known = len(languages)

    @F.pandas_udf("struct<language:int,score:double,n_languages:int>")
    def inferred(texts):
        import pandas as pd

        found = []
        for part in slices(pa.record_batch([pa.array(texts, pa.string())], names=["text"]), "text"):
            for at in range(0, part.num_rows, TOGETHER):
                counts = trigram_counts(part.column("text").slice(at, TOGETHER))
                language, score, size = infer(counts, model.value)
                found.append(pd.DataFrame({"language": language, "score": score.astype(float), "n_languages": size}))
        return pd.concat(found) if found else pd.DataFrame({"language": [], "score": [], "n_languages": []})

    letters = F.coalesce(F.col(text_col), F.lit("")).rlike(LETTER) & F.lit(known > 0)
    rows = docs.select(F.col(id_col).alias("doc_id"), letters.alias("letters"), _padded(text_col).alias("text"))
    if not known:
        return rows.select(
            "doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).alias("n_languages")
        )
    names = F.array(*[F.lit(name) for name in languages])
    return rows.withColumn("found", inferred("text")).select(
        "doc_id",
        F.when(F.col("letters"), F.get(names, F.col("found.language"))).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(F.col("letters"), F.col("found.score")).otherwise(0.0).alias("score"),
        F.when(F.col("letters"), F.col("found.n_languages")).otherwise(0).alias("n_languages"),
    )


def held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1):
    return remainder(F.col(id_col), folds) == fold


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out (crc32 of the id modulo 3 is not 1), predict all:
    doc_id, held_out, lang_pred, score, n_languages. Null ids are texts of their own fold; repeated
    rows are predicted alike; an empty table gives no rows; other columns are not read."""
    languages, probs = learn(docs.filter(~held_out(id_col)), text_col, lang_col)
    found = predict(docs, languages, probs, id_col, text_col)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "n_languages")


def unlike_all(counts: np.ndarray, probs: np.ndarray) -> np.ndarray:
    """Per row of ``counts`` whether no mixture of the languages explains it: the likeliest mixture is less
    likely than trigrams drawn evenly from all buckets, by more than the penalty of one more language."""
    n, k = len(counts), len(probs)
    probs = probs.astype(np.float32)
    mix = _expect(counts, probs, np.full((n, k), 1 / k, np.float32), ROUNDS)
    total = counts.sum(axis=1)
    even = -total * np.log(BUCKETS)
    return even - _fit(counts, probs, mix) > PENALTY * np.log(np.maximum(total, 2))


def explained(texts: pa.Array, probs: np.ndarray) -> np.ndarray:
    """Per text whether some mixture of the languages explains it."""
    stay = [np.zeros(0, bool)]
    for at in range(0, len(texts), FEW):
        lowered = pc.utf8_lower(texts.slice(at, FEW))
        stay.append(~unlike_all(trigram_counts(pc.binary_join_element_wise(" ", lowered, " ", "")), probs))
    return np.concatenate(stay)


def readable_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without those whose language cannot be determined, all columns as they are: texts without
    a letter go, and texts that no mixture of the learned languages explains (``unlike_all``), such as
    encoded data or another language. Without a labelled text no language is known, and all texts with a
    letter stay. The model learns from all labelled rows. Rows are filtered where they are, in one pass."""
    languages, probs = learn(docs, text_col, lang_col)
    lettered = docs.filter(F.coalesce(F.col(text_col), F.lit("")).rlike(LETTER))
    if not languages:
        return lettered
    model = docs.sparkSession.sparkContext.broadcast(probs)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, FEW_BYTES):
                yield part.filter(pa.array(explained(part.column(text_col), model.value)))

    return lettered.mapInArrow(keep, docs.schema)
