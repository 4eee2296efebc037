"""Token counts by the whole-token shortcut.

Before the job, each string of the vocabulary is encoded alone: those that come back as one token are
proven whole. In the texts, a pre-token that is proven whole counts one without being merged; only
the rest go through the tokenizer's merges, each distinct one once while it is remembered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .tokens import PieceEncoder, library_encoder, slices

# Characters whose class every Unicode version since 6 agrees on: ASCII and the Latin letters. Pieces
# with others, or with what may be a special string, are left to the library as a whole.
_PLAIN = r"[\x00-\x7E¡-ɏ]*"


def whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings that the tokenizer encodes, alone, as exactly one token."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    strings = [tokenizer.decode([i], skip_special_tokens=False) for i in range(tokenizer.get_vocab_size())]
    strings = [s for s in dict.fromkeys(strings) if s and "�" not in s and s not in special]
    found = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
    return frozenset(
        s
        for s, e in zip(strings, found, strict=True)
        if len(e.ids) == 1 and len(tokenizer.pre_tokenizer.pre_tokenize_str(s)) == 1
    )


class ShortcutCounter:
    """Numbers of tokens per piece of text, as lists so that ``PieceEncoder`` can keep them."""

    def __init__(self, path: str, pattern: str, whole: frozenset[str]):
        import regex

        self._whole, self._library = whole, library_encoder(path)
        self._pattern, self._plain = regex.compile(pattern), regex.compile(_PLAIN)
        self.direct = self.merged = 0

    def __call__(self, texts: list[str]) -> list[list[int]]:
        counts = [0] * len(texts)
        rest: dict[str, list[int]] = {}
        for i, text in enumerate(texts):
            if "<|" in text or not self._plain.fullmatch(text):
                rest.setdefault(text, []).append(i)
                continue
            for token in self._pattern.findall(text):
                if token in self._whole:
                    counts[i] += 1
                    self.direct += 1
                else:
                    rest.setdefault(token, []).append(i)
        merged = self._library(list(rest)) if rest else []
        self.merged += len(rest)
        for ids, places in zip(merged, rest.values(), strict=True):
            for i in places:
                counts[i] += len(ids)
        return [[c] for c in counts]


_counters: dict = {}


def token_counts(
    docs: DataFrame,
    path: str,
    pattern: str,
    limit: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    ``path`` is a tokenizers .json file and ``pattern`` the expression that cuts its pre-tokens. A
    null text is an empty one with no tokens; ids may be null or repeat; an empty table gives no rows;
    other columns are not read. The list of proven strings is no larger than the vocabulary.
    """
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (path, pattern)
        if key not in _counters:
            _counters[key] = PieceEncoder(ShortcutCounter(path, pattern, whole.value))
        for batch in batches:
            for part in slices(batch, "text"):
                # Per piece the "ids" are its one count; per text they are added up.
                counts, pieces = _counters[key].encode(part.column("text"))
                upto = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                ends = np.concatenate([[0], np.cumsum(pieces)])
                yield pa.record_batch(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(upto[ends[1:]] - upto[ends[:-1]])],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    read = docs.select(
        F.col(id_col).alias("doc_id"), F.octet_length(text_or_empty(text_col)).cast("long").alias("n_bytes"),
        text_or_empty(text_col).alias("text"),
    )
    kind = read.schema["doc_id"].dataType.simpleString()
    counted = read.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
