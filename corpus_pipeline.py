"""A corpus pipeline: documents in, packed training sequences out. Each stage applies one operator.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``; the last returns the pieces
of what is left and their places in the sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkrecon.llm import exact_dedup, language, mixing, near_dedup, packing
from sparkrecon.sources.tables import written

# Bytes of text that the packing stage encodes at a time, beside what the workers keep of earlier stages.
TOGETHER = 2 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_readable(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be determined stay: those with a letter that some mixture of the
    learned languages explains."""
    return language.readable_documents(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text the one with the smallest id stays."""
    return exact_dedup.distinct_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return near_dedup.distinct_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the sources come near their target sizes."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token sequences of at most 4096 ids: where each piece lies."""
    return packing.pack(packing.cut_documents(docs, public_tokenizers.path("word_bpe_49k.json"), together=TOGETHER))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_readable),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

# The fitted, rounded and packed stages cannot be stated in SQL; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
