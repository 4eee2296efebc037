"""One query per operator over the whole tables of a folder, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    embeddings,
    exact_dedup,
    filter_audit,
    language,
    merkle,
    mixing,
    near_dedup,
    neighbours,
    packing,
    pitman_yor,
    reputation,
    token_counts,
    token_files,
)
from .common import remainder, table
from .tokens import vocabulary_size

Query = Callable[[SparkSession, str], DataFrame]


def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 7) == 2
    return pitman_yor.score_documents(table(spark, sf_dir, "documents"), held_out)


def op2_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.cut_documents(table(spark, sf_dir, "documents"), path)
    return packing.pack(pieces)


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op4_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op5_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` says nothing about pages (their texts are other ones than the documents of their ids),
    so what is known of hosts are the pages that a rule decides."""
    judged = reputation.judge(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op7_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = token_files.token_folder(spark)
    documents = table(spark, sf_dir, "documents")
    files = token_files.write_token_files(documents, path, folder, vocabulary_size(path))
    return token_files.read_token_files(spark, files)


def op9_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_neighbour_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_pitman_yor": op1_pitman_yor,
    "op2_pattern_packing": op2_pattern_packing,
    "op3_language_mixture": op3_language_mixture,
    "op4_pivotal_mix": op4_pivotal_mix,
    "op5_host_reputation": op5_host_reputation,
    "op6_token_counts": op6_token_counts,
    "op7_dart_minhash": op7_dart_minhash,
    "op8_token_files": op8_token_files,
    "op9_metric_join": op9_metric_join,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_neighbour_forest": op12_neighbour_forest,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op5_host_reputation": reputation.ORACLE,
    "op9_metric_join": embeddings.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
