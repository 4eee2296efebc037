"""Writing results, reading inputs, and tables kept in the shared folder between two jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .csv_files import load_csv, typed


def load_table(
    spark: SparkSession, path: str, schema: T.StructType, label: str, fmt: str = "csv", decimals: Sequence[str] = ()
) -> DataFrame:
    """Input from CSV, or from a columnar format (parquet, orc) whose scan prunes and pushes down."""
    if fmt == "csv":
        return load_csv(spark, path, schema, label, decimals=decimals)
    return typed(spark.read.format(fmt).load(path), schema, decimals)


def write_table(df: DataFrame, path: str, fmt: str = "csv", partition_by: str | None = None) -> None:
    """Overwrite ``path`` with ``df``; CSV gets a header line in every part file."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, escape='"')
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is made, but only on a local master: on a
    cluster the other machines could not read it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        folder = tempfile.mkdtemp(prefix="sparkrecon-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage to recompute and its true size is known to the optimizer, which
    then broadcasts it only if it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
