"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the white space that separates words (space, tab, line feed, vertical tab, form feed,
# carriage return), as a character class shared by Java's, RE2's and Python's expressions.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def uniform(*parts: Column | str | int) -> Column:
    """A number in [0, 1) that depends on the parts only, so that a repeated task draws it again."""
    cols = [F.lit(p) if isinstance(p, int) else p for p in parts]
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) / F.lit(float(1 << 52))


def parts_for(rows: int, each: int, least: int = 1) -> int:
    """Number of partitions so that each holds about ``each`` rows."""
    return max(least, -(-rows // each))
