"""What a run has done: its manifest, and the rows that its writes have counted.

A result is only as good as the inputs and rules it was made of. The reconciliation therefore ends by
writing a manifest with a fingerprint of both, and a later stage uses its detail only if the fingerprint
still fits. Rows are counted by the writes themselves (``DataFrame.observe``), so a report on a run needs
no scan of its own.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..params import Rules
from ..sources import write_table

# The clock of a run does not decide what its results are.
_CLOCK = ("as_of", "run_ts")


def files_digest(spark: SparkSession, path: str) -> list[str]:
    """Number, bytes and a digest of names, sizes and times of the files under ``path``, in any store that
    Spark reads. Spark lists them and adds them up; no content is read and no list comes to the driver."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        held = files.load(path).select("path", "length", "modificationTime")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no file at {path}") from e
        raise
    each = F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(38,0)")
    row = held.agg(F.count(F.lit(1)), F.sum("length"), F.sum(each)).first()
    return [str(v) for v in row]


def fingerprint(spark: SparkSession, source: str, target: str, fmt: str, rules: Rules) -> str:
    """Digest of the files of both inputs, how they are read, and the rules."""
    used = {f.name: repr(getattr(rules, f.name)) for f in dataclasses.fields(rules) if f.name not in _CLOCK}
    held = [files_digest(spark, source), files_digest(spark, target), fmt, sorted(used.items())]
    return hashlib.sha256(json.dumps(held).encode()).hexdigest()


class Run:
    """The record of a run in its folder: a table of a few rows per stage, replaced when the stage ends."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, stage: str) -> str:
        return f"{self.folder}/run_{stage}"

    def begin(self, stage: str) -> dict[str, str]:
        """Facts to be filled while a stage writes. Until it ends there is no record of the stage."""
        self._put(stage, {"state": "started"})
        return {}

    def end(self, stage: str, facts: dict[str, object]) -> None:
        self._put(stage, {"state": "complete"} | facts)

    def _put(self, stage: str, facts: dict[str, object]) -> None:
        rows = [(k, str(v)) for k, v in facts.items()]
        table = self.spark.createDataFrame(rows, "fact STRING, value STRING").coalesce(1)
        write_table(table, self._path(stage), "parquet")

    def facts(self, stage: str) -> dict[str, str]:
        """What a stage that ended has recorded; empty if it did not run or did not end."""
        try:
            rows = self.spark.read.schema("fact STRING, value STRING").parquet(self._path(stage)).collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        found = {r["fact"]: r["value"] for r in rows}
        return found if found.pop("state", None) == "complete" else {}


def write_counted(df: DataFrame, path: str, fmt: str = "csv", partition_by: str | None = None) -> int:
    """``write_table`` that tells the rows it wrote."""
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, fmt, partition_by)
    return seen.get["rows"]
