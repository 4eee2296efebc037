"""CSV scan: text first, columns by name, tolerant numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import decimal_number, na_to_null, number
from ..schemas import number_columns

_LINE = "_irregular_line"


def load_csv(
    spark: SparkSession, path: str, schema: T.StructType, label: str, *, multiline: bool = False,
    decimals: Sequence[str] = (),
) -> DataFrame:
    """Read a CSV file, or a folder of them with the same header line.

    Every column is read as text under its header name, so neither column order nor extra columns
    matter; missing-value spellings become null and the number columns of ``schema`` are parsed.
    A row with too few fields is padded with nulls, a row with too many fails the query that
    reads it. ``multiline`` allows line breaks inside quotes, at the price of unsplittable files.
    Number columns named in ``decimals`` are parsed as DECIMAL(18,4), the others as doubles.
    """
    options = {"header": True, "escape": '"', "multiLine": multiline}
    try:
        header = spark.read.options(**options).csv(path).columns
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{label}: no file at {path}") from e
        raise
    if not header:
        raise ValueError(f"{label}: {path} has no header line")

    # The parser keeps the line of every row whose number of fields is not the header's. To see
    # that it has to parse all fields of the row, whichever columns are asked for.
    as_text = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _LINE]])
    options |= {"columnNameOfCorruptRecord": _LINE, "columnPruning": False}
    options |= {"enforceSchema": False}  # a file of the folder with another header is an error
    raw = spark.read.options(**options).schema(as_text).csv(path)
    return typed(_without_long_rows(raw, header, label), schema, decimals)


def _without_long_rows(raw: DataFrame, header: list[str], label: str) -> DataFrame:
    """Pass all rows on, but fail at one with more fields than the header."""
    unquoted = F.regexp_replace(_LINE, '"([^"]|"")*"', "")
    commas = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(",")))
    error = F.raise_error(
        F.concat(
            F.lit(f"{label}: a row has more than {len(header)} fields; its first field is "),
            F.coalesce(F.col(quoted(header[0])), F.lit("empty")),
        )
    )
    fine = F.when(F.col(_LINE).isNull() | (commas < len(header)), True)
    return raw.filter(fine.otherwise(error.cast("boolean"))).drop(_LINE)


def quoted(name: str) -> str:
    """A column name that may hold dots or backticks, as an expression."""
    return "`" + name.replace("`", "``") + "`"


def typed(df: DataFrame, schema: T.StructType, decimals: Sequence[str] = ()) -> DataFrame:
    """Null out missing-value spellings, then parse the number columns that are present."""
    text = df.select(
        *[
            (na_to_null(F.col(quoted(f.name))) if isinstance(f.dataType, T.StringType) else F.col(quoted(f.name)))
            .alias(f.name)
            for f in df.schema.fields
        ]
    )
    present = [c for c in number_columns(schema) if c in text.columns]
    return text.withColumns({c: (decimal_number if c in decimals else number)(text, c) for c in present})


def schema_diff(df: DataFrame, schema: T.StructType, dataset: str) -> DataFrame:
    """Rows (dataset, column, kind) for columns that are ``missing`` from or ``extra`` in ``df``."""
    have, want = set(df.columns), set(schema.names)
    rows = [(dataset, c, "missing") for c in sorted(want - have)]
    rows += [(dataset, c, "extra") for c in sorted(have - want)]
    return df.sparkSession.createDataFrame(rows, "dataset STRING, column STRING, kind STRING")
