"""Scanning CSV: missing-value spellings, numbers, row shapes, columns by name."""

import pytest
from conftest import records
from pyspark.sql import types as T

from sparkrecon.functions import calendar_date
from sparkrecon.schemas import SOURCE_SCHEMA
from sparkrecon.sources import load_csv, schema_diff

SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("note", T.StringType()),
    ]
)


def scan(spark, tmp_path, text, **options):
    path = tmp_path / "in.csv"
    path.write_text(text, encoding="utf-8")
    return load_csv(spark, str(path), SCHEMA, "test", **options)


@pytest.mark.parametrize("cell", ["", '""', "NA", "N/A", "n/a", "null", "NULL", "None", "nan", "#N/A"])
def test_missing_value_spellings(spark, tmp_path, cell):
    (row,) = records(scan(spark, tmp_path, f"id,amount,note\nA,1,{cell}\n"))
    assert row == {"id": "A", "amount": 1.0, "note": None}


def test_other_text_stays(spark, tmp_path):
    (row,) = records(scan(spark, tmp_path, "id,amount,note\n A ,1,-\n"))
    assert (row["id"], row["note"]) == (" A ", "-")


@pytest.mark.parametrize(
    ("cell", "value"),
    [
        ("1e3", 1000.0), (" 12 ", 12.0), (".5", 0.5), ("5.", 5.0), ("+5", 5.0), ("-2.5E-1", -0.25),
        ("12d", None), ("1.5f", None), ('"1,000"', None), ("1_000", None), ("0x10", None),
        ("1e400", None), ("-", None), ("abc", None), ("inf", None), ("", None),
    ],
)
def test_numbers(spark, tmp_path, cell, value):
    (row,) = records(scan(spark, tmp_path, f"id,amount,note\nA,{cell},x\n"))
    assert row["amount"] == value


def test_columns_by_name(spark, tmp_path):
    df = scan(spark, tmp_path, "note,extra,amount\nx,e,7\n")
    assert records(df) == [{"note": "x", "extra": "e", "amount": 7.0}]
    assert {tuple(r.values()) for r in records(schema_diff(df, SCHEMA, "test"))} == {
        ("test", "id", "missing"),
        ("test", "extra", "extra"),
    }


def test_row_shapes(spark, tmp_path):
    df = scan(spark, tmp_path, 'id,amount,note\nA,1\n\n   \nB,2,"he said ""hi"""\nC\n')
    assert records(df) == [
        {"id": "A", "amount": 1.0, "note": None},
        {"id": "B", "amount": 2.0, "note": 'he said "hi"'},
        {"id": "C", "amount": None, "note": None},
    ]


@pytest.mark.parametrize("row", ["A,1,x,y", "A,1,x,y,z", "A,1,x,", "A,1,x,,z", 'A,1,"x,y",z'])
def test_a_long_row_fails_the_query(spark, tmp_path, row):
    df = scan(spark, tmp_path, f"id,amount,note\nB,2,x\n{row}\n")
    for action in (df.count, df.select("note").collect, df.collect):
        with pytest.raises(Exception, match="more than 3 fields; its first field is A"):
            action()


def test_commas_inside_quotes_do_not_count(spark, tmp_path):
    df = scan(spark, tmp_path, 'id,amount,note\nA,"1,2,3,4"\nB,2,"a,b,c,d"\n')
    assert [r["note"] for r in records(df)] == [None, "a,b,c,d"]
    assert df.count() == 2


def test_a_folder_needs_one_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("id,amount,note\nA,1,x\n")
    (folder / "b.csv").write_text("id,amount,note\nB,2,y\n")
    assert load_csv(spark, str(folder), SCHEMA, "test").count() == 2
    (folder / "c.csv").write_text("id,note,amount\nC,z,3\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        load_csv(spark, str(folder), SCHEMA, "test").count()


def test_line_breaks_inside_quotes(spark, tmp_path):
    df = scan(spark, tmp_path, 'id,amount,note\nA,1,"two\nlines"\n', multiline=True)
    assert records(df) == [{"id": "A", "amount": 1.0, "note": "two\nlines"}]


def test_missing_file_names_the_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="Ledger: no file at"):
        load_csv(spark, str(tmp_path / "none.csv"), SCHEMA, "Ledger")


def test_empty_file(spark, tmp_path):
    with pytest.raises(ValueError, match="no header"):
        scan(spark, tmp_path, "")


def test_full_schema_has_two_number_kinds():
    assert len(SOURCE_SCHEMA) == 18
    numbers = [f.name for f in SOURCE_SCHEMA if isinstance(f.dataType, T.DoubleType)]
    assert numbers == ["debit_amount", "credit_amount", "exchange_rate"]


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2023-01-02", "2023-01-02"), ("2023-1-4", "2023-01-04"), ("2023/01/03", None),
        ("2023-02-30", None), ("2023-01-05 10:00", None), ("2023", None), (None, None),
    ],
)
def test_dates(spark, text, day):
    df = spark.createDataFrame([(text,)], "d STRING")
    (row,) = records(df.select(calendar_date(df, "d", "yyyy-M-d").cast("string").alias("d")))
    assert row["d"] == day


def test_a_header_with_a_dot(spark, tmp_path):
    """Column names may hold dots and backticks; they are names, not paths."""
    path = tmp_path / "dots.csv"
    path.write_text("a.b,transaction_id,we`ird,debit_amount\nx,T1,NA,5\n,T2,z,bad\n")
    df = load_csv(spark, str(path), SOURCE_SCHEMA, "dots")
    assert df.columns == ["a.b", "transaction_id", "we`ird", "debit_amount"]
    assert [tuple(r) for r in df.collect()] == [("x", "T1", None, 5.0), (None, "T2", "z", None)]
    path.write_text("a.b,c\n1,2,3\n")
    with pytest.raises(Exception, match="first field is 1"):
        load_csv(spark, str(path), SOURCE_SCHEMA, "dots").collect()
