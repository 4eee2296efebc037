"""Rows that operators must take without a fault: nulls, empty and long texts, ties, repeated rows, and
columns with names that operators use themselves."""

import pytest

# Column names that operators use inside, or return.
EXTRA = ("kept", "row", "sha", "hash", "size", "target", "key", "again", "score", "held", "n", "length")
SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG" + "".join(f", {c} STRING" for c in EXTRA)
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(40_000))
SPELL = "the quick brown fox jumps over the lazy dog near the river bank while it rains all day"


def documents(spark, rows):
    """rows: (doc_id, text, lang, source); every other column is filled with its own name or null."""
    full = [(i, t, g, s, None if t is None else len(t), *[c if i else None for c in EXTRA]) for i, t, g, s in rows]
    return spark.createDataFrame(full, SCHEMA)


MESSY = [
    (7, SPELL, "en", "b"),
    (3, SPELL.replace(" ", "  \t"), "en", "a"),
    (9, SPELL + " and night", "en", None),
    (9, SPELL + " and night", "en", None),
    (None, SPELL + " again", None, "a"),
    (None, SPELL + " again", None, "a"),
    (1, None, "en", "b"),
    (2, "", None, "b"),
    (4, " \n\t ", "fr", "a"),
    (5, LONG, "en", "a"),
    (6, "one", "fr", "b"),
    (8, "é ß 漢字 \u00a0 x\u2003y <|endoftext|> it's 12", "fr", "c"),
    (-5, "1234 !!! ...", "fr", "c"),
]


def records(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="session")
def messy(spark):
    return documents(spark, MESSY).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [])
