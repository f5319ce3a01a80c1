from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the quick brown fox and the lazy dog went to town. they saw a ship, and it was late."


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(doc_id, text) or (doc_id, text, lang, source) rows as documents."""
    full = [(r[0], r[1], *(r[2:] or ("en", "a")), None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows() -> list[tuple]:
    """NULLs in every column, empty and blank texts, a very long one, one very long word, repeated rows, a NULL doc_id twice."""
    return [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \t\n\x0b ", "en", None),
        (4, PROSE, "en", "a"),
        (4, PROSE, "en", "a"),
        (5, PROSE + " more", None, "a"),
        (6, "word " * 200_000, "en", "a"),
        (7, "x" * 300_000, "en", "b"),
        (None, PROSE, "en", "a"),
        (None, PROSE, "en", "a"),
        (8, "1" * 50_000 + " " + "1 " * 20_000, "xx", "b"),
        (9, "日本語のテキスト \U0001f600 é", "ja", "c"),
        (10, "a@" * 20_000, "en", "c"),
    ]


@pytest.fixture
def odd(spark: SparkSession) -> DataFrame:
    return documents(spark, odd_rows())


@pytest.fixture
def clashing(odd: DataFrame) -> DataFrame:
    """The same with more columns, named as what operators make."""
    names = "row score spans items longest n_words fingerprint component_id root kept language _text ids kind start x held_out".split()
    return odd.withColumns({name: F.lit("mine") for name in names})


@pytest.fixture
def nothing(odd: DataFrame) -> DataFrame:
    return odd.filter("false")
