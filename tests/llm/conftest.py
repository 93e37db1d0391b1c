from __future__ import annotations

import pytest
from pyspark.sql import types as T

LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(30_000))
PROSE = " ".join(f"the w{i} of x{i * 7 % 89} and" for i in range(40))
# Missing ids, missing and empty texts, repeated rows, ties, a very long text.
ROWS = [
    (1, PROSE, "en", "a", 1),
    (1, PROSE, "en", "a", 1),
    (2, PROSE + " more", "en", "a", 2),
    (3, PROSE.replace(" ", "\n\t "), "en", None, 3),
    (4, None, None, None, None),
    (5, "", "en", "a", 0),
    (6, " \t\n", "en", "b", 3),
    (None, "no id here", None, "b", 10),
    (None, "no id here", None, "b", 10),
    (7, LONG, "de", "b", len(LONG)),
    (8, "same text", "fr", "", 9),
    (9, "same  text", "fr", "", 10),
    (10, "a b c d", "fr", "c", 7),
    (11, "A B C D", "fr", "c", 7),
    (12, "éè \U0001f600 naïve café  x", "fr", "c", 20),
    (5, "another text with the id of an empty one", "en", "a", 40),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Extra columns with names that operators use themselves.
CLASHING = ("size", "row", "digest", "words", "p", "part", "token", "component", "length", "label", "n_words", "kept")


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.withColumns({name: F.lit("x") for name in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], T._parse_datatype_string(SCHEMA))


@pytest.fixture(scope="session")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
