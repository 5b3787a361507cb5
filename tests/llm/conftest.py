from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"

# no text, no word, one word, blanks of all kinds, quotes, non-ASCII, ties
TEXTS = [
    None,
    "",
    "  \n\t ",
    "one",
    "Two words",
    "the same line\nthe same line\nthe same line",
    "a b c d e f g h i j k l",
    'He said: "ÉCOLE" — naïve café,  non-breaking space İstanbul ß',
    "x" * 5_000,
    " ".join(f"w{i % 97}v{i % 89}" for i in range(20_000)),
]


@pytest.fixture(scope="session")
def odd_rows():
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)]
    rows += [(3, "one", "en", "s"), (3, "another text of this id", None, None)]  # ids again
    rows += [(None, "a b c d e f g h i j k l", "xx", None), (None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """Edge cases, with further columns that have names the operators use inside."""
    docs = spark.createDataFrame(
        odd_rows, "doc_id long, text string, lang string, source string"
    )
    return docs.selectExpr(
        "*",
        "1 AS fp",
        "2 AS n_words",
        "3 AS score",
        "4 AS covered",
        "5 AS core",
        "6 AS `at`",
        "7 AS y",
        "8 AS word",
        "9 AS spans",
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
