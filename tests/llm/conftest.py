from __future__ import annotations

import pytest

from txlake.llm.working import ship_package

DOCS = "doc_id long, text string, lang string, chunk string"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty texts, repeated rows, ties and a column with a clashing name."""
    words = " ".join(f"w{k}" for k in range(70))
    rows = [
        (1, words + ".\nA second line ends here.", "en", "x"),
        (2, words + ".\nA second line ends here.", None, None),
        (3, words.replace("w9 ", "v9 ") + ".\nA second line ends here.", "en", "x"),
        (3, words.replace("w9 ", "v9 ") + ".\nA second line ends here.", "en", "x"),
        (4, None, "en", "x"),
        (5, "", "en", "x"),
        (None, "no id", "en", "x"),
        (6, "word " * 30_000, "en", "x"),
        (7, "\0\x1c  a\n\n \u3000é", "en", "x"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
