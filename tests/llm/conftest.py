from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession


@pytest.fixture(scope="session")
def odd_documents(spark: SparkSession) -> DataFrame:
    """Nulls, empty and long texts, ties, repeated rows, and columns named like those of the operators."""
    words = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, words, "en", 1),
        (1, words, "en", 1),
        (2, words, None, 2),
        (None, words, "en", None),
        (3, None, "en", 3),
        (4, "", None, 4),
        (5, " \n\t ", "en", 5),
        (6, "one", "en", 6),
        (7, "One", "en", 6),
        (8, " ".join(f"long{i % 997}x{i}" for i in range(60_000)), "en", 7),
        (9, words.replace("word30", "other"), "en", 8),
        (None, None, None, None),
    ]
    return spark.createDataFrame(
        [(*r, "a", "b", 0, 0.5, True) for r in rows],
        "doc_id long, text string, source string, n_chars long, node string, spans string, n_words int, score double, kept boolean",
    )


@pytest.fixture(scope="session")
def no_documents(odd_documents: DataFrame) -> DataFrame:
    return odd_documents.limit(0)
