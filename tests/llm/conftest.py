from __future__ import annotations

import pytest


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows, and an extra column that clashes."""
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))
    rows = [
        (1, "The same words stand here again and again, in one plain line of prose.", "en", "a", 70, 1.0),
        (2, "The same words stand here again and again, in one plain line of prose.", "en", "a", 70, 2.0),
        (2, "The same words stand here again and again, in one plain line of prose.", "en", "a", 70, 2.0),
        (3, None, None, None, None, None),
        (4, "", "de", "b", 0, 0.0),
        (5, long, "en", "b", len(long), 0.5),
        (6, " \n\t ", "fr", None, 4, 0.5),
        (7, "Größe 漢字 😀 ‮ İstanbul ſecret", "de", "c", 29, 0.5),
        (None, "no id, but a text of its own with some more words", "en", "c", 49, None),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double").repartition(3)


@pytest.fixture(scope="module")
def no_docs(odd_docs):
    return odd_docs.limit(0)
