from __future__ import annotations

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BASE = (
    "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the river bank "
    "and nobody in the village knows why the miller left his wheel turning all through the winter night alone"
)


def doc(key, text, source="a"):
    return (key, text, "en", source, None if text is None else len(text))


ROWS = [
    doc(1, BASE),
    doc(2, BASE),  # an exact copy
    doc(3, BASE + " again"),  # a near copy
    doc(4, None, None),
    doc(5, ""),
    doc(6, "Short."),
    doc(7, "\n".join(f"Line {k} of this text says something that no other line has said before, {k * k}." for k in range(30)), "b"),
    doc(8, "word " * 3000, "b"),  # one word, many times
    doc(8, "word " * 3000, "b"),  # a repeated row
    doc(9, "é" * 5000, "c"),  # one very long word
    doc(10, "Write to ann@example.com or call (456) 555-2186, host 10.1.2.3, card 4111 1111 1111 1111.\nEnd " * 3, "c"),
    doc(None, "A text whose id is null, with enough words to pass the rule of ten words or more.", "c"),
]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.createDataFrame(ROWS, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(documents):
    """Extra columns that bear names the operators use inside."""
    from pyspark.sql import functions as F

    names = ("id", "size", "digest", "node", "root", "rank", "share", "row", "tail", "__copy", "fingerprint", "part")
    return documents.select("*", *[F.lit(1).alias(n) for n in names])
