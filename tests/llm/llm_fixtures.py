import os

import pytest

SF_CHECK = os.environ.get("RXCAST_LLM_DATA", "/root/testdata/sf0.01")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, ids string"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows, and columns whose names the operators use as well."""
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [
        (0, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 1, None, None, None),
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 1, 0.5, True, "x"),
        (2, "THE quick brown fox jumps over the lazy dog again and again\nsecond line of this text here", None, None, None, None, None, None),
        (3, None, "en", "b", 0, None, None, None), (4, "", "en", "b", 0, None, None, None), (5, " \n\t ", "de", "b", 3, None, None, None),
        (6, long, "en", "c", len(long), None, None, None), (7, long + " tail", "en", "c", None, None, None, None),
        (8, "one", "fr", "", 3, None, None, None), (9, "two words", "fr", None, 9, None, None, None),
        (9, "two words", "fr", None, 9, None, None, None), (None, "no id here at all", "es", "a", None, None, None, None),
        (None, "no id here at all", "es", "a", None, None, None, None), (10, "é ü ñ 漢字 😀 <|endoftext|> end", "es", "c", 5, None, None, None),
        (11, "same line of words\nsame line of words\nsame line of words", "en", "a", 7, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (1, 1, 0), (2, 0, 1), (2, 1, 0), (None, 1, 1), (3, None, None), (6, 1, 0), (8, 0, 1)],
                                 "doc_id long, quality int, toxic int")
