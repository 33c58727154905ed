import pytest

LONG = "lorem ipsum dolor " * 4000 + "#end"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, one id twice, clashing names."""
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [
        (1, "first " + passage + " tail one", "en", "s", 10), (2, "second " + passage + " tail two", "en", "s", 10),
        (3, None, None, None, None), (4, "", "en", "s", 0), (5, " \n\t ", "en", "s", 4), (6, LONG, "en", "s", 1),
        (7, "one", "en", "s", 3), (7, "one", "en", "s", 3), (8, "same id, text a " + passage, "en", "s", 3),
        (8, "same id, text b", "en", "s", 3), (None, "no id " + passage, "en", "s", 3), (9, passage + " " + passage, "en", "s", 1),
        (10, "call +1 (988) 555-2485 or a.b@c.de, 4041894974608795 at 10.0.0.255", "en", "s", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.selectExpr("*", "'x' AS copy", "1 AS home", "true AS toxic", "'y' AS carried", "2 AS length", "'z' AS spans")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
