import pytest

LONG = "the quick brown fox jumps over a lazy dog while seven wizards mix potent jugs of liquor "


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in each column, empty and long texts, repeated rows, and columns with names used inside."""
    words = [f"w{k}" for k in range(60)]
    rows = [
        (1, " ".join(words), "en", "a", 1),
        (2, " ".join(words), "en", "a", 1),
        (2, " ".join(words), "en", "a", 1),
        (3, None, None, None, None),
        (4, "", "fr", "b", 0),
        (5, " \t\n ", "fr", "b", 4),
        (6, LONG * 3000, "en", "b", 1),
        (None, " ".join(words), None, "c", 1),
        (7, "one", "en", "c", 3),
        (8, "one", "en", "c", 3),
        (9, "!!! ??? ...", "de", "c", 9),
        (10, "pre " + " ".join(words[:40]) + " post", "en", "c", 1),
        (11, "é ü ñ 日本語 " + LONG, "de", "c", 1),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("row_id", "names", "slot", "bits", "maybe", "rest", "part", "key", "score", "component", "words", "place", "n_words"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    return frame


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")


def rows_of(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)
