import re

import pytest

LONG = "lorem ipsum dolor " * 20000
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_words(text):
    """Contract words: lower-case A-Z, then letters, digits and non-ASCII characters."""
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and
    extra columns whose names operators use inside."""
    rows = [(0, "the cat sat on the mat today", "en", "a", 28), (1, None, None, None, None), (2, "", "en", "a", 0),
            (3, LONG, "en", "b", len(LONG)), (4, LONG, "en", "b", len(LONG)), (0, "the cat sat on the mat today", "en", "a", 28),
            (None, "no id here but some words", "en", "a", 25), (6, " \t\n", "fr", "a", 3), (7, "Été \U0001f600 x", "fr", None, 7),
            (8, "!!! ???", "en", "a", 7), (9, "the cat  sat on the mat today", "en", "a", 29)]
    names = ["rid", "row", "key", "shard", "score", "size", "rank", "grp", "piece", "kept", "class_id", "h", "bits"]
    extra = [f"x{n}" for n, _ in enumerate(names)]
    return spark.createDataFrame([(*r, *extra) for r in rows], DOCS + ", " + ", ".join(f"`{n}` string" for n in names))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
