import pytest
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows of (doc_id, text) or whole tuples as a documents table."""
    def make(rows):
        full = [
            r if len(r) == 5 else (*r, "en", "a", None if r[1] is None else len(r[1]))
            for r in rows
        ]
        return spark.createDataFrame(full, COLUMNS)
    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """NULLs in every column, empty, blank and very long texts, equal rows, equal ids,
    and columns whose names operators use themselves."""
    long_text = " ".join(f"w{i % 977} of{i % 31}" for i in range(30_000))
    rows = [
        (1, "", "en", "a", 0), (2, None, "en", "a", None), (3, " \n\t ", None, None, 4),
        (None, "no id at all, but words enough to speak of", "en", "b", 42),
        (None, None, None, None, None),
        (4, long_text, "en", "a", len(long_text)), (5, long_text, "en", "b", len(long_text)),
        (6, "twice the same row here", "de", "c", 23), (6, "twice the same row here", "de", "c", 23),
        (7, "one id", "en", "a", 6), (7, "another text with this id", "en", "a", 25),
    ]
    clashing = ("row", "size", "words", "hashes", "tag", "key", "n", "kept", "found", "node",
                "class", "place", "range", "start", "end", "score", "clean", "rule", "leaf", "a.b",
                "back`tick")
    return make_docs(rows).withColumns({c: F.lit(f"extra {c}") for c in clashing})
