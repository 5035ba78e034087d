import itertools

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of (doc_id, text[, lang[, source]]) as a table of documents."""
    def made(rows, extra=""):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1]) if r[1] is not None else None, *r[4:]) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS + extra)
    return made


@pytest.fixture(scope="session")
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def odd(documents):
    """Nulls everywhere, empty and blank texts, a long one, repeated rows, and columns with clashing names."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (None, "one two three four five six", "en", "b"),
            (5, "one two three four five six", "en", "b"), (5, "one two three four five six", "en", "b"), (6, long, "de", None),
            (None, None, None, None), (7, "mail a@b.co or +1 (555) 123-4567 now", "fr", "c")]
    extra = ", size long, kept string, node string, key string, copies string, digest string, rank int"
    return documents([(*(r + (None,) * 4)[:4], n, "k", "n", None, "c", "d", n) for n, r in enumerate(rows)], extra)


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents([])


@pytest.fixture(scope="session")
def kept_table():
    from sampletide.llm.common import written
    return written


@pytest.fixture(scope="session")
def numbers():
    return itertools.count
