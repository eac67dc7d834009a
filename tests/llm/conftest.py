import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from carelake.session import get_spark
    yield get_spark(master="local[4]", shuffle_partitions=4)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang, source]) rows; n_chars follows the text."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


def odd_rows(n=60):
    """Null, empty, blank, tiny and very long texts, repeated rows, null ids and columns."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    rows = [(i, f"plain text number {i} with some words " * (i % 4 + 1), "en", f"s{i % 3}") for i in range(n)]
    return rows + [(1000, None, "en", "s1"), (1001, "", None, None), (1002, " \t\n", "de", None), (1003, "x", "fr", "s0"),
                   (1004, long, "en", "s2"), (None, "a row without an id has words too", "en", "s1"),
                   (5, "plain text number 5 with some words " * 2, "en", "s2"),
                   (5, "plain text number 5 with some words " * 2, "en", "s2"), (1005, "ünï ©ode … 漢字 words", "en", "s0")]
