from __future__ import annotations

import pytest

LONG = " ".join(f"word{k % 977} Tail{k % 31}," for k in range(30_000))
PLAIN = "the quick brown fox jumps over the lazy dog while seven wise owls watch from the old oak tree"
CLASHING = "mark string, fp bigint, s string, d string, host string, quality int, words string, kept string, _mark int"


@pytest.fixture(scope="session")
def edge_documents(spark):
    """NULLs, empty and very long texts, repeated rows and ids, and columns whose names operators use."""
    texts = [
        (None, None),
        (None, PLAIN),
        (1, ""),
        (2, " \n\t "),
        (3, LONG),
        (3, LONG),
        (4, PLAIN),
        (4, "another text under the same id"),
        (5, "é ▁   <0x41> 🙂\0 x"),
    ]
    rows = [(*x, "en", "src", None, "m", 7, "s", "d", "h", 1, "w", "k", 3) for x in texts]
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_documents(edge_documents):
    return edge_documents.limit(0)


def counted(rows) -> dict:
    """Rows as a multiset."""
    found: dict = {}
    for row in rows:
        found[tuple(row)] = found.get(tuple(row), 0) + 1
    return found


@pytest.fixture(scope="session")
def large():
    return "/root/testdata/sf0.1"
