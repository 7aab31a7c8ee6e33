import pytest

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
PARAGRAPH = " ".join(f"paragraph{i} of shared text" for i in range(12))

#: doc_id, text, lang, source: nulls, empty and long texts, ties and repeated rows.
EDGE_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again until it rests.", "en", "a"),
    (2, None, "en", "a"), (3, "", None, "b"), (4, " \t\n ", "fr", None), (None, "no name at all", None, None), (5, LONG, "en", "b"),
    (6, "7 8 9 10 11", "en", "c"), (7, PARAGRAPH, "en", "a"), (7, PARAGRAPH, "en", "a"), (8, "x " + PARAGRAPH, "en", "b"),
    (9, "a" * 3000, "en", "c"), (10, "été déjà ñandú " * 40, "fr", "d"), (10, "another text under one id", "en", "d"), (None, None, None, None),
]


@pytest.fixture(scope="session")
def edge_rows():
    return EDGE_ROWS


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The edge rows with further columns, named like what operators add."""
    rows = [(*r, 1.5, "k", 3, [1], None) for r in EDGE_ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, kept string, size int, items array<int>, `_key` string")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
