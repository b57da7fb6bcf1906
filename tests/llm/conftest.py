import pytest


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and white-space texts, ties, repeated rows, a long text and clashing extra columns."""
    base = "the quick brown fox jumps over the lazy dog near the old stone bridge at dawn while seven small birds sing"
    rows = [
        (1, base, "en", "a"),
        (2, base.upper() + "!", "en", "a"),
        (2, base.upper() + "!", "en", "a"),
        (3, None, None, None),
        (4, "", "en", "b"),
        (5, " \t\n\r\x0b\x0c ", "en", "b"),
        (None, base, "en", None),
        (None, None, None, "c"),
        (6, "one", "en", "c"),
        (7, "one two", "en", "c"),
        (8, "été déjà vu ß # $ 5% <b>\nline\nline\n\nline", "fr", "b"),
        (9, "word " * 60_000, "en", "a"),
        (10, "x" * 100_000, "de", "a"),
    ]
    return spark.createDataFrame([(*r, 0, r[1], 9) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, node int")


@pytest.fixture(scope="session")
def edge_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (8, 0, 1), (9, 0, 0), (6, None, None), (None, 1, 1), (77, 1, 1)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
