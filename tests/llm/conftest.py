import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, fp string, place string, score string, key string"


@pytest.fixture(scope="session")
def odd(spark):
    """Null and repeated ids and texts, empty and long texts, and columns whose names the operators use inside."""
    same = "one two three four five six seven eight nine ten " * 3
    texts = [(1, None), (2, ""), (3, "   \n "), (4, same), (5, same), (5, same), (5, "other words " * 4), (None, same), (None, None), (6, "x" * 70_000), (7, "a\0b ▁ é\n1234 !!"), (8, "word " * 3000)]
    rows = [(i, t, "en" if t else None, "s", len(t) if t is not None else None, "h", "f", "p", "s", "k") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
