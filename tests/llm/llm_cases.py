import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, fingerprint string, "
          "component_id string, h1 string, pos string, score string, rank string, block string, label string")
LONG = "lorem ipsum dolor sit amet " * 40_000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated
    rows, columns whose names clash with those the operators use."""
    extra = ("x",) * 8
    rows = [(1, "The quick brown fox jumps over the lazy dog.", "en", "a", 44, *extra),
            (1, "The quick brown fox jumps over the lazy dog.", "en", "a", 44, *extra),
            (2, None, None, None, None, *(None,) * 8), (3, "", "en", "b", 0, *extra),
            (4, " \n\t ", "de", "c", 4, *extra), (None, "No id here, +1 (909) 555-6237.", "en", "d", 30, *extra),
            (None, None, None, None, None, *(None,) * 8), (5, "12345 !!! ???", "fr", "e", 13, *extra),
            (6, LONG, "la", "f", len(LONG), *extra), (7, "\u4f60\u597d \U0001f600 e\u0301\x1c\x00 \u03a3\u0391\u03a3", "zh", "g", 9, *extra),
            (8, "a" * 20_000, "en", "h", 20_000, *extra), (50, "quick brown fox", "en", "i", 15, *extra)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
