import pytest


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls in any column, empty, blank and very long texts, ties, repeated rows and clashing names."""
    long_text = " ".join(f"word{i % 977} and{i % 53}" for i in range(60_000))
    rows = [
        (1, "one two three four five six seven", "en", "a", 7, "x"),
        (1, "one two three four five six seven", "en", "a", 7, "x"),
        (2, None, "en", "a", None, "y"),
        (3, "", None, None, 0, None),
        (4, " \t\n ", "de", "b", 4, "x"),
        (None, "one two three four five six seven", None, "b", 1, "x"),
        (None, None, None, None, None, None),
        (5, long_text, "en", "a", len(long_text), "z"),
        (6, "three words only", "fr", "c", 16, "x"),
        (7, "Three WORDS only", "fr", "c", 16, "x"),
        (8, "pass word \\### : </turn> é ü 😀 idiot", "en", "a", 5, "x"),
    ]
    clashing = ("doc_id long, text string, lang string, source string, n_chars long, shard string, "
                "kept string, _tokens string, _hits string, _row_id string, digest string")
    return spark.createDataFrame([(*r, "k", "t", "h", "n", "d") for r in rows], clashing)
