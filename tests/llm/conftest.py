import pytest

LONG = "alpha beta gamma delta " * 30_000


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls, empty and very long texts, repeated rows and columns named like the operators' own."""
    rows = [
        (1, None, None, None),
        (2, "", "en", "s"),
        (3, " \n\t ", "en", "s"),
        (4, "one two", "en", None),
        (5, LONG, "en", "s"),
        (6, "Ünïcode wörds ünd mehr \U0001f600 ß 日本語 text goes on and on for more than ten words", "de", "s"),
        (7, "the quick brown fox jumps over the lazy dog and runs far away from all of it", "en", "s"),
        (7, "the quick brown fox jumps over the lazy dog and runs far away from all of it", "en", "s"),
        (8, "THE QUICK brown fox jumps over the lazy dog and runs far away from all of it", "en", "s"),
        (9, "12345 ## $$ 99", None, "s"),
        (10, "one two", "en", "s"),
    ]
    kept = [(*r, i, f"x{i}", [i], True, i * 0.5, b"z", None) for i, r in enumerate(rows)]
    return spark.createDataFrame(kept, "doc_id long, text string, lang string, source string, n_words long, component_id string, `set` array<int>, kept boolean, score double, sig binary, `a.b` string")


@pytest.fixture(scope="session")
def none(messy):
    return messy.limit(0)
