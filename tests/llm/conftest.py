import pytest

LONG = "word " * 30_000
LINE = "A line of more than forty characters that repeats itself here"


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs in every column, empty and very long texts, repeated rows, ties, and columns
    whose names the operators might use themselves."""
    rows = [
        (1, None, "en", "s", 1, 0.5, "x", 7),
        (2, "", "en", None, 0, 0.5, "x", 7),
        (3, "   \n\n\t ", None, "s", 5, None, None, None),
        (4, LONG, "en", "s", None, 0.5, "x", 7),
        (None, "A row without an id but with some words in it", "de", "s", 1, 0.5, "x", 7),
        (None, None, None, None, None, None, None, None),
        (6, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich 東京 🙂 ½", "de", "s", 1, 0.5, "x", 7),
        (7, "7 8 9 !!! ...", "fr", "s", 1, 0.5, "x", 7),
        *[(10 + k, f"{LINE}\n  {LINE.upper()} \nown line number {k}", "en", "s", 1, 0.5, "x", 7) for k in range(6)],
        (20, "the same row twice with enough words to make some shingles", "en", "s", 1, 0.5, "x", 7),
        (20, "the same row twice with enough words to make some shingles", "en", "s", 1, 0.5, "x", 7),
        (20, "the same id with another text of some more words to look at", "en", "s", 1, 0.5, "x", 7),
        (21, "a" * 5_000, "en", "s", 1, 0.5, "x", 7),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, key int"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
