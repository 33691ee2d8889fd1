"""Fixtures of the training-data tests: hand-made awkward documents."""

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and wordless texts, repeated rows and ids,
    unusual spaces, and a very long text."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    rows = [
        (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen", "en", "a", 3),
        (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen", "en", "a", 3),
        (2, None, "en", "a", 0), (3, "", None, None, None), (4, " \t\n\x0b\f\r ", "en", "b", 7),
        (None, "no id here at all", "en", "b", 5), (5, "a b c d\x1ce é\U0001f600", "fr", None, 9),
        (6, long, "en", "a", len(long)), (7, long + " end", "en", "a", len(long) + 4),
        (8, "word", "en", "c", 4), (9, "same same same same same same same", "en", "c", 4),
        (10, "line one\nline one\n\n  \nline two\r\nline one", "en", "c", 4),
    ]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture()
def write(spark, tmp_path):
    """Writes tables into a folder that a query can read."""
    def put(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return put
