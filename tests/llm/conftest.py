import pytest

from parcelpulse.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
ODD_TEXTS = [
    None,
    "",
    " \t\n",
    "one two three",
    "ein Wort, über die Straße: été 日本 語 😀 " * 3,
    "word " * 5000,
    "a" * 20_000,
    "  two  blanks\n\n and a don't <|endoftext|> 1.2.3.4 x@y.zz token = \"0123456789abcdef0123\" ",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, equal ids, and a clashing extra column."""
    rows = [(k, t, "en", None if k % 3 else "s", 1, k) for k, t in enumerate(ODD_TEXTS)]
    rows += [rows[3], rows[3], (3, "another text with the id of a third", None, "s", None, 1)]
    rows += [(None, "no id here", None, None, None, None)] * 2
    schema = "doc_id long, text string, lang string, source string, n_chars long, row long"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def docs(spark):
    return table(spark, SF_DIR, "documents")


@pytest.fixture(scope="session")
def rows_of():
    def read(df, *columns):
        return [tuple(r) for r in df.select(*columns).collect()]

    return read
