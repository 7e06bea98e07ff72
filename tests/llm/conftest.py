import duckdb  # noqa: F401 - the oracle's engine
import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Documents out of (id, text) pairs."""
    def make(rows, schema=DOC):
        return spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in rows], schema)
    return make


#: Null, empty, blank, very long, repeated and odd texts; null and repeated ids.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a b c"), (4, "a b c"), (None, "x y z"), (None, None), (5, "a b"), (6, "日本語 テスト 👩‍👩‍👧"),
       (7, "word " * 60_000), (8, "x" * 100_000), (9, "\x00\x1f​"), (10, "<|endoftext|> it's 'LL we'll\r\n  end  ")]


@pytest.fixture()
def odd():
    return list(ODD)
