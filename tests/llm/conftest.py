import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def docs(spark):
    """Rows of documents from (doc_id, text) pairs; the other columns are filled in."""
    def make(rows, extra=""):
        schema = "doc_id long, text string, lang string, source string, n_chars long" + extra
        return spark.createDataFrame(
            [(i, t, "en", "src0", None if t is None else len(t)) + tuple(more)
             for i, t, *more in rows], schema)
    return make
