import pytest

from tallyrill.llm.store import ship


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship(spark)


@pytest.fixture
def docs(spark):
    """Rows of documents from (doc_id, text); other columns are filled, some with clashing names."""

    def make(rows, **types):
        schema = "doc_id long, text string, lang string, source string, n_chars long, row string, key long, score string"
        return spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t), "x", 1, "y") for i, t in rows], schema)

    return make
