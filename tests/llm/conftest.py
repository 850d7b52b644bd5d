import pytest
from llm_rows import EDGE, SF, prose


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows with a null id, and extra columns whose names clash."""
    rows = [(i, t, "en" if i % 2 else None, "s", 1, "x", "y", 7) for i, t in EDGE] + [(None, prose(200, 1), "en", None, None, None, None, None)]
    names = ["doc_id", "text", "lang", "source", "n_chars", "DOC_ID", "Text", "id"]
    return spark.createDataFrame(rows, "a long, b string, c string, d string, e long, f string, g string, h int").toDF(*names)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def small_rows(small):
    return [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect()]
