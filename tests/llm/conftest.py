import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with an extra column whose name an operator might use."""

    def make(rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or ""), "x") for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, fp string")

    return make
