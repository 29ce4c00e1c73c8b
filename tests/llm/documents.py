"""A fixture that makes documents."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) or longer rows, with columns that clash with the
    operators' own names."""

    def make(rows, parts=3):
        full = [(r + (None,) * 5)[:5] for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(parts) if full else spark.createDataFrame([], SCHEMA)
        return df.selectExpr("*", "1 AS rep", "2 AS keep_id", "'x' AS label", "3 AS _text", "4 AS length", "5 AS score", "6 AS words", "7 AS n")

    return make
