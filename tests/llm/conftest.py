from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text) as a table of documents with columns whose names clash with results'."""

    def make(rows):
        wide = [(k, t, "en", "s", len(t or ""), 1, "x", -1.0) for k, t in rows]
        return spark.createDataFrame(
            wide, "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words int, labels string, score double"
        )

    return make
