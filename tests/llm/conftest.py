from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """A documents table with awkward extra columns from (doc_id, text) pairs."""

    def build(*rows: tuple, lang: str = "en"):
        return spark.createDataFrame([(d, t, lang, "s", len(t or ""), i, 0) for i, (d, t) in enumerate(rows)],
                                     "doc_id long, text string, lang string, source string, n_chars int, text_key int, node int")

    return build


@pytest.fixture
def labels(spark):
    def build(*rows: tuple):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

    return build
