from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, or from (text, source) or (doc_id, text, source)."""

    def make(*given, schema=DOCUMENT):
        rows = []
        for i, g in enumerate(given):
            g = g if isinstance(g, tuple) else (g, "s")
            doc_id, text, source = g if len(g) == 3 else (i, *g)
            rows.append((doc_id, text, "en", source, len(text or "")))
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    """All rows of the small documents table, as the queries see them."""
    return [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
