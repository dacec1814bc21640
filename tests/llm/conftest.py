from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, score string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (id, text[, lang, source]) rows, with extra columns whose names clash."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""), "x", "y") for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
