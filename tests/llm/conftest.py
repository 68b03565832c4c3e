from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark: SparkSession):
    """Make a documents table from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", 0) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return make
