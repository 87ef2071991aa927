from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark: SparkSession):
    """Makes a documents table from (doc_id, text[, lang[, source]]) rows, in more than one partition."""

    def make(rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, *("en", "src0")[len(row) - 2 :])
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


#: rows that every operator must bear: nulls, an empty and a very long text, ties and repeated rows
ODD = [
    (None, "A row without an id.", None, None),
    (1, None, None, None),
    (2, "", "en", None),
    (3, " \n\t ", None, "src0"),
    (4, "word " * 60_000, "en", "src0"),
    (5, "x" * 200_000, "en", "src0"),
    (6, "The same text twice over, with ünïcödé.\nAnd a line.", "fr", "src1"),
    (6, "The same text twice over, with ünïcödé.\nAnd a line.", "fr", "src1"),
    (7, "The same text twice over, with ünïcödé.\nAnd a line.", "fr", "src1"),
]
