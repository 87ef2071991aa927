"""The corpus pipeline: documents in, encoded training documents out.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and gives
a DataFrame. ``run`` writes the result of each stage as Parquet to the shared
folder and reads it again as the documents of the next one. All stages but the
last give back the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import bpe, line_frequency, pii, simhash, tiling
from clickloom.llm.common import table
from clickloom.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line frequency rules keep, without the lines that too many documents of a source share."""
    return line_frequency.clean(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of 4-word shingles are linked by 4 differing bits or fewer."""
    return simhash.dedup(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which tiles cover less than 0.6 of every benchmark item."""
    return tiling.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as token ids, with digests of the ids and of the bytes that they decode to."""
    path, pattern = bpe.multi_language_vocabulary()
    return bpe.with_digests(bpe.encode(docs, path, pattern, decoded="decoded"), keep_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("byte_level_bpe", byte_level_bpe),
]

#: SQL has no fingerprints, trees or tokenizers; the tests hold every stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
