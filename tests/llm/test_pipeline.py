"""Every stage of the pipeline against a plain version of its decisions, each on its predecessor's rows."""

from __future__ import annotations

import numpy as np
import pytest
import tiktoken

import corpus_pipeline as C
from clickloom.llm import bpe, line_frequency, pii, tiling
from clickloom.session import stage
from tests.llm.conftest import ODD
from tests.llm.test_line_frequency import expected as line_verdicts
from tests.llm.test_simhash import brute_fingerprint, brute_groups

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark):
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    out.append(docs.collect())
    for name, function in C.STAGES:
        docs = stage(function(spark, docs, SF_DIR), name)
        out.append(docs.collect())
    return out


def by_id(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_names_and_columns(results):
    assert [name for name, _ in C.STAGES] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "personal_data", "byte_level_bpe"]
    assert all(rows[0].__fields__ == COLUMNS for rows in results[:-1])
    assert all(len(r["text"]) == r["n_chars"] for rows in results[1:-1] for r in rows)


def test_quality_rules(results):
    verdict = line_verdicts([tuple(r)[:4] for r in results[0]], line_frequency.MIN_DOCS, line_frequency.MAX_SHARE, line_frequency.MIN_LEFT)
    assert set(by_id(results[1])) == {k for k, (_, kept, _) in verdict.items() if kept}


def test_near_dedup(results):
    rows = sorted(by_id(results[1]).items())
    groups = brute_groups([brute_fingerprint(t) for _, t in rows], 4)
    assert by_id(results[2]) == {rows[g][0]: rows[g][1] for g in set(groups)}


def test_decontamination(spark, results):
    items = [tiling.tokens(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]

    def leaks(text):
        words = tiling.tokens(text)
        return any(sum(n for _, _, n in tiling.tile_pair([words], i)) >= 0.6 * len(i) for i in items if sum(w in words for w in i) >= 0.6 * len(i))

    assert by_id(results[3]) == {k: t for k, t in by_id(results[2]).items() if not leaks(t)}
    assert len(results[3]) < len(results[2])


def test_personal_data(results):
    before, after = by_id(results[3]), by_id(results[4])
    assert set(before) == set(after)
    assert not any(pii.base_spans(t) for t in after.values())
    assert all(after[k] == t for k, t in before.items() if not pii.proposals(t) and not pii.base_spans(t))


def test_byte_level_bpe(results):
    path, pattern = bpe.multi_language_vocabulary()
    tik = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    texts = by_id(results[4])
    assert {r["doc_id"]: np.frombuffer(bytes(r["token_ids"]), "<u4").tolist() for r in results[5]} == {k: tik.encode_ordinary(t) for k, t in texts.items()}


def test_odd_documents_pass_all_stages(spark, documents):
    for rows in (ODD, []):
        docs = documents(rows)
        for name, function in C.STAGES:
            docs = stage(function(spark, docs, SF_DIR), name)
        assert docs.count() <= len(rows)
