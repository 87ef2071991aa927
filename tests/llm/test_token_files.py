from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from clickloom.llm import token_files as T
from clickloom.session import new_path
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(T.word_tokenizer())


TEXTS = [
    "", "  ", "Hello<|endoftext|>World", "A<|ENDOFTEXT|>b <|endoftext|> C", "á b̈", "\x1c\x1dy", "İstanbul ΣΑΣ ß", "日本語 🙂", "ab cd e\n\nf",
    "́x", "I'm 12 it's", "a\x01b \x01 c", "a.. x., b.?! 12.,", ". .. a, é, É.", "x.<|endoftext|>.", "¿qué? 1:2; :",
]


@pytest.mark.parametrize("most", [T.KNOWN_CHUNKS, 3])
def test_same_ids_as_the_library(tokenizer, most):
    chunks = T.Chunks(tokenizer, True, most)
    for _ in range(2):  # the second time from the store
        for text in TEXTS:
            ids, counts = chunks.encode([text.encode()], 1)
            assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
            assert counts.tolist() == [len(ids)]


def expected(tokenizer, rows):
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_of_several_parts(spark, documents, tokenizer):
    rows = [(k, TEXTS[k % len(TEXTS)]) for k in (9, 3, -4, 70, 12, 55, 8, 31, 2, 10)]
    folder = new_path(spark, "files")
    manifest = T.write_token_files(documents(rows), T.word_tokenizer(), folder, part_rows=3)
    got = T.read_token_files(manifest, folder, with_ids=True).orderBy("doc_id").collect()
    assert manifest.count() > 1
    assert [tuple(r)[:4] for r in got] == expected(tokenizer, sorted(rows))
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in got)
    # the file format: 16-bit ids, 64-bit offsets with one more entry than documents, mapped into memory
    system, root = T.open_folder(folder)
    for r in manifest.collect():
        ids, offsets = (T._map(system, f"{root}/{r['name']}.{s}", t) for s, t in (("ids", "<u2"), ("idx", "<i8")))
        assert isinstance(ids, np.memmap) and len(ids) == offsets[-1] == r["n_tokens"] and len(offsets) == r["n_docs"] + 1


def test_odd_rows_and_empty_table(spark, documents, tokenizer):
    got = T.corpus_files(spark, documents(ODD)).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 5, 6, 6, 7]
    texts = {i: t for i, t, *_ in ODD}
    assert [tuple(r) for r in got] == expected(tokenizer, [(r["doc_id"], texts[r["doc_id"]]) for r in got])
    assert T.corpus_files(spark, documents([])).count() == 0


def test_query_against_the_library(spark, tokenizer):
    from clickloom.llm.queries import op9_token_files

    sf_dir = "/root/testdata/sf0.001"
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    assert sorted(map(tuple, op9_token_files(spark, sf_dir).collect())) == expected(tokenizer, rows)
