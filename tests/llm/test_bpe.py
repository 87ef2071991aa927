from __future__ import annotations

import hashlib
import random
from sys import getsizeof

import numpy as np
import pytest
import regex
import tiktoken

from clickloom.llm import bpe
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def vocabulary():
    path, pattern = bpe.multi_language_vocabulary()
    ranks = bpe.read_ranks(path)
    return path, pattern, ranks, tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", " ", "a", "Hello world, it's  me\n\n\t!", "日本語 🙂🙂 é", "x" * 3000, "ab" * 2000, " " * 400 + "end", "\x1c\x85  z", "<|endoftext|>", "aaaa aaaa aaaaa", "²½ ٣٤٥"]


def encoded(vocabulary, texts, most=bpe.KNOWN_BYTES):
    _, pattern, ranks, _ = vocabulary
    corpus = bpe.Corpus(ranks, bpe.pair_ranks(ranks), most)
    return [np.frombuffer(x, "<u4").tolist() for k in range(0, len(texts), 3) for x in bpe._encode_block(corpus, regex.compile(pattern), texts[k : k + 3])]


@pytest.mark.parametrize("most", [bpe.KNOWN_BYTES, 300])
def test_same_ids_as_the_library(vocabulary, most):
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice("aabbcé the ing\n") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    assert encoded(vocabulary, texts, most) == [vocabulary[3].encode_ordinary(t) for t in texts]


def test_a_long_text_goes_in_blocks_of_words(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 50)
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 7)
    text = "one two three four, five!\n" * 20
    assert encoded(vocabulary, [text])[0] == vocabulary[3].encode_ordinary(text)


def test_the_store_of_known_words_is_bounded_by_bytes(vocabulary):
    ranks = vocabulary[2]
    corpus = bpe.Corpus(ranks, bpe.pair_ranks(ranks), 20_000)
    rng = random.Random(7)
    for k in range(50):
        words = ["often", "x" * 3000 * (k % 9 == 0), *(f"{rng.random()}" for _ in range(60))]
        ids, counts = corpus.encode(words)
        assert counts.sum() == len(ids) and len(counts) == len(words)
        sizes = sum(map(getsizeof, corpus.place)) + 4 * len(corpus.ids) + bpe.WORD_BYTES * len(corpus.place)
        assert corpus.held == sizes <= 20_000
    assert "often" in corpus.place


def test_a_pair_that_opens_a_lower_rank_goes_first():
    """Ranks that no training would give: joining b and c opens a pair with a lower rank than the others."""
    ranks = {bytes((b,)): b for b in range(256)} | {b"bc": 300, b"abc": 290, b"bcd": 280, b"xa": 310}
    pairs = bpe.pair_ranks(ranks)
    ids, counts = bpe.replay([b"abcd", b"xabc", b"bc", b""], ranks, pairs)
    tik = tiktoken.Encoding("own", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})
    assert ids == [i for w in ("abcd", "xabc", "bc") for i in tik.encode_ordinary(w)]
    assert sum(counts) == len(ids) and counts[-1] == 0


def test_round_trip_and_odd_rows(spark, documents, vocabulary):
    docs = documents(ODD).selectExpr("*", "'x' as token_ids_", "1 as decoded_")
    path, pattern, _, tik = vocabulary
    rows = bpe.decode(bpe.encode(docs, path, pattern, keep_text=True), path).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
        assert np.frombuffer(bytes(r["token_ids"]), "<u4").tolist() == tik.encode_ordinary(r["text"] or "")
    assert bpe.digests(documents([])).count() == 0


def test_query_against_the_library(spark, vocabulary):
    from clickloom.llm.queries import op2_byte_bpe

    sf_dir = "/root/testdata/sf0.001"
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in op2_byte_bpe(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = np.array(vocabulary[3].encode_ordinary(r["text"]), "<u4")
        assert got[r["doc_id"]] == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest())
