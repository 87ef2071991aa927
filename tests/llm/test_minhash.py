from __future__ import annotations

import random
import re

import numpy as np
import pytest

from clickloom.llm import minhash
from tests.llm.conftest import ODD

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_set(text, k=3):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def plain_result(rows, percent=85):
    """All pairs compared; (doc_id, n_shingles, component_id, kept)."""
    sets = [plain_set(text) for _, text in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        near = {j for shingle in s for j in holders.get(shingle, ())}
        for j in near:
            shared = len(s & sets[j])
            if 100 * shared >= percent * (len(s) + len(sets[j]) - shared):
                group[max(find(i), find(j))] = min(find(i), find(j))
        for shingle in s:
            holders.setdefault(shingle, []).append(i)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)] = min(ids.get(find(i), doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        head = ids.get(find(i))
        out.append((doc_id, len(sets[i]), head, doc_id == head))
    return sorted(out, key=str)


def found(docs, **options):
    return sorted(map(tuple, minhash.minhash_components(docs, **options).collect()), key=str)


def test_sets_of_texts():
    hashes = minhash.WordHashes(most=600)  # is emptied now and then
    texts = ["", " \n", "one", "One two", "one TWO three", "a b c a b c a", "É é x y z\x0bw", "x " * 50]
    sets = [minhash.shingle_set(t.encode(), hashes) for t in texts]
    assert [len(s) for s in sets] == [len(plain_set(t)) for t in texts]
    for a, x in zip(sets, texts):
        for b, y in zip(sets, texts):
            assert len(np.intersect1d(a, b)) == len(plain_set(x) & plain_set(y))


def test_coordinates_are_minima_under_shifts_of_one_permutation():
    make = minhash.Circulant(20, places=64, seed=3)
    rng = np.random.default_rng(3)
    first, second = rng.permutation(64), rng.permutation(64)
    shingles = np.random.default_rng(1).integers(0, 1 << 63, 30, np.uint64) * np.uint64(2)
    places = first[(shingles >> np.uint64(58)).astype(int)]
    assert make.signature(shingles).tolist() == [min(second[(p + k) % 64] for p in places) for k in range(20)]


def test_pairs_at_the_threshold_share_a_band():
    """20,000 pairs with a similarity of 0.85: none is missed, by far the most share many bands."""
    rng, make = np.random.default_rng(9), minhash.circulant(minhash.BANDS * minhash.BAND_ROWS, minhash.SEED)
    shared = []
    for _ in range(20_000):
        values = rng.integers(0, 1 << 63, 107, np.uint64) * np.uint64(2)
        a, b = values[:100], np.concatenate([values[:92], values[100:]])  # 92 shared of 107
        keys = minhash.band_keys(np.array([make.signature(a), make.signature(b)]), minhash.BANDS)
        shared.append((keys[0] == keys[1]).sum())
    assert min(shared) >= 1 and np.mean(shared) > 10


def test_bands_do_not_mix():
    keys = minhash.band_keys(np.zeros((2, 150), np.int32), 30)
    assert len(set(keys[0].tolist())) == 30 and (keys[0] == keys[1]).all()


def test_bitmaps_never_differ_in_more_places_than_sets():
    rng = np.random.default_rng(2)
    for n in (1, 30, 700, 9000):
        values = np.unique(rng.integers(0, 1 << 63, n + 60, np.uint64))
        a, b = values[:n], values[40:]
        differ = int(np.bitwise_count((minhash.bitmap(a) ^ minhash.bitmap(b)).view(np.uint64)).sum())
        assert differ <= len(np.setxor1d(a, b))


def near_copies(rng, words, n, edits):
    centre = [rng.choice(words) for _ in range(120)]
    for _ in range(n):
        copy = list(centre)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        yield " ".join(copy)


@pytest.mark.parametrize("edits", [1, 4, 9])
def test_groups_of_near_copies_against_all_pairs(spark, documents, edits):
    """Groups whose members differ from each other by about the threshold: links that the smallest member does not have count too."""
    rng = random.Random(edits)
    words = [f"w{k}" for k in range(2000)]
    texts = [t for _ in range(4) for t in near_copies(rng, words, 60, edits)] + [" ".join(rng.choice(words) for _ in range(80)) for _ in range(40)]
    texts += texts[:30] + [t.upper() for t in texts[30:40]]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert found(documents(rows)) == plain_result(rows)


def test_chain_of_links(spark, documents):
    words = [f"w{k}" for k in range(400)]
    rows = [(50 - k, " ".join(words[4 * k : 4 * k + 120])) for k in range(50)]
    want = plain_result(rows)
    assert {r[2] for r in want} == {1}
    assert found(documents(rows)) == want


def test_shared_passages_are_no_links(spark, documents):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(3000)]
    passage = " ".join(rng.choice(words) for _ in range(90))
    rows = [(k, passage + " " + " ".join(rng.choice(words) for _ in range(rng.randint(8, 60)))) for k in range(150)]
    assert found(documents(rows)) == plain_result(rows)


def test_small_sets(spark, documents):
    rows = [(1, "a b"), (2, "A  b"), (3, "a b c"), (4, "a b c d"), (5, "b a"), (6, "a"), (7, None), (8, ""), (9, "a b c"), (10, " ")]
    assert found(documents(rows)) == plain_result(rows)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_all_pairs(spark, sf_dir):
    from clickloom.llm.queries import op13_circulant_minhash

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = plain_result(rows)
    assert sorted(map(tuple, op13_circulant_minhash(spark, sf_dir).collect()), key=str) == want
    assert any(not r[3] for r in want)


def test_odd_rows_and_empty_table(spark, documents):
    docs = documents(ODD)
    assert found(docs) == plain_result([(r[0], r[1]) for r in ODD])
    assert sorted((r["doc_id"] or -1) for r in minhash.dedup(docs).collect()) == [-1, 1, 2, 3, 4, 5, 6]
    assert found(documents([])) == [] and minhash.dedup(documents([])).count() == 0
    only = documents([(None, "a b c d"), (None, "a b c d")])
    assert found(only) == [(None, 2, None, True)] * 2 and minhash.dedup(only).count() == 1


def test_extra_columns_with_clashing_names_stay(spark, documents):
    docs = documents([(1, "a b c d e"), (2, "a b c d e")]).selectExpr("*", "'x' as band", "1 as `class`", "2 as __row", "3 as `a.b`", "4 as id")
    rows = minhash.dedup(docs).collect()
    assert [(r["doc_id"], r["band"], r["class"], r["__row"], r["a.b"], r["id"]) for r in rows] == [(1, "x", 1, 2, 3, 4)]
