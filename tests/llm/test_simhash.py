from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from clickloom.llm import simhash
from clickloom.llm.components import connected_components
from tests.llm.conftest import ODD


def brute_fingerprint(text: str) -> int:
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\n", " ").replace("\t", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints: list[int], radius: int) -> list[int]:
    group = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return group


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", ["", "one", "One two THREE", "a b c d", "a b c d e f g " * 9, "É è\tx\ny z É"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == signed(brute_fingerprint(text))


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_every_pair_within_the_radius_meets_in_a_table(radius):
    masks = simhash.covering_masks(list(range(64)), radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = random.Random(1)
    for _ in range(2000):
        flipped = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not mask & flipped for mask in masks)


def test_forest_spans_the_links():
    rng = np.random.default_rng(2)
    prints = np.unique(rng.integers(0, 1 << 9, 150).astype(np.int64))
    links = simhash.forest(prints, 2)
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    groups = brute_groups(prints.tolist(), 2)
    assert len(links) == len(prints) - len(set(groups))


@pytest.mark.parametrize("bucket_rows", [24, 4096])
def test_components_of_dense_fingerprints(spark, bucket_rows):
    """Many neighbours in few buckets: both the buckets that fit a task and those that are split again."""
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = {0, centre} | {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))) for _ in range(80)} | {rng.getrandbits(64) for _ in range(40)}
    prints = sorted(prints)
    table = spark.createDataFrame([(k, signed(p)) for k, p in enumerate(prints)], "doc_id long, fingerprint long").repartition(4)
    found = simhash.near_duplicates(table, "doc_id", 2, bucket_rows)
    got = {r["fingerprint"]: r["component_id"] for r in found.collect()}
    want = brute_groups(prints, 2)
    assert got == {signed(p): g for p, g in zip(prints, want)}


@pytest.mark.parametrize("radius", [1, 2, 4, 6])
def test_splits_come_to_an_end(radius):
    rng = random.Random(5)
    for bits in range(radius + 1, 65):
        free = sorted(rng.sample(range(64), bits))
        masks = simhash.splitting_masks(free, radius)
        assert all(masks)
        for _ in range(50):
            flipped = sum(1 << b for b in rng.sample(free, radius))
            assert any(not mask & flipped for mask in masks)


def test_components_of_a_dense_cube(spark):
    """All fingerprints over the 15 bits that are free after two masks: a bucket that further masks never made smaller."""
    cube = list(range(64))
    for _ in range(2):
        mask = simhash.covering_masks(cube, 4)[0]
        cube = [b for b in cube if not mask >> b & 1]
    assert len(cube) == 15 and not all(simhash.covering_masks(cube, 4))
    prints = [sum(1 << b for k, b in enumerate(cube) if x >> k & 1) for x in range(1 << 15)]
    table = spark.createDataFrame([(k, signed(p)) for k, p in enumerate(prints)], "doc_id long, fingerprint long").repartition(4)
    found = simhash.near_duplicates(table, "doc_id", 4)
    assert found.count() == 1 << 15 and [r["component_id"] for r in found.select("component_id").distinct().collect()] == [0]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 200), (301, 300), (300, 301), (None, 7)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(4))
    got = dict((r["node"], r["component"]) for r in found.collect())
    want = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {300: 300, 301: 300}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_against_brute_force(spark):
    from clickloom.llm.queries import op10_simhash

    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [brute_fingerprint(r["text"]) for r in rows]
    groups = brute_groups(prints, 4)
    first = {g: min(r["doc_id"] for r, h in zip(rows, groups) if h == g) for g in groups}
    want = sorted((r["doc_id"], format(p, "016x"), first[g]) for r, p, g in zip(rows, prints, groups))
    assert sorted(map(tuple, op10_simhash(spark, sf_dir).collect())) == want


def test_odd_rows_and_empty_table(spark, documents):
    docs = documents(ODD)
    got = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.simhash_components(docs).collect()}
    assert {key[0] for key, value in got.items() if key[1] == "0" * 16} == {1, 2, 3}
    assert all(value == 1 for key, value in got.items() if key[1] == "0" * 16)
    assert [value for key, value in got.items() if key[0] in (6, 7)] == [6, 6]
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 4, 5, 6]
    assert simhash.dedup(documents([])).count() == simhash.simhash_components(documents([])).count() == 0


def test_extra_columns_with_clashing_names_stay(spark, documents):
    docs = documents([(1, "a b c d e"), (2, "a b c d e")]).selectExpr("*", "'x' as fingerprint", "1 as component", "2 as a")
    rows = simhash.dedup(docs).collect()
    assert [(r["doc_id"], r["fingerprint"], r["component"], r["a"]) for r in rows] == [(1, "x", 1, 2)]
