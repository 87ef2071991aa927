from __future__ import annotations

import random

import pytest

from clickloom.llm import tiling as T
from tests.llm.conftest import ODD


def naive_tiling(text, test, least):
    """The longest match of unmarked tokens, leftmost first, again and again."""
    free_text, free_test, tiles = [w >= 0 for w in text], [True] * len(test), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(test)):
            for j in range(len(text)):
                k = 0
                while i + k < len(test) and j + k < len(text) and free_test[i + k] and free_text[j + k] and test[i + k] == text[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        n, i, j = best
        if n < least:
            return sorted(tiles)
        tiles.append((i, j, n))
        free_test[i : i + n] = free_text[j : j + n] = [False] * n


def test_tiles_against_the_naive_version():
    rng = random.Random(1)
    for _ in range(1500):
        v = rng.choice([2, 3, 6])
        test = [rng.randrange(v) for _ in range(rng.randint(0, 14))]
        text = [rng.randrange(-1, v) for _ in range(rng.randint(0, 25))]
        assert T.greedy_string_tiling(text, test, 2) == naive_tiling(text, test, 2)


def test_tokens():
    assert T.tokens("It's É_x 12,3 日本") == ["it", "s", "é", "x", "12", "3", "日", "本"]


ITEM = [f"item{k}" for k in range(30)]
OTHER = [f"other{k}" for k in range(20)]


def noise(seed, n=40):
    return [f"n{seed}k{k}" for k in range(n)]


def cases():
    rows = {
        1: noise(1) + ITEM + noise(2),
        2: noise(3) + ITEM[20:] + noise(4) + ITEM[10:20] + noise(5) + ITEM[:10],  # reordered
        3: noise(6) + ITEM[:12],  # too little
        4: noise(7) + [w for k in range(0, 30, 3) for w in [*ITEM[k : k + 3], "x"]],  # pieces below a seed
        5: ITEM[:9] + ["y"] + ITEM[10:30],
        6: noise(8, 200),
        7: ITEM + OTHER,
        8: ITEM[:12] * 3,  # the same piece again and again covers it once
    }
    return [(k, " ".join(v).title() + ".") for k, v in rows.items()]


@pytest.fixture
def benchmark(spark):
    rows = [(10, " ".join(ITEM)), (11, ", ".join(OTHER).upper()), (12, None), (13, ""), (14, "too short here"), (None, " ".join(noise(8, 9)))]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_reordered_passages_are_caught(spark, documents, benchmark):
    got = sorted((r["doc_id"], r["item_id"], r["covered"], r["n_tiles"]) for r in T.contaminated(documents(cases()), benchmark).collect() if r["item_id"])
    assert got == [(1, 10, 30, 1), (2, 10, 30, 3), (5, 10, 29, 2), (7, 10, 30, 1), (7, 11, 20, 1)]


def test_clean_keeps_the_rest_with_all_columns(spark, documents, benchmark):
    docs = documents([*cases(), (1, cases()[0][1]), *ODD]).selectExpr("*", "'a' as seed", "1 as item", "2 as text_md5_")
    kept = T.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == sorted([3, 4, 8, *((i or -1) for i, *_ in ODD)])


def test_empty_tables(spark, documents, benchmark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert T.contaminated(documents([]), benchmark).count() == 0
    assert T.contaminated(documents(cases()), none).count() == 0
    assert T.clean(documents(cases()), none).count() == len(cases())


def test_query_against_all_pairs(spark):
    from clickloom.llm.queries import op4_string_tiling

    sf_dir = "/root/testdata/sf0.001"
    items = [(r["item_id"], T.tokens(r["text"])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = []
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        words = T.tokens(r["text"])
        number = {w: k for k, w in enumerate(dict.fromkeys(words))}
        for item_id, item in items:
            if sum(w in number for w in item) < 0.6 * len(item):
                continue  # no tiles can cover it
            tiles = T.greedy_string_tiling([number[w] for w in words], [number.get(w, 10**9 + k) for k, w in enumerate(item)], 5)
            covered = sum(n for _, _, n in tiles)
            if covered >= 0.6 * len(item):
                want.append((r["doc_id"], item_id, len(item), covered, len(tiles)))
    got = sorted((r["doc_id"], r["item_id"], r["n_tokens"], r["covered"], r["n_tiles"]) for r in op4_string_tiling(spark, sf_dir).collect())
    assert got == sorted(want) and got
