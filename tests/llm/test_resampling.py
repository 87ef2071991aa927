from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import resampling
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_buckets(text, order=1, buckets=10_000):
    words = plain_words(text)
    return [zlib.crc32(" ".join(words[i : i + k]).encode()) % buckets for k in range(1, order + 1) for i in range(len(words) - k + 1)]


def plain_result(rows, target, order=1):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(plain_buckets(text, order))
    for text in target:
        t.update(plain_buckets(text, order))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10_000)]
    found = []
    for doc_id, text in rows:
        weight = sum(gain[b] for b in plain_buckets(text, order))
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        found.append([doc_id, len(plain_buckets(text, order)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(plain_words(text))])
    able = sorted((r for r in found if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able[: len(able) * 10 // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in found), key=str)


TEXTS = ["", "one", "One two, THREE-four. one_two", "  ..a..  ", "é È 日本 x1 y2\x00z\x7f{w}", "a b " * 50, "Ünï-cödé\n\ttab", "0 9 : @ [ `"]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_buckets_of_features(order):
    found, owners, lengths = resampling.feature_buckets([t.encode() for t in TEXTS], order)
    for k, text in enumerate(TEXTS):
        assert sorted(found[owners == k].tolist()) == sorted(plain_buckets(text, order))
        assert lengths[k] == len(plain_words(text))


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("most", [1, 5, 17])
def test_long_texts_are_read_in_pieces(spark, order, most):
    rng = random.Random(order * most)
    rows = [(k, "".join(rng.choice(["Ab", "c", " ", ".", "é", "ddd ", "xyzzyxyzzy"]) for _ in range(rng.randint(0, 60)))) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r["bucket"]: r["n"] for r in resampling.bucket_counts(docs, order=order, most=most).collect()}
    want = Counter(b for _, text in rows for b in plain_buckets(text, order))
    assert got == dict(want)


@pytest.mark.parametrize("order", [1, 2])
def test_against_a_plain_version(spark, documents, order):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(300)] + ["École", "日本"]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 120)))) for k in range(150)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, rows[9][1])]
    target = [" ".join(rng.choice(words[:40]) for _ in range(50)) for _ in range(10)]
    goal = spark.createDataFrame([(k, t) for k, t in enumerate(target)] + [(99, None)], "item_id long, text string")
    got = resampling.importance(documents(rows), goal, order=order).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_result(rows, target, order)


def test_draw_leans_to_the_target(spark, documents):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("abcdefgh" if k % 4 else "stuvwxyz") for _ in range(40))) for k in range(200)]
    goal = spark.createDataFrame([(0, "s t u v w x y z " * 20)], "item_id long, text string")
    docs = documents(rows).selectExpr("*", "1 as __rank", "'x' as `a.b`", "2 as __row", "3 as bucket", "4 as __place")
    drawn = resampling.draw(docs, goal)
    assert drawn.columns == docs.columns
    got = drawn.collect()
    assert len(got) == 20 and all(r["doc_id"] % 4 == 0 and r["__row"] == 2 and r["a.b"] == "x" for r in got)


def test_odd_rows_and_empty_tables(spark, documents):
    goal = spark.createDataFrame([(0, "the same text")], "item_id long, text string")
    nothing = goal.where("false")
    for target, texts in ((goal, ["the same text"]), (nothing, [])):
        got = [tuple(r) for r in resampling.importance(documents(ODD), target).collect()]
        assert sorted(got, key=str) == plain_result([(r[0], r[1]) for r in ODD], texts)
    assert resampling.importance(documents([]), goal).count() == resampling.draw(documents([]), goal).count() == 0


def test_gains_cover_every_bucket(spark, documents):
    gains = resampling.gain_table(documents([(1, "a b c")]), documents([(1, "a a d")]))
    values = {r["bucket"]: r["gain"] for r in gains.collect()}
    assert len(values) == 10_000
    assert values[zlib.crc32(b"a") % 10_000] == math.floor(1000 * np.log(3 * 10_003 / (2 * 10_003)))
