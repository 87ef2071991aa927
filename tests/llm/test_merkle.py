from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest

from clickloom.llm import merkle
from tests.llm.conftest import ODD


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text) -> str:
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves: list[str]) -> list[list[str]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[k : k + 8])) for k in range(0, len(below), 8)])
    return levels


def plain_path(levels, at):
    """(run, slot) of each level up to the root."""
    for level in levels[:-1]:
        start = at // 8 * 8
        yield level[start : start + 8], at - start
        at //= 8


def plain_manifest(rows) -> list[tuple]:
    groups = defaultdict(list)
    for r in rows:
        leaf = plain_leaf(r, r["text"])
        low = r["text"] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
        tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
        groups[r["lang"]].append((r["doc_id"], leaf, plain_leaf(r, low) if tampered else leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, out = {}, []
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = plain_tree([leaf for _, leaf, _ in groups[g]])
    top = plain_tree([trees[g][-1][0] for g in order])
    for k, g in enumerate(order):
        for at, (doc_id, leaf, changed) in enumerate(groups[g]):
            path = [*plain_path(trees[g], at), *plain_path(top, k)]
            now, siblings = changed, ""
            for run, slot in path:
                siblings += "".join(run[:slot] + run[slot + 1 :])
                now = sha("".join([*run[:slot], now, *run[slot + 1 :]]))
            root = top[-1][0]
            out.append((doc_id, leaf, trees[g][-1][0], root, sha(siblings), now, now == root))
    return out


def key(row):
    return tuple(str(v) for v in row)


def check(docs):
    got = [tuple(r) for r in merkle.document_manifest(docs).collect()]
    assert sorted(got, key=key) == sorted(plain_manifest(docs.collect()), key=key)
    return got


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 140])
def test_sizes_around_full_runs(spark, documents, n):
    got = check(documents([(k, f"Text {k}", "en") for k in range(n)]))
    assert len({r[3] for r in got}) == 1
    assert all(r[6] == (zlib.crc32(str(r[0]).encode()) % 3 != 0) for r in got)


def test_many_groups(spark, documents):
    rows = [(k, f"Text {k}", f"l{k % 70}") for k in range(200)]
    check(documents([*rows, (1000, "alone", None), (1001, "empty", "")]))


def test_odd_rows_and_empty_table(spark, documents):
    check(documents(ODD))
    assert merkle.document_manifest(documents([])).count() == 0


def test_extra_columns_are_ignored(spark, documents):
    docs = documents([(k, f"Text {k}", "en") for k in range(20)])
    more = docs.selectExpr("*", "'x' as `group`", "'y' as leaf", "1 as size", "'z' as `index`", "'d' as `a.b`", "7 as member")
    assert sorted(map(tuple, merkle.document_manifest(more).collect())) == sorted(map(tuple, merkle.document_manifest(docs).collect()))


def test_result_does_not_depend_on_the_layout(spark, documents):
    docs = documents([(k % 40, f"Text {k % 60}", ("en", "de")[k % 2]) for k in range(120)])
    once = sorted((tuple(r) for r in merkle.document_manifest(docs.repartition(7)).collect()), key=key)
    assert once == sorted((tuple(r) for r in merkle.document_manifest(docs.coalesce(1)).collect()), key=key)
