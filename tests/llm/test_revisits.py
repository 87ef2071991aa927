from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickloom.llm import revisits as R

SCHEMA = "record_id bigint, url string, at bigint, kind string, headers map<string,string>, digest string"


@pytest.mark.parametrize(
    "url,want",
    [
        ("HTTP://User@WWW.Example.com:80/a/B?b=2&a=1&utm_source=x#top", "example.com/a/B?a=1&b=2"),
        ("https://example.com", "example.com/"),
        ("https://example.com?x=1", "example.com/?x=1"),
        ("example.com:8080/p?ref=z", "example.com:8080/p"),
        ("", "/"),
        (None, "/"),
    ],
)
def test_canonical_url(spark, url, want):
    row = spark.createDataFrame([(url,)], "u string").select(R.canonical_url(F.col("u")).alias("c")).first()
    assert row["c"] == want


def rows():
    u, v = "http://h.com/p", "https://www.h.com/p?utm_term=1#x"
    return [
        (1, u, 10, "response", {"ETag": '"a"', "Content-Type": "text/html", "Date": "d1"}, "D1"),
        (2, v, 20, "revisit", {"etag": 'W/"a"', "date": "d2", "content-type": "no", "X-New": "no"}, None),
        (3, u, 30, "response", {"ETag": '"b"', "Last-Modified": "m"}, "D3"),
        (4, v, 40, "revisit", {"etag": '"a"'}, None),  # the latest response has another tag
        (5, v, 50, "revisit", {"last-modified": "m"}, None),
        (6, v, 60, "revisit", {"etag": '"b"'}, "other"),  # digests disagree
        (7, v, 70, "revisit", {}, None),
        (8, v, 80, "revisit", {}, "D3"),
        (9, v, 5, "revisit", {"etag": '"a"'}, None),  # nothing before it
        (10, v, 30, "revisit", {"etag": '"b"'}, None),  # same time, larger id
        (2, v, 20, "revisit", {"etag": 'W/"a"', "date": "d2", "content-type": "no", "X-New": "no"}, None),
        (20, None, None, "revisit", None, None),
        (21, "http://other.com/p", 99, "revisit", {"etag": '"b"'}, None),
    ]


WANT = {1: ("full", 1), 2: ("resolved", 1), 3: ("full", 3), 4: ("mismatch", None), 5: ("resolved", 3), 6: ("mismatch", None), 7: ("unverified", None),
        8: ("resolved", 3), 9: ("orphan", None), 10: ("resolved", 3), 20: ("orphan", None), 21: ("orphan", None)}


@pytest.mark.parametrize("slice_rows", [50_000, 2])
def test_outcomes(spark, slice_rows):
    df = spark.createDataFrame(rows(), SCHEMA).withColumn("address", F.lit("clash")).repartition(3)
    got = R.resolve(df, slice_rows=slice_rows).collect()
    assert len(got) == len(rows())
    assert {r["record_id"]: (r["outcome"], r["source_id"]) for r in got} == WANT
    merged = next(r for r in got if r["record_id"] == 2)
    assert merged["headers"] == {"etag": 'W/"a"', "content-type": "text/html", "date": "d2"} and merged["digest"] == "D1"


def test_payload_and_empty_table(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    bodies = spark.createDataFrame([(1, "one"), (3, "x" * 100_000)], "record_id bigint, body string")
    got = {r["record_id"]: r["body"] for r in R.with_payload(R.resolve(df), bodies).collect()}
    assert got[2] == "one" and len(got[5]) == 100_000 and got[4] is None
    assert R.resolve(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_hot_address_against_brute_force(spark):
    records = [(k, "http://h.com/p" if k % 3 else f"http://h.com/{k}", (k * 37) % 500, "response" if k % 5 == 0 else "revisit", {"etag": str(k % 4)}, None) for k in range(600)]
    want = {}
    for k, url, at, kind, headers, _ in records:
        before = [r for r in records if r[3] == "response" and r[1] == url and (r[2], r[0]) < (at, k)]
        last = max(before, key=lambda r: (r[2], r[0]), default=None)
        if kind == "response":
            want[k] = ("full", k)
        elif last is None:
            want[k] = ("orphan", None)
        else:
            want[k] = ("resolved", last[0]) if last[4] == headers else ("mismatch", None)
    got = R.resolve(spark.createDataFrame(records, SCHEMA), slice_rows=10).collect()
    assert {r["record_id"]: (r["outcome"], r["source_id"]) for r in got} == want
