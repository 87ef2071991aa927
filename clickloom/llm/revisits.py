"""Not-modified revisits of a web archive resolved to the response they stand for.

A crawl writes a full response once and, when the server answers "not modified"
(304), a revisit record with headers but no body. A revisit stands for the latest
earlier full response of the same canonical address: an as-of join by address and
time, ties by record id. Validators decide whether the two belong together:

* an entity tag must be equal under weak comparison;
* without one, the date of last modification must be equal;
* a payload digest, where both have it, must be equal in any case.

Outcomes: ``resolved`` (a validator agrees), ``mismatch`` (one disagrees), ``unverified``
(none to compare), ``orphan`` (no earlier response); a full response is ``full``.
A resolved record has the headers of the response with those of the revisit
that a 304 may update (fixed list below); all other headers stay the response's.

Scale: records go to (address, time slice) and a window finds the latest response
inside the slice. The last response of each slice is carried on over the slices of
an address, which number ``MOST_SLICES`` at most, by a window over that small table.
An address with a third of all records is thus spread over all slices. Slices
are cut at quantiles of the time. Bodies stay out of the windows; ``with_payload``
joins them by record id afterwards.

Null addresses share one empty address. Null times come first. Null headers are
empty maps. Repeated records are kept, each resolved on its own. An empty table
gives an empty result. Extra columns are ignored. Long bodies are only hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.session import stage

SLICE_ROWS = 50_000
MOST_SLICES = 4096
#: fixed values: headers that a 304 response may update, and query parameters that do not tell pages apart
PERMITTED = ["age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
TRACKING = ["fbclid", "gclid", "ref", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term"]


def canonical_url(url: Column) -> Column:
    """Host in lower case, path, and sorted query without tracking parameters; scheme, user, ``www.``, default port and fragment go."""
    bare = F.regexp_replace(F.coalesce(F.trim(url), F.lit("")), "#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_extract(bare, r"^[^/?]*(/[^?]*)", 1)
    path = F.when(path == "", F.lit("/")).otherwise(path)
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).isin(TRACKING))
    line = F.array_join(F.array_sort(kept), "&")
    return F.concat(host, path, F.when(line == "", F.lit("")).otherwise(F.concat(F.lit("?"), line)))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def _latest_responses(records: DataFrame, slice_rows: int) -> DataFrame:
    """``records`` with ``found``: the latest full response of the address before each record."""
    rows = records.count()
    parts = min(MOST_SLICES, -(-rows // slice_rows))
    cuts = []
    if parts > 1:
        shares = [k / parts for k in range(1, parts)]
        cuts = sorted(set(records.agg(F.percentile_approx(F.col("at"), shares, 20_000).alias("c")).first()["c"] or []))
    part = F.lit(0)
    if cuts:  # how many cuts are at or below the time: first by groups of cuts, then inside the group
        groups = [cuts[k : k + 64] for k in range(0, len(cuts), 64)]
        below = lambda c: c <= F.col("at")
        group = F.size(F.filter(F.array(*(F.lit(g[0]) for g in groups)), below))
        inner = F.size(F.filter(F.element_at(F.array(*(F.array(*map(F.lit, g)) for g in groups)), group), below))
        part = F.when(group == 0, 0).otherwise((group - 1) * 64 + inner)
    sliced = records.withColumn("part", F.coalesce(part, F.lit(0)))
    order = [F.col("at").asc_nulls_first(), F.col("record_id").asc_nulls_first()]
    full = F.when(F.col("kind") == "response", F.struct("record_id", "at", "headers", "digest"))
    inside = Window.partitionBy("address", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    near = sliced.withColumn("near", F.last(full, ignorenulls=True).over(inside))
    rank = F.struct(F.col("at").isNotNull(), "at", F.col("record_id").isNotNull(), "record_id")
    ends = sliced.where("kind = 'response'").groupBy("address", "part").agg(F.max_by(F.struct("record_id", "at", "headers", "digest"), rank).alias("end"))
    # every slice of an address that has records, with the last response before it
    slices = sliced.select("address", "part").distinct().join(ends, ["address", "part"], "left")
    before = Window.partitionBy("address").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.withColumn("far", F.last("end", ignorenulls=True).over(before)).where("far is not null").select("address", "part", "far")
    joined = near.join(carried, ["address", "part"], "left")
    return joined.withColumn("found", F.coalesce("near", "far")).drop("near", "far", "part")


def merged_headers(stored: Column, update: Column) -> Column:
    """Headers of a response brought up to date by those of a revisit that it may update."""
    fresh = F.map_filter(update, lambda k, v: k.isin(PERMITTED))
    kept = F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(fresh), k))
    return F.map_concat(kept, fresh)


def _lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names that differ in case only the first counts."""
    entries = F.map_entries(headers)
    names = F.transform(entries, lambda e: F.lower(e["key"]))
    first = F.filter(F.transform(entries, lambda e, k: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"), k.alias("k"))), lambda e: F.array_position(names, e["key"]) == e["k"] + 1)
    return F.map_from_entries(F.transform(first, lambda e: F.struct(e["key"], e["value"])))


def resolve(records: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Outcome per record: record_id, address, at, kind, outcome, source_id, headers and digest.

    ``records`` has record_id (long), url, at (long), kind (``response`` or ``revisit``), headers (map) and digest
    (of the payload, may be null). ``source_id`` names the record whose payload counts: its own for a response,
    that of the response found for a resolved revisit, else null.
    """
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    narrow = records.select("record_id", canonical_url(F.col("url")).alias("address"), "at", "kind", _lower_keys(F.coalesce("headers", none)).alias("headers"), "digest")
    found = _latest_responses(stage(narrow, "records"), slice_rows)
    tag, old_tag = F.col("headers")["etag"], F.col("found.headers")["etag"]
    date, old_date = F.col("headers")["last-modified"], F.col("found.headers")["last-modified"]
    by_digest = F.when(F.col("digest").isNotNull() & F.col("found.digest").isNotNull(), F.col("digest") == F.col("found.digest"))
    by_tag = F.when(tag.isNotNull() & old_tag.isNotNull(), _weak(tag) == _weak(old_tag))
    by_date = F.when(date.isNotNull() & old_date.isNotNull(), date == old_date)
    agreed = F.when(by_digest == False, F.lit(False)).otherwise(F.coalesce(by_tag, by_date, by_digest))  # noqa: E712
    outcome = (
        F.when(F.col("kind") == "response", "full").when(F.col("found").isNull(), "orphan").when(agreed.isNull(), "unverified").when(agreed, "resolved").otherwise("mismatch")
    )
    done = found.withColumn("outcome", outcome)
    is_resolved = F.col("outcome") == "resolved"
    return done.select(
        "record_id", "address", "at", "kind", "outcome",
        F.when(F.col("outcome") == "full", F.col("record_id")).when(is_resolved, F.col("found.record_id")).alias("source_id"),
        F.when(is_resolved, merged_headers(F.col("found.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"),
        F.when(is_resolved, F.coalesce("found.digest", "digest")).otherwise(F.col("digest")).alias("digest"),
    )


def with_payload(resolved: DataFrame, bodies: DataFrame, body: str = "body") -> DataFrame:
    """``resolved`` with the payload of the record that each source id names; ``bodies`` has record_id and the payload."""
    named = bodies.select(F.col("record_id").alias("source_id"), body)
    return resolved.join(named, "source_id", "left")


def crawl_of(pages: DataFrame) -> DataFrame:
    """The pages as a crawl of two rounds: each page fetched once in full and once more as "not modified".

    A page's number is the second of its fetch. The second round comes a third of a million seconds later and asks for
    the address in another spelling. Tags are weak, and one page in sixteen (by digest) has changed its tag meanwhile;
    one in sixteen sends no tag but the date.
    """
    digest = F.md5(F.coalesce("html", F.lit("")))
    id_, url = F.col("page_id").cast("long"), F.col("url")
    base = pages.select(id_.alias("id"), url.alias("url"), digest.alias("digest"))
    date = F.concat(F.lit("day "), F.expr("cast(id div 1000 as string)"))
    first = base.select(
        F.expr("id * 2").alias("record_id"), "url", F.col("id").alias("at"), F.lit("response").alias("kind"),
        F.create_map(F.lit("ETag"), F.concat(F.lit('"'), "digest", F.lit('"')), F.lit("Last-Modified"), date, F.lit("Content-Type"), F.lit("text/html"), F.lit("Cache-Control"), F.lit("max-age=60")).alias("headers"),
        "digest",
    )
    digit = F.substring("digest", 1, 1)
    tag = F.when(digit == "0", F.lit('W/"changed"')).when(digit == "1", F.lit(None)).otherwise(F.concat(F.lit('W/"'), "digest", F.lit('"')))
    headers = F.create_map(F.lit("etag"), tag, F.lit("last-modified"), date, F.lit("cache-control"), F.lit("max-age=600"), F.lit("content-type"), F.lit("text/plain"))
    second = base.select(
        F.expr("id * 2 + 1").alias("record_id"), F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again")).alias("url"), F.expr("id + 333333").alias("at"),
        F.lit("revisit").alias("kind"), F.map_filter(headers, lambda k, v: v.isNotNull()).alias("headers"), F.lit(None).cast("string").alias("digest"),
    )
    return first.unionByName(second)


def crawl_report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Outcome of every record of the crawl, with the merged headers as one sorted line."""
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return resolve(crawl_of(pages)).select("record_id", "address", F.col("at").alias("fetched_at"), "kind", "outcome", "source_id", F.array_join(F.array_sort(lines), "; ").alias("headers"), "digest")
