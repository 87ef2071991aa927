"""SimHash near-duplicates with covering locality-sensitive hashing.

A fingerprint has 64 bits. Two texts are linked when their fingerprints
differ in at most ``radius`` bits. Bit ``i`` gets a vector ``phi(i)`` over
``radius + 1`` binary digits, and each nonzero vector ``v`` is a table whose
mask holds the bits with an odd product of ``phi(i)`` and ``v``. At most
``radius`` differing bits span less than the whole space, so some ``v`` is
orthogonal to all of them: that table's mask hides every difference and the
two fingerprints meet in one bucket. No pair within the radius is missed.

Scale: equal fingerprints are merged before any join, so a text copied a
billion times is one row. Buckets are counted with map-side sums first. Those
of up to ``bucket_rows`` fingerprints are compared inside tasks and give a
spanning forest of their links, never all pairs. Larger ones are split by the
same construction over the bits that their mask has not fixed yet; that halves
the free bits as long as there are ``2 ** radius`` of them. With fewer the masks
fix one of ``radius + 1`` parts of the free bits each, and ``radius`` differing bits
leave a part alone. Buckets of ``LAST_BITS`` free bits or fewer are compared
whatever their number, as they cannot hold more than ``2 ** LAST_BITS`` fingerprints.

Null texts count as empty, and all empty texts have fingerprint zero and are
linked like any other. Null ids take part in links; a group whose ids are all
null has a null component id. Repeated rows are linked to each other. An empty
table gives an empty result. Extra columns are ignored by the query; the
filter returns them as they came.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from clickloom.llm.common import ROW, map_batches, raw_texts, small, with_row_number
from clickloom.llm.components import connected_components
from clickloom.session import stage

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
#: distinct fingerprints that one task compares with each other
BUCKET_ROWS = 2048
#: free bits of a bucket that is not split any more
LAST_BITS = 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles of a UTF-8 text; A-Z is lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) > shingle:
        parts = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    else:
        parts = (b" ".join(words),)
    digests = b"".join(map(partial(xxhash.xxh64_digest, seed=SEED), parts))
    bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(bits)).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, name: str = "fingerprint", keep_text: bool = False) -> DataFrame:
    """``docs`` with the fingerprint of its text column as a long; the text itself goes unless ``keep_text``."""
    rest = [c for c in docs.columns if keep_text or c != text]
    at = docs.columns.index(text)
    spots = [docs.columns.index(c) for c in rest]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = [fingerprint(x, shingle) for x in raw_texts(batch.column(at))]
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in spots), pa.array(prints, pa.int64())], [*rest, name])

    fields = [f for f in docs.schema.fields if f.name in rest]
    return map_batches(docs, work, StructType([*fields, StructField(name, LongType())]))


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over the given bit positions, one per table, as unsigned 64-bit integers."""
    vectors = 2 ** (radius + 1) - 1
    phi = {bit: 1 + k % vectors for k, bit in enumerate(positions)}
    return [sum(1 << bit for bit in positions if (phi[bit] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def splitting_masks(positions: list[int], radius: int) -> list[int]:
    """Masks like ``covering_masks``, each of which fixes some of the positions; there must be more than ``radius``."""
    if len(positions) >= 2**radius:
        return covering_masks(positions, radius)
    return [sum(1 << bit for bit in positions[k :: radius + 1]) for k in range(radius + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def forest(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join the same fingerprints as all pairs within the radius would: a spanning forest of them."""
    left, out = prints.view(np.uint64), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                queue.extend(found)
                out += [(int(at), int(x)) for x in found]
    return out


def _forests(radius: int):
    """Links inside each bucket of a partition that is sorted by bucket."""

    def run(batches):
        carry: list[np.ndarray] = []
        key = None
        for batch in batches:
            keys = np.stack([batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)])
            prints = batch.column(2).to_numpy(zero_copy_only=False)
            if not len(prints):
                continue
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            links: list[tuple[int, int]] = []
            for start, end in zip([0, *cuts], [*cuts, len(prints)]):
                here = (keys[0, start], keys[1, start])
                if carry and here != key:
                    links += forest(np.concatenate(carry), radius)
                    carry = []
                key = here
                carry.append(prints[start:end])
            yield _link_batch(links)
        if carry:
            yield _link_batch(forest(np.concatenate(carry), radius))

    return run


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1))], ["a", "b"])


def covering_links(prints: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) that connect the same distinct fingerprints as all pairs within ``radius`` bits.

    ``prints`` has one column ``fingerprint`` of distinct values in a written table.
    """
    if not 1 <= radius <= 6:
        raise ValueError("the number of tables doubles with each bit of the radius: 1 to 6")
    # a place is a chain of tables; a bucket is a place with the bits that its masks fix
    spark, fan = prints.sparkSession, 2 ** (radius + 1)
    masks = {v: mask for v, mask in enumerate(covering_masks(list(range(BITS)), radius), 1)}
    tables = F.array(*(F.struct(F.lit(v).cast("long").alias("place"), F.lit(_signed(m)).cast("long").alias("mask")) for v, m in masks.items()))
    dealt = prints.select("fingerprint", F.explode(tables).alias("t")).select("fingerprint", "t.place", "t.mask", F.lit(False).alias("final"))
    found: list[DataFrame] = []
    while True:
        keyed = dealt.select("fingerprint", "place", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("fixed"), "final")
        sizes = stage(keyed.groupBy("place", "fixed").agg(F.count("*").alias("n"), F.max("final").alias("final")).where("n > 1"), "buckets")
        fits = (F.col("n") <= bucket_rows) | F.col("final")
        small = keyed.select("fingerprint", "place", "fixed").join(sizes.where(fits).select("place", "fixed"), ["place", "fixed"])
        small = small.select("place", "fixed", "fingerprint").repartition("place", "fixed").sortWithinPartitions("place", "fixed")
        found.append(stage(small.mapInArrow(_forests(radius), "a bigint, b bigint").distinct(), "links"))
        large = sizes.where(~fits).select("place", "fixed")
        places = [r["place"] for r in large.select("place").distinct().collect()]  # one per chain of tables at most
        if not places:
            break
        crowded = stage(keyed.join(large, ["place", "fixed"], "left_semi").select("fingerprint", F.col("place").alias("above")), "crowded")
        deeper = {}
        for place in places:
            free = [bit for bit in range(BITS) if not masks[place] >> bit & 1]
            deeper |= {(place, place * fan + v): masks[place] | mask for v, mask in enumerate(splitting_masks(free, radius), 1)}
        rows = [(above, place, _signed(mask), BITS - mask.bit_count() <= LAST_BITS) for (above, place), mask in deeper.items()]
        dealt = crowded.join(F.broadcast(spark.createDataFrame(rows, "above long, place long, mask long, final boolean")), "above")
        masks = {place: mask for (_, place), mask in deeper.items()}
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def near_duplicates(marked: DataFrame, id_col: str = "doc_id", radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(fingerprint, component, component_id) per distinct fingerprint of a written table with ids and fingerprints."""
    classes = stage(marked.groupBy("fingerprint").agg(F.min(id_col).alias("first_id")), "fingerprints")
    links = covering_links(classes.select("fingerprint"), radius, bucket_rows)
    member = connected_components(links)
    known = classes.join(member, classes["fingerprint"] == member["node"], "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component")
    )
    known = stage(known, "members")
    heads = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return known.join(heads, "component").select("fingerprint", "component", "component_id")


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id, then the first row. Columns as given."""
    columns = docs.columns
    marked = stage(with_fingerprint(with_row_number(docs), text, shingle, "__fingerprint", keep_text=True), "marked")
    narrow = marked.select(F.col(id_col).alias("__id"), ROW, F.col("__fingerprint").alias("fingerprint"))
    groups = near_duplicates(narrow, "__id", radius, bucket_rows)
    # nulls last, so that a document with an id stays when there is one
    order = F.struct(F.col("__id").isNull().alias("n"), F.col("__id").alias("id"), F.col(ROW).alias("row"))
    per_print = narrow.groupBy("fingerprint").agg(F.min(order).alias("head"))
    kept = per_print.join(groups, "fingerprint").groupBy("component").agg(F.min("head").alias("head"))
    return marked.join(kept.select(F.col("head.row").alias(ROW)), ROW, "left_semi").select(columns)


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id), one row per document."""
    marked = stage(with_fingerprint(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), "text", shingle), "marked")
    groups = near_duplicates(marked, "doc_id", radius, bucket_rows)
    return marked.join(groups, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
