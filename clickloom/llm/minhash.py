"""MinHash near-duplicates with circulant permutations.

The set of a text holds its distinct word shingles (A-Z lower-cased; with fewer words
the whole sequence). Texts are linked when 100 times the size of the intersection of their
sets is at least ``PERCENT`` times that of the union. Two permutations of ``PLACES`` places
make all coordinates of a signature: the first moves every shingle to a place, the second, shifted
circularly by one more place for each coordinate, gives the values whose minimum is that
coordinate. All values of a shingle lie side by side in the second permutation, so a
signature is the minimum over rows of a sliding window. Texts that agree in one of ``BANDS``
bands of ``BAND_ROWS`` coordinates are candidates; a pair at the threshold has no such band
with a chance of 3 in 100 million (measured: ``tests/llm/test_minhash.py``).

Candidates are confirmed on their whole sets, in two rounds, without all pairs of a bucket:

* A shingle that one candidate alone holds is in no intersection. With ``n`` shingles, ``own`` of
  them alone, two texts share at most ``n - own`` of either and their union has at least ``n`` of the one
  and ``own`` of the other. That bound drops texts that can have no partner, and most
  pairs that are edited differently, before any set is read.
* First every member of a bucket is compared with the smallest one. Confirmed links give
  components. Then the members outside the largest component of their bucket are compared with
  those of other components in it. Inside a component nothing is left to be found.

Scale: equal sets are one class before any join, so a text copied a billion times is
one row. Bands are counted with partial sums; buckets of one are gone before the next step.
Texts are read a second time for the sets of candidates only, copies merged before that
shuffle. Joins on hot buckets and hot partners read written tables, so that adaptive execution
splits them; nothing is collected or broadcast beyond Spark's own size checks.

Null texts and texts without words have empty sets and are linked with nothing. Null ids take part
in links; a group whose ids are all null has a null component. Repeated rows are one class. A very long text
is one row of hashes, 8 bytes a shingle. An empty table gives an empty result. Extra columns are
ignored by the query; ``dedup`` returns them as they came.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from clickloom.llm.common import ROW, raw_texts, small, with_row_number
from clickloom.llm.components import connected_components
from clickloom.session import stage

SHINGLE = 3
PERCENT = 85
SEED = 7
#: places that the permutations permute
PLACES = 1 << 20
#: coordinates that must all be equal in a band, and bands
BAND_ROWS, BANDS = 5, 30

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: parities kept of a set, in words of 64
BITMAP = 1024
_WORDS = [f"w{k}" for k in range(BITMAP // 64)]
#: shingles whose windows are in memory at once
_PIECE = 4096


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit integers spread over all their bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hashes of words, kept from text to text up to a number of bytes."""

    def __init__(self, most: int = 32 << 20):
        super().__init__()
        self.most, self.held = most, 0

    def __missing__(self, word: bytes) -> int:
        self.held += len(word) + 150
        if self.held > self.most:
            self.clear()
            self.held = len(word) + 150
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def shingle_set(text: bytes, hashes: WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles of a UTF-8 text."""
    words = text.lower().split()  # of bytes: A-Z and the six ASCII white spaces only
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(shingle, len(each))
    found = np.full(len(each) - size + 1, size, np.uint64)
    for k in range(size):
        found = found * _STEP + each[k : len(each) - size + 1 + k]
    return np.unique(_mixed(found))


class Circulant:
    """Signatures of ``coordinates`` minima from two permutations."""

    def __init__(self, coordinates: int, places: int = PLACES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.first = rng.permutation(places).astype(np.int32)
        second = rng.permutation(places).astype(np.int32)
        # row p: the values of place p under the second permutation and its shifts
        self.shifted = sliding_window_view(np.concatenate([second, second[: coordinates - 1]]), coordinates)
        self.bits = np.uint64(64 - (places - 1).bit_length())

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        places = self.first[shingles >> self.bits]
        return np.min([self.shifted[places[at : at + _PIECE]].min(axis=0) for at in range(0, len(places), _PIECE)], axis=0)


@lru_cache(maxsize=4)
def circulant(coordinates: int, seed: int) -> Circulant:
    return Circulant(coordinates, seed=seed)


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key per row and band; equal bands have equal keys, and different bands of a signature different ones."""
    parts = signatures.astype(np.uint64).reshape(len(signatures), bands, -1)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(parts.shape[2]):
        keys = _mixed(keys * _STEP + parts[:, :, k])
    return keys


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """The parities of the numbers of shingles in ``BITMAP`` classes, as 64-bit words."""
    return np.packbits(np.bincount((shingles & np.uint64(BITMAP - 1)).astype(np.int64), minlength=BITMAP) % 2 == 1).view(np.int64)


def _text_key() -> list:
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("text"), "text").alias("t2")]


def marked(rows: DataFrame, shingle: int, bands: int, band_rows: int, seed: int) -> DataFrame:
    """Rows (id, text) as (id, t1, t2, n, d1, d2, bands): keys of text and set, the size of the set and its bands; a written table."""

    def run(batches):
        hashes, make = WordHashes(), circulant(bands * band_rows, seed)
        for batch in small(batches):
            sets = [shingle_set(x, hashes, shingle) for x in raw_texts(batch.column(3))]
            held = [s for s in sets if len(s)]
            keys = band_keys(np.array([make.signature(s) for s in held]).reshape(-1, bands * band_rows), bands).view(np.int64)
            offsets = np.concatenate([[0], np.cumsum([bands if len(s) else 0 for s in sets])]).astype(np.int32)
            digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s) for s in sets), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3], pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
                ],
                ["id", "t1", "t2", "n", "d1", "d2", "bands"],
            )

    longs = [StructField(c, LongType()) for c in ("t1", "t2", "n", "d1", "d2")]
    schema = StructType([rows.schema["id"], *longs, StructField("bands", ArrayType(LongType()))])
    return stage(with_row_number(rows.select("id", *_text_key(), "text").mapInArrow(run, schema)), "signatures")


def shingle_sets(rows: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(class, n, shingles, words of the bitmap) of the classes wanted (class, t1, t2), from the texts of the rows; a written table."""
    once = rows.select(*_text_key(), "text").groupBy("t1", "t2").agg(F.first("text").alias("text"))

    def run(batches):
        hashes = WordHashes()
        for batch in small(batches, 200):
            sets = [shingle_set(x, hashes, shingle) for x in raw_texts(batch.column(1))]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32))
            values = pa.array(np.concatenate(sets).view(np.int64))
            sizes, bits = pa.array([len(s) for s in sets], pa.int64()), np.array([bitmap(s) for s in sets])
            columns = [batch.column(0), sizes, pa.ListArray.from_arrays(offsets, values), *map(pa.array, bits.T)]
            yield pa.RecordBatch.from_arrays(columns, ["class", "n", "shingles", *_WORDS])

    schema = ", ".join(["class long, n long, shingles array<long>", *(f"{w} long" for w in _WORDS)])
    return stage(once.join(wanted, ["t1", "t2"]).select("class", "text").mapInArrow(run, schema), "shingle-sets")


def _can_link(a: str, b: str, percent: int) -> str:
    """SQL: two classes with sizes, shingles of their own and bitmaps may reach the threshold."""
    alone = f"100 * least({a}.n - {a}.own, {b}.n - {b}.own) >= {percent} * greatest({a}.n + {b}.own, {b}.n + {a}.own)"
    differ = " + ".join(f"bit_count({a}.{w} ^ {b}.{w})" for w in _WORDS)
    return f"({alone}) AND {100 + percent} * ({a}.n + {b}.n - ({differ})) >= {2 * percent} * ({a}.n + {b}.n)"


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets reach the threshold; a written table."""
    one = pairs.join(sets.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb")), "b")
    both = one.join(sets.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa")), "a")
    shared = both.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).cast("long").alias("shared"))
    return stage(shared.where(F.expr(f"100 * shared >= {percent} * (na + nb - shared)")).select("a", "b"), "confirmed")


def class_links(rows: DataFrame, classes: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """Confirmed links (a, b) that connect the same classes as all links between them do.

    ``classes`` is a written table (class, t1, t2, bands); ``rows`` (id, text) holds their texts.
    """
    keyed = classes.select("class", F.explode("bands").alias("band"))
    shared = keyed.groupBy("band").agg(F.min("class").alias("least"), F.max("class").alias("most")).where("least < most").select("band")
    members = stage(keyed.join(shared, "band").select("band", "class"), "members")
    sets = shingle_sets(rows, members.select("class").distinct().join(classes.select("class", "t1", "t2"), "class"), shingle)
    alone = sets.select("class", F.explode("shingles").alias("s")).groupBy("s").agg(F.min("class").alias("class"), F.count("*").alias("held")).where("held = 1")
    own = alone.groupBy("class").agg(F.count("*").alias("own"))
    sizes = sets.drop("shingles").join(own, "class", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    able = stage(sizes.where(f"100 * (n - own) >= {percent} * n"), "able")
    members = stage(members.join(able, "class").select("band", F.struct("class", "n", "own", *_WORDS).alias("m")), "able-members")

    heads = members.groupBy("band").agg(F.min("m").alias("head"))
    star = members.join(heads, "band").where("m.class <> head.class").where(_can_link("m", "head", percent))
    first = confirmed(star.select(F.col("head.class").alias("a"), F.col("m.class").alias("b")).distinct(), sets, percent)

    found = connected_components(first)
    placed = members.join(found, F.col("m.class") == F.col("node"), "left").select("band", "m", F.coalesce("component", F.col("m.class")).alias("c"))
    placed = stage(placed, "placed")
    groups = placed.groupBy("band", "c").agg(F.count("*").alias("rows")).groupBy("band").agg(F.max_by("c", "rows").alias("main"), F.count("*").alias("components"))
    split = stage(placed.join(groups.where("components > 1"), "band"), "split")
    minor = split.where("c <> main").select(F.col("band").alias("minor_band"), F.col("m").alias("x"), F.col("c").alias("cx"))
    met = split.join(minor, F.expr("band = minor_band AND c <> cx")).where(_can_link("m", "x", percent))
    pairs = met.select(F.least("m.class", "x.class").alias("a"), F.greatest("m.class", "x.class").alias("b")).distinct()
    return first.unionByName(confirmed(pairs, sets, percent))


def near_duplicates(
    rows: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, bands: int = BANDS, band_rows: int = BAND_ROWS, seed: int = SEED
) -> DataFrame:
    """(id, n, component) of every row (id, text): the size of its set and the smallest id that its links reach, its own included."""
    found = marked(rows, shingle, bands, band_rows, seed)
    real = found.where("n > 0")
    keys = ["t1", "t2", "bands"]  # of equal sets, any text will do
    classes = stage(real.groupBy("d1", "d2").agg(F.min(ROW).alias("class"), F.min("id").alias("first_id"), F.first(F.struct(*keys)).alias("k")).select("d1", "d2", "class", "first_id", "k.*"), "classes")
    member = connected_components(class_links(rows, classes, percent, shingle))
    known = classes.join(member, F.col("class") == F.col("node"), "left").select("d1", "d2", "first_id", F.coalesce("component", "class").alias("c"))
    known = stage(known, "members")
    heads = known.groupBy("c").agg(F.min("first_id").alias("component"))
    resolved = stage(known.join(heads, "c").select("d1", "d2", "component"), "resolved")
    return real.join(resolved, ["d1", "d2"]).select("id", "n", "component").unionByName(found.where("n = 0").select("id", "n", F.col("id").alias("component")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group: the one with the smallest id, then the first row. Columns as given."""
    names = [f"c{k}" for k in range(len(docs.columns))]  # safe whatever the columns are called
    safe = dict(zip(docs.columns, names))
    whole = stage(with_row_number(docs.toDF(*names)), "marked")
    # places in the order of ids, nulls last, are the ids of the rows: so a group's smallest place is the row that stays
    order = F.struct(F.col(safe[id_col]).isNull().alias("n"), F.col(safe[id_col]).alias("id"), F.col(ROW).alias("row"))
    found = near_duplicates(whole.select(order.alias("id"), F.col(safe[text]).cast("string").alias("text")), **options)
    kept = found.where("id = component").select(F.col("id.row").alias(ROW))
    return whole.join(kept, ROW, "left_semi").select(*names).toDF(*docs.columns)


def minhash_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document."""
    rows = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text}`"].cast("string").alias("text"))
    found = near_duplicates(rows, **options)
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept")
    )
