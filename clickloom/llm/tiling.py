"""Benchmark decontamination by greedy string tiling.

Texts and test items are lower-cased sequences of tokens: runs of letters and
digits, and single characters of scripts that write words without spaces.
Every ``SEED_TOKENS`` consecutive tokens are a seed. A document and an item that
share a seed are a candidate. Greedy string tiling covers the item with the
longest matches first: all matches of the current length are searched by running
Karp-Rabin over the unmarked tokens, compared token by token, and marked when
they overlap no tile yet; then the length is lowered, down to a seed. As tiles
may stand in any order, reordered passages are caught. A document is contaminated
when tiles cover at least ``MIN_COVERAGE`` of the tokens of an item. Items shorter
than a seed share none and match nothing: four common words prove no leak.

Scale: the seeds of the items are added to a bit set of fixed size (a Bloom
filter of ``FILTER_BITS``, whatever the benchmark's size) by tasks and merged, and
only that is broadcast. Tasks keep the stretches of a document whose seeds are in
it: next to nothing for clean documents. Stretches meet items in a join on the
seed, each pair once, and tiling looks at stretches only, since a match of a seed
or more lies inside one. The filter may let a stretch through in vain; it never
loses one. A passage that a third of all documents share is one seed group per
item: its join rows are spread by adaptive execution, and they number documents
times items, never documents times documents.

Null and empty texts and items match nothing. Null ids are kept. Repeated rows and repeated items give a row each.
Empty tables give an empty result. Extra columns are returned by ``clean`` as they
came. Very long texts cost time in proportion to their length.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ROW, small, texts, with_row_number
from clickloom.session import stage

SEED_TOKENS = 5
MIN_COVERAGE = 0.6
#: bits of the filter: 2 MiB for any benchmark
FILTER_BITS = 1 << 24
_FILTER_SEEDS = (1, 2)

_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
_TOKEN = re.compile(rf"[{_UNSPACED}]|[^\W_{_UNSPACED}]+")


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def seeds(words: list[str], n: int = SEED_TOKENS) -> list[str]:
    return list(map(" ".join, zip(*(words[k:] for k in range(n)))))


def _spots(seed: str) -> list[int]:
    return [xxhash.xxh64_intdigest(seed, s) % FILTER_BITS for s in _FILTER_SEEDS]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def seed_filter(items: DataFrame) -> np.ndarray:
    """Bit set of the seeds of all items. Tasks make the bits of their items, and a bitwise or merges them block by block."""

    def spots(batches):
        for batch in small(batches):
            found = {at for words in batch.column(0).to_pylist() for seed in seeds(words) for at in _spots(seed)}
            places = np.array(sorted(found), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(places >> 5), pa.array(np.left_shift(1, places & 31))], ["block", "bits"])

    words = items.select("words").mapInArrow(spots, "block bigint, bits bigint").groupBy("block").agg(F.expr("bit_or(bits)").alias("bits"))
    rows = words.toArrow()  # FILTER_BITS / 32 rows at most
    blocks = np.zeros(FILTER_BITS // 32, np.uint32)
    blocks[rows.column("block").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return blocks


def benchmark_items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Item number, id and tokens in a written table. Items shorter than a seed are left out."""

    def run(batches):
        for batch in small(batches):
            found = pa.array([tokens(x) for x in texts(batch.column(2))], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], found], ["item", "item_id", "words"])

    rows = benchmark.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    schema = "item bigint, item_id bigint, words array<string>"
    return stage(rows.mapInArrow(run, schema).where(F.size("words") >= SEED_TOKENS), "items")


def _stretches(words: list[str], blocks: np.ndarray) -> list[list[str]]:
    """The runs of tokens that are covered by seeds in the filter."""
    parts = seeds(words)
    if not parts:
        return []
    first = np.fromiter((xxhash.xxh64_intdigest(p, _FILTER_SEEDS[0]) % FILTER_BITS for p in parts), np.int64, len(parts))
    hits = np.flatnonzero(blocks[first >> 5] >> (first & 31).astype(np.uint32) & 1)
    out: list[list[str]] = []
    start = end = 0
    for at in hits.tolist():
        second = xxhash.xxh64_intdigest(parts[at], _FILTER_SEEDS[1]) % FILTER_BITS
        if int(blocks[second >> 5]) >> (second & 31) & 1:
            if at > end:
                out.append(words[start:end])
                start = at
            end = at + SEED_TOKENS
    return [s for s in [*out, words[start:end]] if s]


def greedy_string_tiling(text: list[int], test: list[int], least: int) -> list[tuple[int, int, int]]:
    """Tiles (start in test, start in text, length) that cover ``test`` with matches from ``text``, longest first.

    Negative numbers match nothing; they separate stretches. Ties go to the leftmost start in the test, then in the text.
    """
    free_text = [w >= 0 for w in text]
    free_test = [w >= 0 for w in test]
    tiles = []
    length = max(least, len(test) // 2)
    while True:
        matches = _running_karp_rabin(text, test, free_text, free_test, length)
        longest = max((m[2] for m in matches), default=0)
        if longest > 2 * length:
            length = longest  # such a long one first: search again with its length
        elif matches:
            for i, j, n in sorted(m for m in matches if m[2] == longest):
                if all(free_test[i : i + n]) and all(free_text[j : j + n]):
                    tiles.append((i, j, n))
                    free_test[i : i + n] = [False] * n
                    free_text[j : j + n] = [False] * n
        elif length > least:
            length = max(least, length // 2)
        else:
            return sorted(tiles)


_BASE, _PRIME = 1_000_003, (1 << 61) - 1


def _window_hashes(words: list[int], free: list[bool], n: int):
    """(start, Karp-Rabin hash) of every window of ``n`` free tokens, each hash rolled on from the one before."""
    lead = pow(_BASE, n - 1, _PRIME)
    value, run = 0, 0
    for at, word in enumerate(words):
        if not free[at]:
            value, run = 0, 0
            continue
        if run >= n:
            value -= (words[at - n] + 1) * lead
        else:
            run += 1
        value = (value * _BASE + word + 1) % _PRIME
        if run >= n:
            yield at - n + 1, value


def _running_karp_rabin(text, test, free_text, free_test, n) -> list[tuple[int, int, int]]:
    """Maximal matches of at least ``n`` free tokens, as (start in test, start in text, length)."""
    table: dict[int, list[int]] = {}
    for at, value in _window_hashes(test, free_test, n):
        table.setdefault(value, []).append(at)
    matches = []
    for j, value in _window_hashes(text, free_text, n):
        for i in table.get(value, ()):
            if i and j and free_test[i - 1] and free_text[j - 1] and test[i - 1] == text[j - 1]:
                continue  # part of a match that begins further left
            if test[i : i + n] != text[j : j + n]:
                continue
            k = n
            while i + k < len(test) and j + k < len(text) and free_test[i + k] and free_text[j + k] and test[i + k] == text[j + k]:
                k += 1
            matches.append((i, j, k))
    return matches


def tile_pair(stretches: list[list[str]], item: list[str]) -> list[tuple[int, int, int]]:
    """Tiles of an item in the stretches of a document."""
    number = {w: k for k, w in enumerate(dict.fromkeys(item))}
    text: list[int] = []
    for stretch in stretches:
        text += [number.get(w, -1) for w in stretch]
        text.append(-1)
    return greedy_string_tiling(text, [number[w] for w in item], SEED_TOKENS)


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """A row per document row and item that tiles cover to ``min_coverage``: doc_id, text_md5, item_id, n_tokens, covered and tiles."""
    spark = docs.sparkSession
    items = benchmark_items(benchmark)
    shared = spark.sparkContext.broadcast(seed_filter(items).tobytes())

    def find(batches):
        blocks = np.frombuffer(shared.value, np.uint32)
        for batch in small(batches):
            rows, sums, found, hashes = [], [], [], []
            for k, value in enumerate(texts(batch.column(1))):
                stretches = _stretches(tokens(value), blocks)
                if stretches:
                    rows.append(k)
                    sums.append(hashlib.md5(value.encode()).hexdigest())
                    found.append(stretches)
                    hashes.append([_signed(xxhash.xxh64_intdigest(s)) for s in {s for words in stretches for s in seeds(words)}])
            keys = batch.column(0).take(pa.array(rows, pa.int64()))
            kinds = [pa.string(), pa.list_(pa.list_(pa.string())), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([keys, *map(pa.array, (sums, found, hashes), kinds)], ["doc_id", "text_md5", "stretches", "seeds"])

    schema = "doc_id bigint, text_md5 string, stretches array<array<string>>, seeds array<bigint>"
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = stage(with_row_number(narrow.mapInArrow(find, schema)), "stretches")

    def item_seeds(batches):
        for batch in small(batches):
            pairs = [(k, _signed(xxhash.xxh64_intdigest(s))) for k, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for s in set(seeds(words))]
            yield pa.RecordBatch.from_arrays([pa.array([p[c] for p in pairs], pa.int64()) for c in (0, 1)], ["item", "seed"])

    seeded = items.select("item", "words").mapInArrow(item_seeds, "item bigint, seed bigint")
    candidates = found.select(ROW, F.explode("seeds").alias("seed")).join(seeded, "seed").select(ROW, "item").distinct()
    pairs = candidates.join(found.drop("seeds"), ROW).join(items, "item").repartition(ROW, "item")
    pairs = pairs.select("doc_id", "text_md5", "item_id", "stretches", "words")

    def tile(batches):
        kind = pa.list_(pa.struct([("item_start", pa.int32()), ("length", pa.int32())]))
        for batch in small(batches):
            words = batch.column(4).to_pylist()
            tiles = [tile_pair(s, w) for s, w in zip(batch.column(3).to_pylist(), words)]
            sizes = pa.array([len(w) for w in words], pa.int64())
            covered = pa.array([sum(n for _, _, n in t) for t in tiles], pa.int64())
            listed = pa.array([[{"item_start": i, "length": n} for i, _, n in t] for t in tiles], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], sizes, covered, listed], ["doc_id", "text_md5", "item_id", "n_tokens", "covered", "tiles"])

    out = "doc_id bigint, text_md5 string, item_id bigint, n_tokens bigint, covered bigint, tiles array<struct<item_start: int, length: int>>"
    return pairs.mapInArrow(tile, out).where(F.col("covered") >= min_coverage * F.col("n_tokens"))


def contaminated(docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """The documents that hold a test item: doc_id, item_id, tokens of the item, those covered, share and number of tiles."""
    found = matches(docs, benchmark, min_coverage=min_coverage)
    return found.select("doc_id", "item_id", "n_tokens", "covered", (F.col("covered") / F.col("n_tokens")).alias("coverage"), F.size("tiles").alias("n_tiles"))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that hold no test item; columns as given. Rows go by their text, which alone decides."""
    hit = stage(matches(docs, benchmark, text=text, **options).select("text_md5").distinct(), "contaminated")
    return docs.join(hit, F.md5(F.col(text).cast("binary")) == F.col("text_md5"), "left_anti")
