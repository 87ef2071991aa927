"""Quality rules by cross-document line frequency.

Lines are normalised (A-Z lower-cased, digits to 0, white space to one space) and
hashed. For every host the distinct documents that hold a line are counted;
copies of one text count once, so that a document is not boilerplate because it
was fetched often. A line is above the limit in a host when it stands in more
than ``MIN_DOCS`` documents and in more than ``MAX_SHARE`` of the host's. Lines above
the limit are removed. A document is depleted when less than ``MIN_LEFT`` of its
words are left; depleted documents are rejected, as are those that fail the base
rule (fewer than 50 words, or over half of the words in repeated 3-word windows).

The query and the filter count alike, as the SQL does. A group of more than ``MIN_DOCS`` near copies lifts its own
lines above the limit, so all its members are depleted, just as pages that are mostly boilerplate. ``clean``
then gives back one member, whole, of each class of near copies of which no member is left: something
remains for the dedup that follows, and no count changes. Texts with equal minima of ``BAND_ROWS`` hash orders of
their 5-word windows (A-Z lower-cased, digits to 0) in one of ``BANDS`` bands are compared with the smallest of them; a
share of ``MIN_EQUAL`` of all minima links them, and linked texts are a class. By the formula 0.95 of pairs with a
similarity of 0.8 meet in a band, and nearly all of 0.9. Only documents that lost half as much as a depleted
one are looked at: a near copy of a depleted document has lost nearly the same lines.

Scale: texts are read once by tasks that give counts, hashes and word numbers;
only these are written and shuffled. The distinct count has two partial steps,
so a line that a third of all documents share is added up before its shuffle.
The table of lines above the limit is joined by adaptive execution, which
splits the partition of a very common line; nothing is broadcast beyond Spark's
own size check. Near copies are linked to the smallest text hash of their band,
never all pairs.

Null texts have no words and fail the base rule. Documents without a host are a
host of their own. Null ids and repeated rows are kept, one result per row. An
empty table gives an empty table. Extra columns stay as they are in ``clean``, whatever their names, and
are ignored by the query.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from clickloom.llm.common import ROW, small, texts, with_row_number
from clickloom.llm.components import connected_components
from clickloom.session import stage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: a line is above the limit in more documents of a host than this
MIN_DOCS = 20
#: and in more than this share of the host's documents
MAX_SHARE = 0.001
#: share of words that must be left
MIN_LEFT = 0.5
#: bands of a text, and hash orders whose minima must all be equal in one of them
BANDS, BAND_ROWS = 16, 8
#: share of equal minima that confirms a link: the similarity itself, less four standard errors
MIN_EQUAL = 0.67
#: words of a window
WINDOW = 5
#: fixed values of the contract: symbols, and the white space between words
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

_NORMAL = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {ord(c): "0" for c in "123456789"}
_NORMAL_BYTES = bytes(ord(_NORMAL.get(c, chr(c))) if c < 128 else c for c in range(256))
_ORDERS = np.random.default_rng(0).integers(0, 1 << 63, BANDS * BAND_ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PIECE = 4096
_MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_LINES = ArrayType(StructType([StructField("line", LongType()), StructField("words", LongType())]))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def measure(text: str) -> tuple[int, int, int, int, int, list[tuple[int, int]]]:
    """Words, code points in words, symbols, repeated lines, words in repeated 3-word windows, and (hash, words) of each line."""
    # str.split() would also cut at other Unicode spaces; bytes know the six only
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen, repeated, lines = set(), 0, []
    for line in text.split("\n"):
        parts = line.translate(_NORMAL).encode().split()
        if not parts:
            continue
        repeated += line in seen
        seen.add(line)
        lines.append((_signed(xxhash.xxh64_intdigest(b" ".join(parts))), len(parts)))
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = 0
    if len(windows) < len(words) - 2:
        upto = 0  # words before this are counted
        for at, window in enumerate(zip(words, words[1:], words[2:])):
            if windows[window] > 1:
                covered += at + 3 - max(at, upto)
                upto = at + 3
    return len(words), chars, symbols, repeated, covered, lines


def near_copy_minima(text: str) -> np.ndarray:
    """The minima of a text's windows under each hash order: near copies share most of them. No words give none."""
    words = text.encode().translate(_NORMAL_BYTES).split()
    if not words:
        return np.empty(0, np.uint64)
    windows = map(b" ".join, zip(*(words[k:] for k in range(WINDOW)))) if len(words) > WINDOW else (b" ".join(words),)
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, windows)), np.uint64)
    return np.min([(hashes[at : at + _PIECE, None] * _ORDERS).min(axis=0) for at in range(0, len(hashes), _PIECE)], axis=0)


def near_copy_bands(minima: np.ndarray) -> list[int]:
    """A hash per band of minima."""
    return [_signed(xxhash.xxh64_intdigest(band.tobytes(), k)) for k, band in enumerate(minima.reshape(-1, BAND_ROWS))]


def measured(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The counts of each row, its text hash and its lines in a written table, next to the columns to keep and a row number."""
    keep = docs.columns if keep is None else keep
    spots, at = [docs.columns.index(c) for c in keep], docs.columns.index(text)
    names = [*keep, *(f"__{m}" for m in _MEASURES), "__text_hash", "__lines"]
    kind = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))

    def run(batches):
        for batch in small(batches):
            values = texts(batch.column(at))
            found = [(*measure(x), _signed(xxhash.xxh64_intdigest(x))) for x in values]
            counts = [pa.array([r[k] for r in found], pa.int64()) for k in (0, 1, 2, 3, 4, 6)]
            lines = pa.array([[{"line": a, "words": b} for a, b in r[5]] for r in found], kind)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in spots), *counts, lines], names)

    longs = [StructField(f"__{n}", LongType()) for n in (*_MEASURES, "text_hash")]
    schema = StructType([*(docs.schema.fields[k] for k in spots), *longs, StructField("__lines", _LINES)])
    return stage(with_row_number(docs.mapInArrow(run, schema)), "measured")


def near_copy_classes(banded: DataFrame) -> DataFrame:
    """(node, component): the text hash of each text that has near copies, and the smallest one of its class; ``banded`` has text_hash, minima and bands."""
    once = banded.groupBy("text_hash").agg(F.first(F.struct("minima", "bands")).alias("s")).select("text_hash", "s.*")
    each = once.select("text_hash", F.explode("bands").alias("band"))
    ends = each.groupBy("band").agg(F.min("text_hash").alias("head"), F.max("text_hash").alias("last"))
    pairs = each.join(ends.where("head < last"), "band").where("text_hash <> head").select("text_hash", "head").distinct()
    both = pairs.join(once.select("text_hash", "minima"), "text_hash").join(once.select(F.col("text_hash").alias("head"), F.col("minima").alias("of_head")), "head")
    equal = F.size(F.filter(F.zip_with("minima", "of_head", lambda a, b: a == b), lambda x: x))
    return connected_components(stage(both.where(equal >= MIN_EQUAL * BANDS * BAND_ROWS).select("text_hash", "head"), "near-copies"), "text_hash", "head")


def _with_bands(batches):
    """(row, kept, text_hash, text) with minima and bands instead of the text."""
    for batch in small(batches):
        minima = [near_copy_minima(x) for x in texts(batch.column(3))]
        lists = [pa.array([m.view(np.int64) for m in minima], pa.list_(pa.int64())), pa.array(map(near_copy_bands, minima), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists], ["row", "kept", "text_hash", "minima", "bands"])


def survivors(found: DataFrame, judged: DataFrame, text: str, min_left: float) -> DataFrame:
    """(row) of one member, the one with the smallest text hash, of each class of near copies without a member that is kept."""
    much = F.col("n_removed_words") >= (1 - min_left) / 2 * F.col("n_words")
    lost = stage(judged.where(~F.col("base_failed") & (F.col("n_removed_words") > 0) & much).select("row", "kept"), "lost")
    rows = found.join(lost, F.col(ROW) == F.col("row")).select("row", "kept", F.col("__text_hash").alias("text_hash"), text)
    banded = stage(rows.mapInArrow(_with_bands, "row long, kept boolean, text_hash long, minima array<long>, bands array<long>"), "banded")
    members = banded.join(near_copy_classes(banded), F.col("text_hash") == F.col("node"))
    heads = members.groupBy("component").agg(F.max("kept").alias("any_kept"), F.min(F.struct("text_hash", "row")).alias("head"))
    return heads.where("NOT any_kept").select("head.row")


def lines_above_limit(lines: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """(host, line) of the lines that too many distinct texts of a host hold; ``lines`` has host, text_hash and line."""
    counts = lines.distinct().groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > min_docs)
    sizes = lines.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    over = counts.alias("c").join(sizes.alias("s"), F.expr("c.host <=> s.host")).where(F.col("docs") > max_share * F.col("host_docs"))
    return over.select("c.host", "line")


def verdicts(
    found: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, min_left: float = MIN_LEFT
) -> DataFrame:
    """Counts and verdict per row of a table made by ``measured``.

    Columns: the row number, the counts, ``base_failed``, ``n_removed_words``, ``removed`` (hashes of removed lines)
    and ``kept``.
    """
    rows = found.select(F.col(ROW).alias("row"), F.col(host).cast("string").alias("host"), F.col("__text_hash").alias("text_hash"), F.col("__lines").alias("lines"))
    each = rows.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.line", "l.words")
    lines = rows.select("host", "text_hash", F.explode("lines.line").alias("line"))
    above = stage(lines_above_limit(lines.select("host", "line", "text_hash"), min_docs, max_share), "above-limit")
    hits = each.alias("e").join(above.alias("a"), F.expr("e.line = a.line and e.host <=> a.host"))
    removed = hits.groupBy("row").agg(F.sum("e.words").alias("n_removed_words"), F.collect_set("e.line").alias("removed"))
    counts = found.select(F.col(ROW).alias("row"), *(F.col(f"__{m}").alias(m) for m in _MEASURES))
    whole = counts.join(removed, "row", "left").withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = F.col("n_words") - F.col("n_removed_words") < min_left * F.col("n_words")
    return whole.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def _without(batches, text_at: int, chars_at: int | None, removed_at: int, columns: list[str]):
    """The columns without the removed lines in the text, with the number of code points brought up to date."""
    for batch in small(batches):
        found = []
        for value, removed in zip(batch.column(text_at).to_pylist(), batch.column(removed_at).to_pylist()):
            if value and removed:
                gone = set(removed)
                keep = []
                for line in value.split("\n"):
                    parts = line.translate(_NORMAL).encode().split()
                    if not parts or _signed(xxhash.xxh64_intdigest(b" ".join(parts))) not in gone:
                        keep.append(line)
                value = "\n".join(keep)
            found.append(value)
        arrays = list(batch.columns[: len(columns)])
        arrays[text_at] = pa.array(found, pa.string())
        if chars_at is not None:
            changed = zip(found, batch.column(removed_at).to_pylist(), arrays[chars_at].to_pylist())
            arrays[chars_at] = pa.array([len(t) if gone and t is not None else n for t, gone, n in changed], arrays[chars_at].type)
        yield pa.RecordBatch.from_arrays(arrays, columns)


def clean(docs: DataFrame, text: str = "text", host: str = "source", chars: str = "n_chars", **limits) -> DataFrame:
    """The documents that the rules keep, without the lines above the limit, and the survivors of near copies, whole; columns as given."""
    names = [f"c{k}" for k in range(len(docs.columns))]  # safe whatever the columns are called
    safe = dict(zip(docs.columns, names))
    named = docs.toDF(*names)
    found = measured(named, safe[text])
    judged = stage(verdicts(found, safe[host], **limits).select("row", "base_failed", "kept", "n_words", "n_removed_words", "removed"), "judged")
    left = judged.where("kept").select("row", "removed")
    back = survivors(found, judged, safe[text], limits.get("min_left", MIN_LEFT)).select("row", F.lit(None).cast("array<long>").alias("removed"))
    joined = found.join(left.unionByName(back), F.col(ROW) == F.col("row")).select(*names, "removed")
    at, chars_at = names.index(safe[text]), names.index(safe[chars]) if chars in safe else None
    return joined.mapInArrow(lambda batches: _without(batches, at, chars_at, len(names), names), named.schema).toDF(*docs.columns)


def report(docs: DataFrame, **limits) -> DataFrame:
    """Counts and verdict of each document."""
    found = measured(docs.select("doc_id", "source", "text"), keep=["doc_id", "source"])
    result = found.select(ROW, "doc_id").join(verdicts(found, **limits), F.col(ROW) == F.col("row"))
    return result.select("doc_id", *_MEASURES, "base_failed", "kept", "n_removed_words")
