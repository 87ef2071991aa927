"""Importance resampling towards a target distribution.

A feature is a run of 1 to ``order`` consecutive words of a text; words are runs of
ASCII letters and digits (A-Z lower-cased) and of characters beyond ASCII. A
feature falls into the bucket of the CRC-32 of its UTF-8 bytes modulo
``BUCKETS``. Bucket counts of the raw and of the target texts give each bucket a
gain, the log ratio of the two smoothed shares in thousandths. The weight of a
document is the sum of the gains of its features, its score the weight and a
Gumbel variate that depends on seed and id only: the highest scores are a draw
without replacement with chances in proportion to the importance weights.

A batch of texts is one run of Arrow kernels: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode`` turn it into
dictionary indices of words. An index next to the index ``k - 1`` places on is a run
of ``k`` words; runs are numbered by distinct (shorter run, word) pairs, so a CRC
is continued once per distinct pair. ``take`` looks up the gains of all features
and a segmented sum adds them up per document.

Scale: texts are read twice, once to count and once to weigh, and never shuffled;
tasks send one row per bucket. Gains are ``BUCKETS`` numbers, whatever the input,
and the only thing that goes through the driver. The draw sorts three numbers a
document by range and numbers the rows from counts per partition.

Null and empty texts have no features, weight 0, a score and no rank. A null id
draws the variate of an empty id. Repeated rows are rows of their own; equal
scores go by id, then by number of features. A text of any length is cut into
pieces at word ends, and runs go on across the cuts. Without target or raw texts
all gains stay finite by the smoothing. An empty table gives an empty result.
Extra columns are ignored by the query; ``draw`` returns them as they came.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from clickloom.llm.common import ROW, blocks, positions, raw_texts, small, with_row_number
from clickloom.session import stage

#: fixed values of the contract: what stands between words, buckets, words in a run, seed, share and least words
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
ORDER = 1
SEED = 2024
SHARE_PERCENT = 10
MIN_WORDS = 20

#: bytes of text that one run of the kernels takes, and the length at which a text is cut
MOST_BYTES = 4 << 20
_IS_WORD = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


def _cut(text: bytes, most: int) -> Iterator[bytes]:
    """Pieces of a text that end between words; a word longer than a piece stays whole."""
    at = 0
    while len(text) - at > most:
        end = at + most
        if _IS_WORD[text[end]]:
            chars = _IS_WORD[np.frombuffer(text, np.uint8, offset=at, count=most)]
            inside = np.flatnonzero(~chars)
            if len(inside):
                end = at + int(inside[-1]) + 1
            else:
                rest = np.flatnonzero(~_IS_WORD[np.frombuffer(text, np.uint8, offset=end)])
                end = end + int(rest[0]) if len(rest) else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Dictionary index of every word, number of words per text, and the dictionary."""
    lowered = pc.ascii_lower(pa.array(texts, pa.binary()).cast(pa.string()))
    lists = pc.split_pattern_regex(lowered, SEPARATORS)
    encoded = pc.dictionary_encode(pc.list_flatten(lists))
    indices = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    words = [w.encode() for w in encoded.dictionary.to_pylist()]
    if b"" in words:  # before a first and after a last separator
        real = indices != words.index(b"")
        owner = np.repeat(np.arange(len(texts)), lengths)
        indices, lengths = indices[real], np.bincount(owner[real], minlength=len(texts))
    return indices, lengths, words


def feature_buckets(
    texts: list[bytes], order: int = ORDER, buckets: int = BUCKETS, tails: list[list[bytes]] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and index of the text of every feature, and the number of words per text.

    ``tails`` are the last words of what was read of each text before; runs go on from
    them, and features that lie in them alone are not given again.
    """
    index, lengths, words = _words(texts)
    owner, new = np.repeat(np.arange(len(texts)), lengths), np.ones(len(index), bool)
    if tails and any(tails):
        number = {w: k for k, w in enumerate(words)}
        before = [number.setdefault(w, len(number)) for tail in tails for w in tail]
        words = list(number)
        owner = np.concatenate([np.repeat(np.arange(len(texts)), [len(t) for t in tails]), owner])
        by = np.argsort(owner, kind="stable")
        index, owner = np.concatenate([np.array(before, np.int64), index])[by], owner[by]
        new = np.concatenate([np.zeros(len(before), bool), new])[by]
    crcs = np.array([zlib.crc32(w) for w in words], np.int64)
    found, owners, run, crc_of_run = [crcs[index[new]] % buckets], [owner[new]], index, crcs
    for k in range(1, min(order, len(index))):
        pairs = run[:-1] * len(words) + index[k:]  # the run of k words that starts here, and the word behind it
        distinct, run = np.unique(pairs, return_inverse=True)
        before, last = np.divmod(distinct, len(words))
        crc_of_run = np.array([zlib.crc32(words[w], zlib.crc32(b" ", c)) for w, c in zip(last.tolist(), crc_of_run[before].tolist())], np.int64)
        keep = (owner[k:] == owner[:-k]) & new[k:]
        found.append(crc_of_run[run[keep]] % buckets)
        owners.append(owner[k:][keep])
    return np.concatenate(found), np.concatenate(owners), lengths


def _features(column: pa.Array, order: int, buckets: int, most: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """The features of a text column, block by block: rows of the block, and what ``feature_buckets`` gives for them."""
    values = raw_texts(column)
    for start, end in blocks([len(v) for v in values], most):
        if end - start > 1 or len(values[start]) <= most:
            yield slice(start, end), *feature_buckets(values[start:end], order, buckets)
            continue
        tail: list[bytes] = []
        for piece in _cut(values[start], most):
            yield slice(start, end), *feature_buckets([piece], order, buckets, [tail])
            if order > 1:
                index, _, words = _words([piece])
                tail = [*tail, *(words[i] for i in index[1 - order :])][1 - order :]


def _text(docs: DataFrame, text: str) -> Column:
    return docs[f"`{text}`"].cast("string").alias("__text")


def bucket_counts(docs: DataFrame, text: str = "text", order: int = ORDER, buckets: int = BUCKETS, most: int = MOST_BYTES) -> DataFrame:
    """(bucket, n): the features of all texts in each bucket that has any."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in small(batches):
            for _, found, _, _ in _features(batch.column(0), order, buckets, most):
                total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    return docs.select(_text(docs, text)).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gain_table(raw: DataFrame, target: DataFrame, text: str = "text", order: int = ORDER, buckets: int = BUCKETS, most: int = MOST_BYTES) -> DataFrame:
    """(bucket, gain) of all buckets: the smoothed log ratio of the shares in target and raw texts, in thousandths, rounded down."""
    nothing = F.lit(0).cast("long")
    every = raw.sparkSession.range(buckets).select(F.col("id").alias("bucket"), nothing.alias("s"), nothing.alias("t"))
    s = bucket_counts(raw, text, order, buckets, most).select("bucket", F.col("n").alias("s"), nothing.alias("t"))
    t = bucket_counts(target, text, order, buckets, most).select("bucket", nothing.alias("s"), F.col("n").alias("t"))
    counts = stage(every.unionByName(s).unionByName(t).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "bucket-counts")
    all_s, all_t = counts.agg(F.sum("s"), F.sum("t")).first()
    top = (F.col("t") + 1).cast("double") * (all_s + buckets)
    bottom = (F.col("s") + 1).cast("double") * (all_t + buckets)
    return counts.select("bucket", F.floor(1000 * F.log(top / bottom)).alias("gain"))


def with_weights(
    docs: DataFrame, gains: DataFrame, keys: list[str], text: str = "text", order: int = ORDER, buckets: int = BUCKETS, most: int = MOST_BYTES
) -> DataFrame:
    """The key columns of each row, its words and features and its weight (``__n_words``, ``__n_features``, ``__weight``)."""
    values = np.zeros(buckets, np.int64)
    for row in gains.collect():  # a row per bucket, whatever the input
        values[row["bucket"]] = row["gain"]
    shared = docs.sparkSession.sparkContext.broadcast(values)
    names = ["__n_words", "__n_features", "__weight"]

    def run(batches):
        table = pa.array(shared.value)
        for batch in small(batches):
            words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for rows, found, owners, n_words in _features(batch.column(0), order, buckets, most):
                gained, n = pc.take(table, pa.array(found)).to_numpy(), rows.stop - rows.start
                words[rows] += n_words
                features[rows] += np.bincount(owners, minlength=n)
                # sums in doubles are whole up to 2 ** 53, far above what a piece can hold
                weight[rows] += np.bincount(owners, gained, n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(words), pa.array(features), pa.array(weight)], [*keys, *names])

    fields = [docs.schema[k] for k in keys] + [StructField(n, LongType()) for n in names]
    return docs.select(_text(docs, text), *(docs[f"`{k}`"] for k in keys)).mapInArrow(run, StructType(fields))


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A Gumbel variate in thousandths, rounded down, from the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(share)))


def ranked(
    docs: DataFrame, target: DataFrame, keys: list[str], id_col: str = "doc_id", text: str = "text", order: int = ORDER, buckets: int = BUCKETS,
    seed: int = SEED, percent: int = SHARE_PERCENT, min_words: int = MIN_WORDS, most: int = MOST_BYTES,
) -> DataFrame:
    """The keys of each row with ``__n_words``, ``__n_features``, ``__weight``, ``__score`` and ``__rank``.

    Of the rows with at least ``min_words`` words, the ``percent`` with the highest scores have a rank, from 1 on.
    """
    weights = with_weights(docs, gain_table(docs, target, text, order, buckets, most), keys, text, order, buckets, most)
    scored = stage(weights.withColumn("__score", F.col("__weight") + gumbel(F.col(f"`{id_col}`"), seed)), "scored")
    enough = F.col("__n_words") >= min_words
    rows = scored.where(enough)
    wanted = rows.count() * percent // 100
    by = [F.col("__score").desc(), F.col(f"`{id_col}`").asc_nulls_last(), F.col("__n_features")]
    placed = positions(rows, by, [], "__rank").withColumn("__rank", F.when(F.col("__rank") < wanted, F.col("__rank") + 1))
    return placed.unionByName(scored.where(~enough).withColumn("__rank", F.lit(None).cast("long")))


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that are drawn, with the columns of ``docs``."""
    names = [f"c{k}" for k in range(len(docs.columns))]  # safe whatever the columns are called
    named = dict(zip(docs.columns, names))
    marked = stage(with_row_number(docs.toDF(*names)), "marked")
    drawn = ranked(marked, target.select(target[f"`{text}`"].alias(named[text])), [ROW, named[id_col]], named[id_col], named[text], **options)
    return marked.join(drawn.where("__rank IS NOT NULL").select(ROW), ROW, "left_semi").select(*names).toDF(*docs.columns)


def importance(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document."""
    found = ranked(docs.select(docs[f"`{id_col}`"].alias("doc_id"), docs[f"`{text}`"].alias("text")), target.select(target[f"`{text}`"].alias("text")), ["doc_id"], **options)
    return found.select("doc_id", *(F.col(f"__{c}").alias(c) for c in ("n_features", "weight", "score", "rank")))
