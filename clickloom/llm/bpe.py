"""Byte-level BPE encoding and decoding by merge replay over a corpus of words.

Each text is cut into words by the tokenizer's pattern. The distinct words that
a task meets form its corpus. Their bytes lie in one array of tokens with links
to both neighbours, and an inverted index leads from the rank of a token pair to
the positions where that pair stands. Merges are applied in rank order, each to
all of its positions at once; a merge only looks at the two neighbours it
touches and files the pairs that it makes. A pair with a rank below the current
one is taken up at once, as the lowest rank in a word always goes first.

Merges in one word never depend on another, so the corpus can be cut anywhere
without changing an id. Here it is cut at ``BLOCK_CHARS`` of text, and words
known from earlier blocks, or earlier tasks of the same worker, are not replayed
again; beyond ``KNOWN_BYTES`` the store keeps the frequent ones. There is no shuffle. Memory per
task is bounded by these two numbers and by the ids of one text.

Null and empty texts have no tokens. Repeated rows and ties play no part, since
rows are independent; other columns are kept as they are, null ids too. An empty
table gives an empty table. Very long texts are read word by word in blocks, and
a single very long word costs time in proportion to its length times its logarithm.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from itertools import islice, repeat
from sys import getsizeof

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from clickloom.llm.common import blocks, small, texts

BLOCK_CHARS = 500_000
BLOCK_WORDS = 125_000
#: bytes of the words that a worker keeps from block to block and task to task
KNOWN_BYTES = 32 << 20
#: of these, bytes of a word besides its string and its ids: a place in the dictionary and counters
WORD_BYTES = 100
#: largest rank file that is sent to every executor
MOST_VOCABULARY_BYTES = 64 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of base64 tokens and ranks, one pair a line."""
    with open(path, "rb") as file:
        data = file.read(MOST_VOCABULARY_BYTES + 1)
    if len(data) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than a vocabulary may be ({MOST_VOCABULARY_BYTES} bytes)")
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def pair_ranks(ranks: dict[bytes, int]) -> dict[int, dict[int, int]]:
    """Rank of every pair of tokens that joins to a token, by left and then right token."""
    found: dict[int, dict[int, int]] = {rank: {} for rank in [-1, *ranks.values()]}  # -1: no token
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                found[left][right] = rank
    return found


def replay(words: list[bytes], ranks: dict[bytes, int], pairs: dict[int, dict[int, int]]) -> tuple[list[int], list[int]]:
    """Ids of all words in one list, and the number of ids of each word."""
    single = [ranks[bytes((b,))] for b in range(256)]
    # tokens by position, -1 between words and where a token has gone; neighbours by position
    token: list[int] = [-1]
    starts: list[int] = []
    for word in words:
        starts.append(len(token))
        whole = ranks.get(word)
        if whole is None:
            token.extend(map(single.__getitem__, word))
        else:
            token.append(whole)
        token.append(-1)
    size = len(token)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    index: dict[int, list[int]] = {}
    for at, (left, right) in enumerate(zip(token, islice(token, 1, None))):
        rank = pairs[left].get(right)
        if rank is not None:
            if rank in index:
                index[rank].append(at)
            else:
                index[rank] = [at]
    queue = list(index)
    heapq.heapify(queue)
    while queue:
        rank = heapq.heappop(queue)
        places = index.pop(rank)
        if len(places) > 1:
            places.sort()  # the leftmost of overlapping pairs goes first
        onward = pairs[rank]
        for at in places:
            other = after[at]
            if pairs[token[at]].get(token[other]) != rank:
                continue  # one of the two has been merged meanwhile
            token[at] = rank
            token[other] = -1
            follows = after[at] = after[other]
            before[follows] = at
            new = onward.get(token[follows])
            if new is not None:
                if new in index:
                    index[new].append(at)
                else:
                    index[new] = [at]
                    heapq.heappush(queue, new)
            first = before[at]
            new = pairs[token[first]].get(rank)
            if new is not None:
                if new in index:
                    index[new].append(first)
                else:
                    index[new] = [first]
                    heapq.heappush(queue, new)
    alive = np.fromiter(token, np.int64, size) >= 0
    ends = np.concatenate([[0], np.cumsum(alive)])
    return [t for t in token if t >= 0], np.diff(ends[[*starts, size]]).tolist()


class Corpus:
    """The distinct words met so far with their ids, as flat arrays. Only speeds up: any word can be replayed again."""

    def __init__(self, ranks: dict[bytes, int], pairs: dict[int, dict[int, int]], most: int = KNOWN_BYTES):
        self.ranks, self.pairs, self.most = ranks, pairs, most
        self.held = 0  # bytes
        self.place: dict[str, int] = {}
        self.ids = np.empty(0, np.uint32)
        self.starts = np.zeros(1, np.int64)
        self.seen = np.empty(0, np.int64)

    def _forget(self) -> None:
        """Keep the words that were seen most often, half of the store's bytes at most."""
        names = list(self.place)
        sizes = np.fromiter(map(getsizeof, names), np.int64, len(names)) + 4 * np.diff(self.starts) + WORD_BYTES
        least = 1
        while sizes[self.seen > least].sum() > self.most // 2:
            least *= 2
        kept = np.flatnonzero(self.seen > least)
        self.held = int(sizes[kept].sum())
        self.ids, counts = self._ids_of(kept)
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        self.place = {names[k]: n for n, k in enumerate(kept.tolist())}
        self.seen = self.seen[kept]

    def _ids_of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = self.starts[which]
        counts = self.starts[which + 1] - starts
        ends = np.cumsum(counts)
        return self.ids[np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)], counts

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a run of words, and the number of ids of each."""
        which = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(which < 0).tolist()
        if missing:
            new = list(dict.fromkeys(words[k] for k in missing))
            ids, counts = replay([w.encode() for w in new], self.ranks, self.pairs)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.ids = np.concatenate([self.ids, np.array(ids, np.uint32)])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
            self.seen = np.append(self.seen, np.zeros(len(new), np.int64))
            which[missing] = np.fromiter((self.place[words[k]] for k in missing), np.int64, len(missing))
            self.held += sum(map(getsizeof, new)) + 4 * len(ids) + WORD_BYTES * len(new)
        self.seen += np.bincount(which, minlength=len(self.place))
        found = self._ids_of(which)
        if self.held > self.most:
            self._forget()
        return found


#: words that this worker knows, by the run that they belong to; one run at a time
_KNOWN: dict[str, Corpus] = {}


def _corpus(run: str, shared) -> Corpus:
    """The worker's store for a run of ``encode``. Only its copy of the vocabulary comes from outside."""
    if run not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[run] = Corpus(**shared.value)
    return _KNOWN[run]


def _encode_block(corpus: Corpus, pattern, rows: list[str]) -> list[bytes]:
    if len(rows) == 1 and len(rows[0]) > BLOCK_CHARS:
        found, parts = pattern.finditer(rows[0]), []
        while words := [m.group() for m in islice(found, BLOCK_WORDS)]:
            parts.append(corpus.encode(words)[0].astype("<u4").tobytes())
        return [b"".join(parts)]
    words: list[str] = []
    ends = [0]
    for text in rows:
        words += pattern.findall(text)
        ends.append(len(words))
    ids, counts = corpus.encode(words)
    cuts = np.concatenate([[0], np.cumsum(counts)])[ends] * 4
    data = ids.astype("<u4").tobytes()
    return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def _bytes_of(ids: bytes, tokens: dict[int, bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", name: str = "token_ids", keep_text: bool = False, decoded: str | None = None
) -> DataFrame:
    """``docs`` with the token ids of the text as little-endian unsigned 32-bit integers in a binary column.

    ``path`` names a file of token ranks and ``pattern`` cuts texts into words; no special tokens are known.
    ``decoded`` names a column for the bytes that the ids stand for, made from the ids in the same pass.
    """
    ranks = read_ranks(path)
    name_of_run = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": ranks, "pairs": pair_ranks(ranks)})
    made = [name, decoded] if decoded else [name]
    rest = [c for c in docs.columns if keep_text or c != text]
    spots, at = [docs.columns.index(c) for c in rest], docs.columns.index(text)

    def run(batches):
        corpus = _corpus(name_of_run, shared)
        cut = regex.compile(pattern)
        tokens = {rank: token for token, rank in corpus.ranks.items()} if decoded else {}
        for batch in small(batches):
            rows = texts(batch.column(at))
            for start, end in blocks([len(x) for x in rows], BLOCK_CHARS):
                part = batch.slice(start, end - start)
                ids = _encode_block(corpus, cut, rows[start:end])
                new = [ids, [_bytes_of(x, tokens) for x in ids]] if decoded else [ids]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in spots), *map(_binary, new)], [*rest, *made])

    fields = [f for f in docs.schema.fields if f.name in rest]
    return docs.mapInArrow(run, StructType([*fields, *(StructField(m, BinaryType()) for m in made)]))


def decode(tokens: DataFrame, path: str, ids: str = "token_ids", name: str = "decoded") -> DataFrame:
    """``tokens`` with the bytes that the ids stand for in a binary column. Null ids give null."""
    ranks = read_ranks(path)
    shared = tokens.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})
    columns, at = tokens.columns, tokens.columns.index(ids)

    def run(batches):
        tokens_of = shared.value
        for batch in small(batches):
            found = _binary([None if x is None else _bytes_of(x, tokens_of) for x in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*columns, name])

    return tokens.mapInArrow(run, StructType([*tokens.schema.fields, StructField(name, BinaryType())]))


def multi_language_vocabulary() -> tuple[str, str]:
    """Rank file and word pattern of the public byte-level vocabulary for many languages."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def with_digests(coded: DataFrame, keep_ids: bool = False) -> DataFrame:
    """Decoded rows with the number and SHA-256 of their ids and the SHA-256 of the decoded bytes, in place of the bytes."""
    rest = [c for c in coded.columns if c != "decoded" and (keep_ids or c != "token_ids")]
    return coded.selectExpr(
        *(f"`{c}`" for c in rest),
        "cast(octet_length(token_ids) div 4 as bigint) as n_tokens",
        "sha2(token_ids, 256) as ids_sha256",
        "sha2(decoded, 256) as decoded_sha256",
    )


def digests(docs: DataFrame) -> DataFrame:
    """Number and SHA-256 of the ids of each document, and SHA-256 of the bytes decoded from them."""
    path, pattern = multi_language_vocabulary()
    return with_digests(encode(docs.select("doc_id", "text"), path, pattern, decoded="decoded"))
