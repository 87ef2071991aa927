"""Token ids as flat files of unsigned integers with 64-bit document offsets.

Documents are range-partitioned and sorted by id; each task encodes its part
with the tokenizers library and writes three files: the ids of all its documents
one after the other, the offsets of the documents in them (one more than there
are documents), and the document ids. A manifest, written by Spark, has one row
per part. The base of a part is the sum of the tokens of all parts before it.
Readers map the files into memory where the file system is local and read them
through its interface elsewhere.

Ids are stored as 16-bit integers when the vocabulary allows it, else as 32-bit.
The tokenizer drops white space, so a text is the sum of the chunks between
white space; distinct chunks of a block go to the library once, many in one call.
Special tokens that stand in a text are found by the library as usual, and hold
no blanks.

Scale: one shuffle, of the documents by id; the driver sees nothing but the
tokenizer file, whose size is checked. The manifest's running sum is one row per
part. Parts have ``PART_ROWS`` documents or so, and a part is streamed: memory holds
one batch. A part file gets its final name when it is whole, under a name of its
task attempt, so that lost or repeated tasks leave no half-written or doubled
part: readers follow the manifest only.

Null and empty texts have the end token only. Null ids come first, equal ids are
ordered by a hash of their text and repeated rows are written each. An empty
table has an empty manifest and gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.common import blocks, raw_texts, small
from clickloom.session import new_path, stage

END_ID = 1
BLOCK_BYTES = 2_000_000
KNOWN_CHUNKS = 600_000
LEARN_CHUNKS = 100
MARK = b"\x01"
#: what the last token of a word ends in, in vocabularies that tell it apart
WORD_END = "</w>"
ENDINGS = (b".", b",", b";", b":", b"!", b"?")
PART_ROWS = 20_000
#: largest tokenizer file that is sent to every executor
MOST_TOKENIZER_BYTES = 64 << 20


def _uri(path: str) -> str:
    return path if "://" in path else f"file://{path}" if path.startswith("/") else path.replace("file:/", "file:///", 1)


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it of a folder that all executors share."""
    return fs.FileSystem.from_uri(_uri(path))


class Chunks:
    """Ids of the chunks met so far, as flat arrays. Only speeds up: any chunk can be encoded again."""

    def __init__(self, tokenizer, lower: bool, most: int = KNOWN_CHUNKS):
        self.tokenizer, self.lower, self.most = tokenizer, lower, most
        self.mark = tokenizer.encode(MARK.decode(), add_special_tokens=False).ids
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids = np.empty(0, np.uint32)
        self.starts = np.zeros(1, np.int64)
        self.seen = np.empty(0, np.int64)

    def _forget(self) -> None:
        """Keep the chunks that were seen most often, half of the store at most."""
        least = 2
        while (self.seen > least).sum() > self.most // 2:
            least *= 2
        kept = np.flatnonzero(self.seen > least)
        names = list(self.place)
        counts = np.diff(self.starts)[kept]
        starts = np.concatenate([[0], np.cumsum(counts)])
        self.ids = self.ids[np.repeat(self.starts[kept] - starts[:-1], counts) + np.arange(starts[-1])]
        self.place = {names[k]: n for n, k in enumerate(kept.tolist())}
        self.starts, self.seen = starts, self.seen[kept]

    def _learn(self, new: list[bytes]) -> None:
        """Encode chunks, many in one text. The last token of a word tells words apart, a mark of one id other chunks."""
        words = [c for c in new if c.decode().isalpha()] if self.ends.any() else []
        rest = set(new).difference(words)
        marked = [c for c in rest if MARK not in c] if len(self.mark) == 1 else []
        ids, counts = [self.ids], []
        if words:
            found = self._run(words, b" ")
            ends = np.flatnonzero(self.ends[found])
            if len(ends) == len(words) and ends[-1] == len(found) - 1:
                ids.append(found)
                counts.append(np.diff(ends, prepend=-1))
            else:  # a character without a token
                marked, words = [*words, *marked] if len(self.mark) == 1 else marked, []
        if marked:
            found = self._run(marked, b" " + MARK + b" ")
            marks = np.flatnonzero(found == self.mark[0])
            ids.append(np.delete(found, marks))
            counts.append(np.diff(marks, prepend=-1) - 1)
        known = {*words, *marked}
        odd = [c for c in new if c not in known]
        for chunk in odd:
            coded = self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids
            ids.append(np.array(coded, np.uint32))
            counts.append(np.array([len(coded)]))
        self._add([*words, *marked, *odd], np.concatenate(ids), np.concatenate(counts))

    def _run(self, chunks: list[bytes], between: bytes) -> np.ndarray:
        """Ids of chunks with something between them, and after the last one."""
        texts = [between.join([*chunks[at : at + LEARN_CHUNKS], b""]).decode() for at in range(0, len(chunks), LEARN_CHUNKS)]
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return np.concatenate([np.array(e.ids, np.uint32) for e in coded])

    def _add(self, new: list[bytes], ids: np.ndarray, counts: np.ndarray) -> None:
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.ids = ids
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
        self.seen = np.append(self.seen, np.zeros(len(new), np.int64))

    def _add_ended(self, new: list[bytes]) -> None:
        """Store chunks that end in a mark of punctuation: the ids of the word before it, then those of the mark."""
        words = np.fromiter((self.place[c[:-1]] for c in new), np.int64, len(new))
        marks = np.fromiter((self.place[c[-1:]] for c in new), np.int64, len(new))
        which = np.stack([words, marks], axis=1).ravel()
        ids, counts = self._ids_of(which)
        self._add(new, np.concatenate([self.ids, ids]), counts.reshape(-1, 2).sum(axis=1))

    def _ids_of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = self.starts[which]
        counts = self.starts[which + 1] - starts
        ends = np.cumsum(counts)
        return self.ids[np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)], counts

    def encode(self, rows: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows with the end token after each, and the number of ids of each row."""
        if len(self.place) > self.most:
            self._forget()
        chunks: list[bytes] = []
        ends = [0]
        for row in rows:
            if self.lower and b"<|" not in row:  # special tokens are told apart by case
                row = row.lower()
            chunks += row.split()
            ends.append(len(chunks))
        which = np.fromiter(map(self.place.get, chunks, repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(which < 0).tolist()
        if missing:
            new = {chunks[k] for k in missing}
            # letters and digits never join with the punctuation after them, so only the word before it is new
            ended = [c for c in new if c[-1:] in ENDINGS and c[-2:-1].isalnum()]
            wanted = new.difference(ended)
            wanted.update(c[:-1] for c in ended)
            wanted.update(c[-1:] for c in ended)
            if wanted := [c for c in wanted if c not in self.place]:
                self._learn(wanted)
            if ended:
                self._add_ended(ended)
            which[missing] = np.fromiter((self.place[chunks[k]] for k in missing), np.int64, len(missing))
        self.seen += np.bincount(which, minlength=len(self.place))
        flat, counts = self._ids_of(which)
        cuts = np.concatenate([[0], np.cumsum(counts)])[ends]
        return np.insert(flat, cuts[1:], end_id), np.diff(cuts) + 1


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id", text: str = "text", end_id: int = END_ID, part_rows: int = PART_ROWS
) -> DataFrame:
    """Write the files of all documents; returns the manifest (part, name, n_docs, n_tokens, width, base), itself a written table."""
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as file:
        data = file.read(MOST_TOKENIZER_BYTES + 1)
    if len(data) > MOST_TOKENIZER_BYTES:
        raise ValueError(f"{tokenizer_path} is larger than a tokenizer file may be ({MOST_TOKENIZER_BYTES} bytes)")
    settings = json.loads(data)
    top = max([end_id, *settings["model"]["vocab"].values(), *(t["id"] for t in settings["added_tokens"])])
    # A-Z in lower case before the tokenizer puts everything in lower case: fewer distinct chunks, the same ids
    lower = any(n["type"] == "Lowercase" for n in (settings.get("normalizer") or {}).get("normalizers", []))
    kind = "<u2" if top < 1 << 16 else "<u4"
    # a worker keeps its copy from task to task, and with it the chunks that it knows
    shared = spark.sparkContext.broadcast({"tokenizer": data})

    def run(batches):
        from pyspark import TaskContext
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        own = shared.value
        chunks = own.get("chunks") or Chunks(Tokenizer.from_buffer(own["tokenizer"]), lower)
        own["chunks"] = chunks
        system, root = open_folder(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        tokens, offsets, ids, missing = 0, [np.zeros(1, np.int64)], [], []
        out = None
        for batch in small(batches):
            if out is None:
                system.create_dir(root, recursive=True)
                out = system.open_output_stream(f"{root}/{name}.ids.tmp", compression=None)
            rows = raw_texts(batch.column(1))
            for start, end in blocks([len(x) for x in rows], BLOCK_BYTES):
                flat, counts = chunks.encode(rows[start:end], end_id)
                out.write(flat.astype(kind).tobytes())
                offsets.append(tokens + np.cumsum(counts))
                tokens += len(flat)
            missing += [x is None for x in batch.column(0).to_pylist()]
            ids.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        if out is None:
            return
        out.close()
        parts = {"idx": np.concatenate(offsets).astype("<i8"), "doc": np.concatenate(ids), "nul": np.array(missing, np.uint8)}
        for suffix, array in parts.items():
            with system.open_output_stream(f"{root}/{name}.{suffix}", compression=None) as file:
                file.write(array.tobytes())
        system.move(f"{root}/{name}.ids.tmp", f"{root}/{name}.ids")
        values = [[part], [name], [len(missing)], [tokens], [int(kind[2])]]
        types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], ["part", "name", "n_docs", "n_tokens", "width"])

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    parts = max(1, -(-narrow.select("id").count() // part_rows))
    ordered = narrow.repartitionByRange(parts, F.col("id").asc_nulls_first(), F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"))
    manifest = stage(ordered.mapInArrow(run, "part int, name string, n_docs bigint, n_tokens bigint, width int"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    return stage(manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long"))), "token-manifest")


def _map(system: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file as an array: mapped into memory where that is possible."""
    if system.get_file_info(path).size == 0:
        return np.empty(0, kind)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read(), kind)


def read_token_files(manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Per document from the files: doc_id, start (tokens of all documents before it), n_tokens, ids_crc32 and on demand its ids."""

    def run(batches):
        for batch in small(batches):
            system, root = open_folder(folder)
            for name, width, base in zip(*(batch.column(k).to_pylist() for k in range(3))):
                ids = _map(system, f"{root}/{name}.ids", f"<u{width}")
                offsets, keys, missing = (_map(system, f"{root}/{name}.{s}", t) for s, t in (("idx", "<i8"), ("doc", "<i8"), ("nul", "u1")))
                for first in range(0, len(keys), 2000):
                    cuts = offsets[first : first + 2001]
                    docs = [ids[a:b].astype("<u4").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                    columns = [
                        pa.array(np.asarray(keys[first : first + 2000]), mask=missing[first : first + 2000].astype(bool)),
                        pa.array(cuts[:-1] + base),
                        pa.array(np.diff(cuts)),
                        pa.array([zlib.crc32(d) for d in docs], pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.array(docs, pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    # one part at a time in a task
    files = manifest.select("name", "width", "base").repartition(max(1, manifest.count()), "name")
    return files.mapInArrow(run, schema)


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def corpus_files(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """All documents written in ascending order of their ids, and what the files say of each."""
    folder = new_path(spark, "token-files")
    return read_token_files(write_token_files(docs, word_tokenizer(), folder), folder)
