"""Language identification by Bayesian evidence fusion.

Four sources of evidence meet in one posterior per row:

* the text: naive Bayes over hashed character trigrams. Neighbouring trigrams are
  no independent witnesses, so the log-likelihood is divided by a temperature that
  fits held-out labels best;
* the language that the markup or the record declares, with a reliability learned
  from how often each declaration goes with which language;
* the address suffix and the host: a prior that is smoothed in levels. The
  languages of all rows are smoothed evenly, those of a suffix towards all rows,
  those of a host towards its suffix. Counts are sums of text posteriors, and a row's own share
  is taken out of its priors, so that no row testifies for itself.

The languages are those of all labelled texts that are not empty. The text model is
fitted on a bounded sample: the ``TRAIN_DOCS`` distinct texts with the smallest
hashes, and of each language its ``LANGUAGE_DOCS`` with the smallest hashes outside
the held-out fold, or inside it where there are no others. Its tables have a fixed
size. Everything else counts all rows.

Scale: texts are read once by tasks that write likelihoods; the priors are grouped
sums with a map-side step over that narrow table. Suffix and declaration tables
are small by nature, yet joined like the host table: adaptive execution
broadcasts what is small and splits the partition of a host with a third of all
rows.

Null and empty texts leave the decision to the other evidence; without any of it
the most frequent language wins. Ties go to the first language by name. Null hosts
and declarations are values of their own. Repeated rows count as often as they
stand. An empty table gives an empty result; without labelled rows it is an error.
Extra columns are ignored. Long texts are read whole, in pieces.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.boilerplate import blocks_of
from clickloom.llm.common import small, texts
from clickloom.session import stage

TRAIN_DOCS = 4000
#: texts of each language that the sample has at least, as far as there are so many
LANGUAGE_DOCS = 20
BUCKETS = 1 << 15
PIECE = 1 << 20
#: pseudo-counts: of a trigram, of a declaration, and of each level of the prior
GRAM_WEIGHT, DECLARED_WEIGHT, PRIOR_WEIGHT = 0.1, 1.0, 5.0
TEMPERATURES = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)
#: most languages that a model may have
MOST_LANGUAGES = 200

_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})", re.IGNORECASE)


def gram_buckets(text: str) -> np.ndarray:
    """Hash buckets of the character trigrams of a text, lower-cased, with a blank at both ends."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    if len(points) < 3:
        return np.empty(0, np.int64)
    mixed = points[:-2] * np.uint32(0x9E3779B1) + points[1:-1] * np.uint32(0x85EBCA77) + points[2:] * np.uint32(0xC2B2AE3D)
    return (mixed >> np.uint32(17)).astype(np.int64) % BUCKETS


def _likelihood(text: str, table: np.ndarray) -> np.ndarray:
    """Sum of the log-probabilities of the trigrams, per language; long texts piece by piece with two characters of overlap."""
    total = np.zeros(table.shape[1])
    for at in range(0, max(len(text), 1), PIECE):
        grams = gram_buckets(text[max(0, at - 2) : at + PIECE]) if text else np.empty(0, np.int64)
        if len(grams):
            total += np.bincount(grams, minlength=BUCKETS) @ table if len(grams) > BUCKETS // 4 else table[grams].sum(axis=0)
    return total


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_text_model(labelled: DataFrame, text: str = "text", label: str = "lang", train_docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray, float]:
    """Languages, log-probabilities (trigram bucket by language) and temperature, from a bounded sample of labelled texts."""
    rows = labelled.select(F.col(text).alias("text"), F.col(label).alias("label"), F.xxhash64(text).alias("h")).where("label is not null and length(text) > 0")
    each = stage(rows.select("label", "h").distinct(), "language-texts")
    last = each.select("h").distinct().orderBy("h").limit(train_docs).agg(F.max("h")).first()[0]
    if last is None:
        raise ValueError("no labelled text to learn languages from")
    names = sorted(r["label"] for r in each.select("label").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in the labels")
    # fold 0 is held out, but for a language that has no text outside it
    order = Window.partitionBy("label").orderBy(F.expr("h % 5 = 0"), "h")
    first = each.withColumn("place", F.row_number().over(order)).where(F.col("place") <= LANGUAGE_DOCS)
    lone = F.expr("place = 1 and h % 5 = 0")
    own = F.broadcast(first.select(F.col("label").alias("__label"), F.col("h").alias("__h"), lone.alias("lone")))  # MOST_LANGUAGES * LANGUAGE_DOCS rows at most
    wanted = rows.join(own, F.expr("label = __label and h = __h"), "left").where((F.col("h") <= last) | F.col("__h").isNotNull())
    learned = (F.col("h") % 5 != 0) | F.coalesce(F.col("lone"), F.lit(False))
    sample = wanted.groupBy("h", "label").agg(F.first("text").alias("text"), F.max(learned).alias("learned"))
    sample = stage(sample, "language-sample")

    def count(batches):
        for batch in small(batches):
            sums: dict[tuple[str, bool], np.ndarray] = {}
            for name, value, learned in zip(batch.column(1).to_pylist(), texts(batch.column(2)), batch.column(3).to_pylist()):
                if learned:
                    sums[name] = sums.get(name, 0) + np.bincount(gram_buckets(value), minlength=BUCKETS)
            found = [(name, int(b), int(n[b])) for name, n in sums.items() for b in np.flatnonzero(n)]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["label", "bucket", "n"])

    counts = sample.mapInArrow(count, "label string, bucket bigint, n bigint").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    table = np.full((BUCKETS, len(names)), GRAM_WEIGHT)
    place = {name: k for k, name in enumerate(names)}
    for r in counts.collect():  # BUCKETS * languages rows at most
        table[r["bucket"], place[r["label"]]] += r["n"]
    table = np.log(table / table.sum(axis=0))

    def score(batches):
        for batch in small(batches):
            found = [_likelihood(v, table).tolist() for v in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["label", "ll"])

    held = sample.where("not learned").select("label", "text").mapInArrow(score, "label string, ll array<double>").collect()
    best = 1.0
    if held:
        ll = np.array([r["ll"] for r in held])
        truth = np.array([place[r["label"]] for r in held])
        fits = [np.log(np.maximum(_softmax(ll / t)[np.arange(len(truth)), truth], 1e-12)).sum() for t in TEMPERATURES]
        best = TEMPERATURES[int(np.argmax(fits))]
    return names, table, best


def declared_language(page: str) -> str | None:
    """Primary language of the lang attribute of a page's root element."""
    found = _LANG.search(page)
    return found.group(1).lower() if found else None


def page_rows(pages: DataFrame) -> DataFrame:
    """Pages as rows to identify: page_id, text (what a reader sees), declared language, host."""

    def run(batches):
        for batch in small(batches):
            rows = texts(batch.column(2))
            seen = ["\n".join(t for t, _, furniture in blocks_of(p) if not furniture) for p in rows]
            declared = [declared_language(p) for p in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(seen, pa.string()), pa.array(declared, pa.string())], ["page_id", "url", "text", "declared"])

    found = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id bigint, url string, text string, declared string")
    host = F.lower(F.nullif(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    return found.select("page_id", "text", "declared", host.alias("host"))


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray, float], keys: list[str]) -> DataFrame:
    """The keys of each row with its language, the posterior of it and the language of the text alone.

    ``rows`` has the keys, text, declared and host. The address suffix is the last part of the host's name.
    """
    names, table, temperature = model
    shared = rows.sparkSession.sparkContext.broadcast(table)
    size = len(names)
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)

    def score(batches):
        for batch in small(batches):
            ll = np.array([_likelihood(v, shared.value) for v in texts(batch.column(len(keys)))]).reshape(-1, size) / temperature
            ll -= ll.max(axis=1, keepdims=True)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), size).cast(pa.list_(pa.float64())) for x in (ll, _softmax(ll))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *batch.columns[len(keys) + 1 :], *lists], [*keys, "declared", "host", "ll", "post"])

    narrow = rows.select(*keys, "text", F.lower(F.substring_index("declared", "-", 1)).alias("declared"), F.col("host").cast("string").alias("host"))
    scored = narrow.mapInArrow(score, f"{kinds}, declared string, host string, ll array<double>, post array<double>")
    suffix = F.when(F.instr("host", ".") > 0, F.substring_index("host", ".", -1))
    scored = stage(scored.withColumn("suffix", suffix), "likelihoods")

    def sums(by: list[str], name: str) -> DataFrame:
        return scored.groupBy(*by).agg(F.array(*(F.sum(F.col("post")[k]) for k in range(size))).alias(name))

    total = sums([], "all_sum")
    levels = scored
    for key in ("declared", "suffix", "host"):
        if key == "host":  # a host has one suffix
            counts = sums(["host"], "host_sum")
        else:
            counts = sums([key], f"{key}_sum")
        counts = counts.withColumnRenamed(key, "__key")
        levels = levels.join(counts, levels[key].eqNullSafe(counts["__key"])).drop("__key")
    row = total.first()  # one row
    everything = F.array(*(F.lit(float(x or 0)) for x in row["all_sum"]))
    n_declared = max(scored.select("declared").distinct().count(), 1)
    weight = F.lit(PRIOR_WEIGHT)

    def rest(sum_name) -> F.Column:
        """Sums without the row's own share."""
        return F.zip_with(sum_name, F.col("post"), lambda a, b: F.greatest(a - b, F.lit(0.0)))

    def share(counts, towards) -> F.Column:
        return F.zip_with(counts, towards, lambda a, q: (a + weight * q) / (F.aggregate(counts, F.lit(0.0), lambda s, v: s + v) + weight))

    even = F.array(*(F.lit(1.0 / size) for _ in names))
    steps = levels.withColumn("all_rest", rest(everything))
    steps = steps.withColumn("prior", share(F.col("all_rest"), even))
    steps = steps.withColumn("suffix_rest", rest(F.col("suffix_sum"))).withColumn("prior", share(F.col("suffix_rest"), F.col("prior")))
    steps = steps.withColumn("host_rest", rest(F.col("host_sum"))).withColumn("prior", share(F.col("host_rest"), F.col("prior")))
    said = F.zip_with(rest(F.col("declared_sum")), F.col("all_rest"), lambda a, b: (a + DECLARED_WEIGHT) / (b + DECLARED_WEIGHT * n_declared))
    steps = steps.withColumn("said", F.when(F.col("declared").isNull(), even).otherwise(said))
    joint = F.zip_with(F.zip_with("ll", "prior", lambda a, b: a + F.log(b)), "said", lambda a, b: a + F.log(b))
    steps = steps.withColumn("joint", joint).withColumn("top", F.array_max("joint"))
    evidence = F.aggregate("joint", F.lit(0.0), lambda s, v: s + F.exp(v - F.col("top")))
    labels = F.array(*(F.lit(n) for n in names))
    best = F.element_at(labels, F.array_position("joint", F.col("top")).cast("int"))
    alone = F.when(F.array_min("ll") < 0, F.element_at(labels, F.array_position("ll", F.array_max("ll")).cast("int")))
    return steps.select(*keys, "host", "declared", best.alias("language"), F.round(1 / evidence, 6).alias("probability"), alone.alias("text_language"))


def corpus_languages(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Languages of all documents (doc_id) and all pages (page_id), each table with priors of its own."""
    model = fit_text_model(docs)
    from_docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").alias("declared"), F.col("source").alias("host"))
    first = identify(from_docs, model, ["doc_id"]).withColumn("page_id", F.lit(None).cast("long"))
    second = identify(page_rows(pages), model, ["page_id"]).withColumn("doc_id", F.lit(None).cast("long"))
    return first.unionByName(second).select("doc_id", "page_id", "host", "declared", "language", "probability", "text_language")
