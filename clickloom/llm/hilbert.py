"""Shards along a Hilbert curve over several metadata dimensions, with built-in functions only.

Each dimension is cut into 2^bits bins of about equal numbers of rows: numbers
by their binary size class with three more digits, strings by the two bytes
after the prefix that all values share. A row's bins are a cell of a grid, and
the cells are numbered along the Hilbert curve, so that neighbours on the curve
are neighbours in every dimension. Rows are ordered by cell, then by a digest
of their key, and cut into runs. A run covers small ranges of each dimension,
so files written from it are skipped by filters on any of them.

Law ``rows``: the runs' counts differ by one at most. A row's position is the
start of its cell plus the start of its slice of the cell plus its number in
the slice. A slice is a digest prefix, as long as its cell needs for slices to
stay near ``SLICE_ROWS``, so a cell that holds a third of all rows is ranked by many
tasks. Starts are sums over counts: at most 2^(bits * dimensions) cells.

Scale: the texts are read once for sizes and checksums; a narrow table is
written and everything else works on that. One shuffle of it ranks the rows.
The bin tables that are broadcast have 65,536 rows per string and 512 per number
at most, whatever the size of the data. The driver gets the smallest and the
largest value of each string dimension and the number of rows.

Nulls fall into the first bin of a dimension and count as an empty text; null
keys have the digest of an empty key. Equal keys are ordered by checksum and
size; rows equal in all of these are interchangeable. An empty table gives an
empty result. Extra columns play no part. The length of a text does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import stage

SHARDS = 8
BITS = 4
SLICE_ROWS = 1_000


def common_prefix(a: str | None, b: str | None) -> str:
    """What two texts begin with alike."""
    if a is None or b is None:
        return ""
    n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[:n]


def _size_class(value: Column) -> Column:
    """Code of a positive number: its binary exponent and three digits below the first."""
    text = F.bin(F.greatest(value.cast("long"), F.lit(1).cast("long")))
    return (F.length(text) - 1) * 8 + F.conv(F.rpad(F.substring(text, 2, 3), 3, "0"), 2, 10).cast("int")


def _text_code(value: Column, skip: int) -> Column:
    """Two bytes of a text, as hexadecimal digits, after ``skip`` digits."""
    return F.rpad(F.substring(F.hex(F.encode(F.coalesce(value, F.lit("")), "UTF-8")), skip + 1, 4), 4, "0")


def quantise(df: DataFrame, dims: list[str], bits: int = BITS) -> DataFrame:
    """``df`` with ``__bin0``, ``__bin1``, ...: bins of about equal counts of each dimension, in the order of its values.

    ``df`` should be a written table; it is read once per dimension and once more for the prefixes.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    strings = [d for d in dims if kinds[d] == "string"]
    ends = df.agg(F.count("*").alias("n"), *(f(F.hex(F.encode(d, "UTF-8"))).alias(f"{d}.{f.__name__}") for d in strings for f in (F.min, F.max))).first()
    rows = max(ends["n"], 1)
    for k, d in enumerate(dims):
        if d in strings:
            code = _text_code(F.col(d), len(common_prefix(ends[f"{d}.min"], ends[f"{d}.max"])))
        else:
            code = _size_class(F.coalesce(F.col(d), F.lit(0)))
        df = df.withColumn(f"__code{k}", code)
        # at most 65,536 codes: a window over all of them is one small task, and the table may be broadcast
        counts = df.groupBy(f"__code{k}").agg(F.count("*").alias("n"))
        below = F.sum("n").over(Window.orderBy(f"__code{k}").rowsBetween(Window.unboundedPreceding, -1))
        share = F.expr(f"cast(coalesce(below, 0) * {1 << bits} div {rows} as int)")
        bins = counts.withColumn("below", below).select(f"__code{k}", share.alias(f"__bin{k}"))
        df = df.join(F.broadcast(bins), f"__code{k}").drop(f"__code{k}")
    return df


def with_hilbert_index(cells: DataFrame, axes: list[str], bits: int, name: str) -> DataFrame:
    """``cells`` with the number of each cell along the Hilbert curve of its axes (Skilling's transpose form)."""
    keep = cells.columns
    work = [f"__x{k}" for k in range(len(axes))]
    df = cells.select(*keep, *(F.col(a).cast("long").alias(w) for a, w in zip(axes, work)))

    def step(changed: dict[str, Column]) -> DataFrame:
        return df.select(*keep, *(changed.get(w, F.col(w)).alias(w) for w in work))

    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for w in work:
            is_set = F.shiftright(F.col(w), level).bitwiseAND(F.lit(1)) == 1
            swap = F.col(work[0]).bitwiseXOR(F.col(w)).bitwiseAND(F.lit(low))
            first = F.when(is_set, F.col(work[0]).bitwiseXOR(F.lit(low))).otherwise(F.col(work[0]).bitwiseXOR(swap))
            changed = {work[0]: first}
            if w != work[0]:
                changed[w] = F.when(is_set, F.col(w)).otherwise(F.col(w).bitwiseXOR(swap))
            df = step(changed)
    for before, w in zip(work, work[1:]):
        df = step({w: F.col(w).bitwiseXOR(F.col(before))})
    turn = F.lit(0).cast("long")
    for level in range(bits - 1, 0, -1):
        hit = F.shiftright(F.col(work[-1]), level).bitwiseAND(F.lit(1)) == 1
        turn = turn.bitwiseXOR(F.when(hit, F.lit((1 << level) - 1)).otherwise(F.lit(0)))
    df = step({w: F.col(w).bitwiseXOR(turn) for w in work})
    index = F.lit(0).cast("long")
    for level in range(bits - 1, -1, -1):
        for w in work:
            index = index * 2 + F.shiftright(F.col(w), level).bitwiseAND(F.lit(1))
    return df.select(*keep, index.alias(name))


def _slice_digits(rows: Column, slice_rows: int) -> Column:
    """Hexadecimal digits of the digest that name a slice, so that slices of a cell with so many rows have ``slice_rows`` or so."""
    digits = F.lit(0)
    for n in range(12):
        digits = digits + F.when(rows > slice_rows * 16**n, 1).otherwise(0)
    return digits


def hilbert_positions(df: DataFrame, dims: list[str], order: list[str], bits: int = BITS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` with ``hilbert`` (number of its cell) and ``position`` (0, 1, ... along the curve).

    ``order`` ranks rows in a cell; its first column is a hexadecimal digest. ``df`` should be a written table.
    """
    columns = df.columns
    axes = [f"__bin{k}" for k in range(len(dims))]
    binned = stage(quantise(df, dims, bits), "bins")
    cells = with_hilbert_index(binned.groupBy(*axes).agg(F.count("*").alias("cell_rows")), axes, bits, "hilbert")
    before = Window.orderBy("hilbert").rowsBetween(Window.unboundedPreceding, -1)  # one row per cell
    start = F.coalesce(F.sum("cell_rows").over(before), F.lit(0)).alias("cell_start")
    digits = _slice_digits(F.col("cell_rows"), slice_rows).alias("digits")
    cells = stage(cells.select(*axes, "hilbert", start, digits), "cells")
    placed = binned.join(F.broadcast(cells), axes)  # at most 2^(bits * dimensions) rows
    sliced = placed.withColumn("__slice", F.expr(f"substring({order[0]}, 1, digits)")).drop(*axes, "digits")
    counts = sliced.groupBy("hilbert", "__slice", "cell_start").agg(F.count("*").alias("n"))
    inside = Window.partitionBy("hilbert").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("hilbert", "__slice", (F.col("cell_start") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("start"))
    number = F.row_number().over(Window.partitionBy("hilbert", "__slice").orderBy(*order)) - 1
    ranked = sliced.drop("cell_start").withColumn("__number", number).join(starts, ["hilbert", "__slice"])
    return ranked.select(*columns, "hilbert", (F.col("start") + F.col("__number")).alias("position"))


def cut_runs(positions: DataFrame, rows: int, shards: int = SHARDS) -> DataFrame:
    """``positions`` with its shard and slot: runs of the order whose counts differ by one at most."""
    shard = F.expr(f"cast(position * {shards} div {max(rows, 1)} as int)")
    start = F.expr(f"(shard * cast({rows} as bigint) + {shards - 1}) div {shards}")
    return positions.withColumn("shard", shard).withColumn("slot", F.col("position") - start)


def shard_documents(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Shard and slot of each document along the curve over language, source and size."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    sum32 = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    narrow = stage(docs.select("doc_id", size.alias("size"), sum32.alias("text_crc32"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), digest.alias("digest")), "narrow")
    placed = hilbert_positions(narrow, ["lang", "source", "size"], ["digest", "doc_id", "text_crc32", "size"], bits, slice_rows)
    return cut_runs(placed, narrow.count(), shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert"
    )


def write_shards(rows: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """Write one folder of Parquet files per shard, each in the order of the curve."""
    rows.repartitionByRange(F.col(shard), F.col(slot)).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)


def shard_bounds(rows: DataFrame, dims: list[str], shard: str = "shard") -> DataFrame:
    """Smallest and largest value of each dimension per shard: what a filter needs to skip it."""
    return rows.groupBy(shard).agg(F.count("*").alias("n"), *(f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)))
