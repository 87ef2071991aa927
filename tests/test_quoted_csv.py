"""Byte ranges of a quoted CSV read side by side give what the whole-file reader gives."""

from __future__ import annotations

import random
from collections import Counter

import pyarrow as pa
import pytest

from clickloom.sources import files, quoted_csv


@pytest.fixture
def ranges(spark):
    """Sets the bytes of a range for the time of a test."""

    def set_bytes(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_bytes
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def content(rng, end, rows=70):
    def field():
        text = "".join(rng.choice(["a", "b,", '"', "\n", "é", " ", "\n\n", "long word ", "日本"]) for _ in range(rng.randint(0, 12)))
        kind = rng.random()
        if kind < 0.3:
            return "" if kind < 0.15 else '""'
        return '"' + text.replace('"', '""').replace("\n", end) + '"' if set(text) & set(',"\n') or kind < 0.6 else text

    lines = [",".join(["x", "y y", "z.z"])]
    lines += [",".join(field() for _ in range(rng.choice([3, 3, 3, 3, 2, 4]))) if rng.random() > 0.1 else "" for _ in range(rows)]
    return end.join(lines)


def whole(spark, path):
    return spark.read.options(**files.CSV_OPTIONS).csv(path)


def bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("last", [True])
@pytest.mark.parametrize(("bytes_", "chars"), [(300, 1), (700, 60), (100_000, 1_000_000)])
def test_equals_the_whole_file_reader(spark, tmp_path, ranges, end, last, bytes_, chars):
    path = str(tmp_path / "a.csv")
    with open(path, "w", newline="", encoding="utf-8") as out:
        out.write(content(random.Random(bytes_), end) + (end if last else ""))
    want = whole(spark, path)
    wanted = bag(want)
    ranges(bytes_)
    chunks = quoted_csv.csv_chunks(spark, path, chars)
    n = chunks.select("file", "start").distinct().count()
    assert bytes_ > 10_000 or n > 3
    assert bag(quoted_csv.parsed(quoted_csv.csv_records(chunks), want.columns)) == wanted


def test_one_file_of_documents_is_read_by_many_tasks(spark, tmp_path, ranges):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = str(tmp_path / "docs.csv")
    files.write_csv(docs.coalesce(1), path)
    wanted = bag(docs)
    for n in (20_000, 1_000_000):
        ranges(n)
        lines = spark.read.option("lineSep", "\n").text(path)
        if n < 100_000:
            assert lines.rdd.getNumPartitions() > 10
        assert bag(files.read_flat(spark, path, docs.schema)) == wanted


def test_a_record_longer_than_ranges_and_a_folder_of_files(spark, tmp_path, ranges):
    for k in range(3):
        body = 'a,b\n' + f'{k},"' + f"line {k}\n" * 300 + f'"\n{k}0,""\n'
        (tmp_path / f"f{k}.csv").write_text(body)
    ranges(300)
    got = bag(files.csv_texts(spark, str(tmp_path)))
    assert got == bag(whole(spark, str(tmp_path))) and (("1", "line 1\n" * 300)) in got


def test_quotes_that_do_not_pair_up_are_an_error(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="do not pair up in .*bad.csv"):
        files.csv_texts(spark, str(tmp_path / "bad.csv"))


def test_empty_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("a,b\n")
    found = files.csv_texts(spark, str(tmp_path / "empty.csv"))
    assert found.columns == ["a", "b"] and found.count() == 0


def test_records_of_a_chunk():
    assert quoted_csv.cut_records('a\nb,"c\nd"\ne', False) == (["a", 'b,"c\nd"', "e"], None)
    assert quoted_csv.cut_records('d"\ne,"f', True) == (['d"'], 'e,"f')
    assert quoted_csv.cut_records("x\ny", True) == ([], "x\ny")


def test_small_chunks_and_their_records_go_on_together():
    lines = [f'{k},"text {k}' if k % 2 else f'more {k}",x' for k in range(1, 2001)]
    batch = pa.RecordBatch.from_pydict({"file": ["f"] * 2000, "start": pa.array([0] * 2000, pa.int64()), "value": lines})
    made = list(quoted_csv._chunks(iter([batch]), 30))
    assert len(made) == 1 and made[0].num_rows > 600
    assert "\n".join(made[0].column(6).to_pylist()) == "\n".join(lines)
    pieces = list(quoted_csv._records(iter([made[0].select(["file", "start", "chunk", "odd_before", "text"])]), {("f", 0): False}, set()))
    assert len(pieces) == 1 and pieces[0].column(4).to_pylist().count(True) == 1
