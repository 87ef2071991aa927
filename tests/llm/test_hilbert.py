from __future__ import annotations

from collections import Counter

from clickloom.llm import hilbert
from clickloom.session import stage
from tests.llm.conftest import ODD


def test_curve_visits_every_cell_and_steps_to_a_neighbour(spark):
    cells = spark.range(512).selectExpr("id % 8 as a", "id div 8 % 8 as b", "id div 64 as c")
    rows = hilbert.with_hilbert_index(cells, ["a", "b", "c"], 3, "h").orderBy("h").collect()
    assert [r["h"] for r in rows] == list(range(512))
    for p, q in zip(rows, rows[1:]):
        assert abs(p["a"] - q["a"]) + abs(p["b"] - q["b"]) + abs(p["c"] - q["c"]) == 1


def test_bins_have_about_equal_counts_and_keep_the_order(spark):
    df = stage(spark.range(4000).selectExpr("id * id + 1 as size", "concat('same-prefix-', lpad(id % 97, 2, '0')) as name"), "t")
    rows = hilbert.quantise(df, ["size", "name"], 3).collect()
    for value, column in (("size", "__bin0"), ("name", "__bin1")):
        ordered = sorted((r[value], r[column]) for r in rows)
        assert [b for _, b in ordered] == sorted(b for _, b in ordered)
        counts = Counter(b for _, b in ordered)
        assert set(counts) == set(range(8)) and max(counts.values()) < 2.5 * min(counts.values())


def test_runs_differ_by_one_and_slices_do_not_change_them(spark, documents):
    docs = documents([(k, "w " * (k % 50 + 1), ("en", "fr", "de")[k % 3], "src0" if k % 3 else f"src{k % 7}") for k in range(203)])
    whole = hilbert.shard_documents(docs).collect()
    cut = hilbert.shard_documents(docs, slice_rows=2).collect()
    assert sorted(map(str, whole)) == sorted(map(str, cut))
    counts = Counter(r["shard"] for r in whole)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in whole if r["shard"] == shard) == list(range(n))
    assert [r["hilbert"] for r in sorted(whole, key=lambda r: (r["shard"], r["slot"]))] == sorted(r["hilbert"] for r in whole)


def test_shards_are_small_ranges(spark, documents, tmp_path):
    docs = documents([(k, "w " * (2 ** (k % 8)), ("de", "en", "es", "fr")[k % 4], f"src{k // 4 % 8}") for k in range(512)])
    placed = hilbert.shard_documents(docs)
    joined = stage(placed.join(docs.select("doc_id", "lang", "source"), "doc_id"), "placed")
    bounds = hilbert.shard_bounds(joined, ["lang", "size"]).collect()
    wide = [r for r in bounds if r["min_lang"] == "de" and r["max_lang"] == "fr" and r["min_size"] == 3 and r["max_size"] > 200]
    assert len(bounds) == 8 and not wide
    hilbert.write_shards(joined, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).where("shard = 3").count() == 64


def test_odd_rows_and_empty_table(spark, documents):
    rows = hilbert.shard_documents(documents(ODD)).collect()
    assert sorted((r["doc_id"] or -1, r["size"]) for r in rows) == sorted((i or -1, len((t or "").encode()) + 1) for i, t, *_ in ODD)
    assert {r["text_crc32"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
    assert hilbert.shard_documents(documents([])).count() == 0


def test_no_python_in_the_plan(spark, documents):
    plan = hilbert.shard_documents(documents(ODD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
