"""Clustered tables: total order over files, refusals, and lookups that open few files."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemill.sources import clustered


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("clustered") / "t")
    rows = spark.range(0, 200_000, 2).select(F.col("id"), F.concat(F.lit("row "), "id").alias("text"), (F.col("id") % 7).alias("n"))
    ranges = clustered.write_clustered(rows.orderBy(F.rand(5)), root, "id", files=16)
    return root, ranges.orderBy("least").collect()


def test_files_are_in_total_order(spark, table):
    root, ranges = table
    assert len(ranges) == 16 and sum(r.n for r in ranges) == 100_000 and ranges[0].least == 0 and ranges[-1].most == 199_998
    assert all(a.most < b.least for a, b in zip(ranges, ranges[1:], strict=False))
    read = clustered.file_ranges(spark.read.parquet(f"{root}/rows"), "id")
    assert {tuple(r) for r in read.collect()} == {(r.file, r.least, r.most, r.n) for r in ranges}
    assert clustered.range_problems(read).count() == 0
    odd = spark.createDataFrame([("a", 1, 5), ("b", 5, 9), ("c", 2, 3), ("d", 12, 13)], "file string, least int, most int")
    assert {tuple(r) for r in clustered.range_problems(odd).collect()} == {("b", 5, 5), ("c", 2, 5)}


@pytest.mark.parametrize("n", [0, 1, 64, 5000, 65_536])
def test_lookups_are_whole_and_open_few_files(spark, table, n):
    root, ranges = table
    ids = random.Random(n).sample(range(-50, 200_050), n)
    found, missing, files = clustered.lookup(spark, root, ids + ids[:3], "id", ["text"])
    there = {i for i in ids if 0 <= i < 200_000 and i % 2 == 0}
    assert {tuple(r) for r in found.collect()} == {(i, f"row {i}") for i in there} and found.columns == ["id", "text"]
    assert {r.id for r in missing.collect()} == set(ids) - there
    held = {r.file for r in ranges for i in ids if r.least <= i <= r.most}
    assert set(files) == held and (n != 1 or len(files) <= 1)
    if files:
        assert {f.rsplit("/", 1)[-1] for f in found.inputFiles()} == held


def test_a_lookup_by_table(spark, table):
    root, _ = table
    keys = spark.createDataFrame([(4,), (4,), (5,), (None,), (10**9,)], "id long")
    found, missing, files = clustered.lookup(spark, root, keys, "id")
    assert [tuple(r) for r in found.collect()] == [(4, "row 4", 4)] and {r.id for r in missing.collect()} == {5, 10**9} and len(files) == 1


def test_row_groups_are_left_out_by_bloom_filters(spark, tmp_path):
    """An id within a file's range that isn't there, or is: the filter that reaches Parquet names it."""
    clustered.write_clustered(spark.range(0, 100_000, 2), str(tmp_path / "t"), "id", files=2)
    found, missing, _ = clustered.lookup(spark, str(tmp_path / "t"), [77_777], "id")
    plan = found._jdf.queryExecution().toString()
    assert "EqualTo(id,77777)" in plan and found.count() == 0 and missing.count() == 1
    import pyarrow.parquet as pq

    part = next((tmp_path / "t" / "rows").glob("part-*"))
    assert pq.ParquetFile(part).metadata.row_group(0).column(0).statistics.has_min_max


def test_keys_of_text(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i:03d}", i) for i in range(300)] + [("é", 1), ("日", 2)], "id string, v int")
    clustered.write_clustered(rows, str(tmp_path / "t"), "id", files=5)
    found, missing, _ = clustered.lookup(spark, str(tmp_path / "t"), ["k007", "é", "K007", ""], "id")
    assert {r.id for r in found.collect()} == {"k007", "é"} and {r.id for r in missing.collect()} == {"K007", ""}


@pytest.mark.parametrize("ids", [[1, 2, 2, 3], [1, None, 4]])
def test_repeated_and_null_keys_are_refused(spark, tmp_path, ids):
    with pytest.raises(ValueError):
        clustered.write_clustered(spark.createDataFrame([(i,) for i in ids], "id long"), str(tmp_path / "t"), "id", files=3)
