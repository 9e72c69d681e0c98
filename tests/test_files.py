"""Files as tables."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tidemill.sources import files


def test_protocol(spark, tmp_path):
    (tmp_path / "p.csv").write_text("id,label\n1,a\n2,\"b,c\"\n")
    assert sorted(map(tuple, files.read_protocol(spark, f"file://{tmp_path}/p.csv", ("label", "id")).collect())) == [("a", "1"), ("b,c", "2")]
    with pytest.raises(ValueError, match="no column x"):
        files.read_protocol(spark, f"file://{tmp_path}/p.csv", ("x",))


def test_markdown(spark):
    lines = ["| a | b |", "|---|:--:|", "| 1 | x \\| y |", "text", "|  | 2 |"]
    rows = spark.createDataFrame([(t,) for t in lines], "t string").select(files.markdown_cells(F.col("t")).alias("c")).collect()
    assert [r.c for r in rows] == [["a", "b"], None, ["1", "x | y"], None, ["", "2"]]


def test_files_against_their_declaration(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name, data in (("a.bin", b"one"), ("d/b.bin", b"two"), ("d/c.bin", b"ab"), ("d/empty", b"")):
        (tmp_path / name).write_bytes(data)
    facts = files.file_facts(spark, f"file://{tmp_path}")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert sorted(map(tuple, facts.collect())) == [("a.bin", 3, sha(b"one")), ("d/b.bin", 3, sha(b"two")), ("d/c.bin", 2, sha(b"ab"))]
    declared = spark.createDataFrame([("a.bin", 3, sha(b"one")), ("d/b.bin", 3, sha(b"owt")), ("d/c.bin", 1, sha(b"ab")), ("d/empty", 0, sha(b"")), ("e", 1, "x")], "path string, n_bytes long, sha256 string")
    assert sorted(map(tuple, files.wrong_files(facts, declared).collect())) == [("d/b.bin", "digest"), ("d/c.bin", "size"), ("e", "missing")]
    first = files.tree_digest(facts).first()
    assert (first.n_files, first.n_bytes) == (3, 8) and first == files.tree_digest(facts.orderBy(F.desc("path"))).first()
    rows = spark.createDataFrame([(i % 2, i) for i in range(500)], "s int, id int")
    key = F.sha2(F.col("id").cast("string"), 256)
    got = {(r.s, r.id) for r in files.sampled_rows(rows, "s", key, 7).collect()}
    want = {(s, i) for s in (0, 1) for i in sorted(range(s, 500, 2), key=lambda i: sha(str(i).encode()))[:7]}
    assert got == want


def test_audio_samples_read_bytes_on_demand(spark, tmp_path):
    rows = spark.createDataFrame([("a", (bytearray(b"xyz"), "p/a.wav")), ("b", (None, "p/b.wav"))], "id string, audio struct<bytes:binary,path:string>")
    rows.write.parquet(str(tmp_path / "s"))
    short = files.audio_samples(spark, str(tmp_path / "s"), ("id",))
    assert sorted(map(tuple, short.collect())) == [("a", "p/a.wav"), ("b", "p/b.wav")]
    assert "bytes" not in short._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    whole = files.audio_samples(spark, str(tmp_path / "s"), ("id",), with_bytes=True).filter("id = 'a'").first()
    assert whole.n_bytes == 3 and bytes(whole.audio_bytes) == b"xyz"
