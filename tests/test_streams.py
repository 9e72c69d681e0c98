"""A stream's sessions against the same rule over a table; a batch that is run again replaces itself."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemill.streaming import sessions


def test_a_stream_gives_the_sessions_of_its_table(spark, tmp_path):
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    first = [("a", at(0)), ("a", at(9)), ("b", at(3)), ("a", at(40)), (None, at(5)), ("c", None)]
    # A far later row moves the watermark on; after it, one row is late and is ignored.
    for name, rows in (("1", first), ("2", [("z", at(1000))]), ("3", [("a", at(11)), ("z", at(2000))])):
        spark.createDataFrame(rows, "k string, t timestamp").coalesce(1).write.parquet(f"{tmp_path}/in/{name}")
    stream = spark.readStream.schema("k string, t timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    found = sessions.gap_sessions(stream, "k", "t", "10 minutes", "5 minutes")
    for _ in range(2):
        query = sessions.upsert_batches(found, f"{tmp_path}/out", f"{tmp_path}/state")
        assert query.awaitTermination(60)
    got = {(r.k, r.start, r.stop, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    table = spark.createDataFrame(first, "k string, t timestamp")
    want = {(r.k, r.start, r.stop, r.n) for r in sessions.gap_sessions(table, "k", "t", "10 minutes", "5 minutes").collect()}
    assert want == {("a", at(0), at(19), 2), ("b", at(3), at(13), 1), ("a", at(40), at(50), 1), (None, at(5), at(15), 1)}
    assert got == want | {("z", at(1000), at(1010), 1)}


def test_no_rows_have_no_sessions(spark):
    rows = spark.createDataFrame([], "k string, t timestamp").withColumn("n", F.lit(1))
    assert sessions.gap_sessions(rows, "k", "t", "10 minutes", "5 minutes").count() == 0
