"""Chains of pointers: a task's rows don't grow with the table."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from tidemill.operators import intervals


def test_parts_grow_with_the_hops(spark, monkeypatch):
    monkeypatch.setattr(intervals, "TASK_ROWS", 100)
    hops = spark.range(1500).selectExpr("struct(id % 5 AS k) AS key", "cast(id div 5 AS int) AS node", "if(id div 5 < 299, cast(id div 5 + 1 + id div 5 % 2 AS int), null) AS next")
    heads = hops.groupBy("key").agg(F.min("node").alias("node"))
    seen = intervals.followed(hops, heads)
    want, at = [], 0
    while at is not None:
        want.append(at)
        at = at + 1 + at % 2 if at < 299 else None
    assert {(r.key.k, r.node) for r in seen.collect()} == {(k, n) for k in range(5) for n in want}
    assert seen.rdd.getNumPartitions() == 15 > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_closed_windows_in_parts_of_any_size(spark, monkeypatch):
    draw = random.Random(3)
    rows = [(k, i, float(s := draw.randrange(400)), float(s + draw.randrange(1, 9))) for k in range(9) for i in range(k * 100, k * 100 + 60)] + [(20, 5000, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "k int, id int, start double, stop double")
    run = lambda: intervals.closed_windows(df, ["k"], 2.0, 6.0, 30.0, 0.5, 8)
    whole = sorted(map(tuple, run().collect()))
    monkeypatch.setattr(intervals, "TASK_ROWS", 50)
    out = run()
    assert sorted(map(tuple, out.collect())) == whole and len(whole) > 50
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"hashpartitioning\([^()]*, (\d+)\)", plan)) == {"11"}, plan
