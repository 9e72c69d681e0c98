"""Record indexes over records whose slots come in another order at every reading."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemill.operators import record_index


def test_slots_may_come_in_any_order(spark):
    slots = "array<struct<name:string,purpose:string,cut_id:long,start:double,duration:double>>"
    rows = [(i, [("s", "primary" if k == 0 else "other", 10 * i + k, float(k), 1.0) for k in range(6)]) for i in range(50)]
    mixed = F.udf(lambda a: random.sample(a, len(a)), slots).asNondeterministic()
    records = spark.createDataFrame(rows + rows[:1], f"id long, slots {slots}").withColumn("slots", mixed("slots"))
    cuts = spark.createDataFrame([(10 * i + k, 100, 0) for i in range(50) for k in range(6)], "cut_id long, rate int, frames long")
    got = [(r.id, len(r.slots), r.cut_id, r.problem) for r in record_index.record_index(records, cuts).collect()]
    want = [(i, 6, 10 * i, None if i else "id given twice") for i in range(50)] + [(0, 6, 0, "id given twice")]
    assert sorted(got, key=str) == sorted(want, key=str)
