"""Shares and look-ups against plain versions."""

from __future__ import annotations

import pytest

from tidemill.operators import registry_checks as checks


@pytest.mark.parametrize("amount", [0.0, 3.0, 10.0, 17.0, 500.0])
def test_shares_fill_up_evenly(spark, amount):
    counts = {"a": 1, "b": 4, "c": 4, "d": 20}
    want, left, open_ = dict.fromkeys(counts, 0.0), amount, set(counts)
    while open_ and left > 1e-12:
        step = min(left / len(open_), min(counts[k] - want[k] for k in open_))
        for k in open_:
            want[k] += step
        left -= step * len(open_)
        open_ = {k for k in open_ if counts[k] - want[k] > 1e-12}
    df = spark.createDataFrame(list(counts.items()), "k string, n long")
    got = {r["k"]: r["share"] for r in checks.stretched(df, amount, "k", "n").collect()}
    assert got == pytest.approx(want)


def test_ids_beat_aliases(spark):
    rows = spark.createDataFrame([("x", "y"), ("y", "z"), ("w", "z"), ("v", None)], "dataset_id string, alias string")
    assert {r["name"]: r["dataset_id"] for r in checks.lookup(rows).collect()} == {"x": "x", "y": "y", "w": "w", "v": "v"}
