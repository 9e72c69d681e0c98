"""Target windows against a plain scan with a cursor."""

from __future__ import annotations

import hashlib
import random

import pytest

from tidemill.operators import intervals

LEAD, LENGTH, LONGEST, REST, SEED = (0.0, 4.0), (8.0, 22.0), 26.0, 0.5, 3


def draw(what, i, bounds):
    share = int(hashlib.sha256(f"{SEED}:{what}:{i}".encode()).hexdigest()[:12], 16) / 16**12
    return bounds[0] + share * (bounds[1] - bounds[0])


def plain_windows(rows, ends):
    out = []
    for key, who in sorted({(r[0], r[1]) for r in rows}):
        own = sorted((r for r in rows if r[:2] == (key, who)), key=lambda r: (r[3], r[4], r[2]))
        cursor = None
        for _, _, i, start, stop in own:
            if cursor is not None and start < cursor:
                continue
            lo = max([start - draw("lead", i, LEAD), 0.0] + [r[4] for r in own if r[4] <= start] + ([cursor] if cursor is not None else []))
            until = start + draw("length", i, LENGTH)
            hi = max([until] + [r[4] for r in own if start <= r[3] < until])
            if hi - lo > LONGEST or hi > ends.get(key, 1e18):
                continue
            out.append((key, who, i, round(lo, 6), round(hi, 6)))
            cursor = hi + REST
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_target_windows(spark, seed):
    rng, rows, n = random.Random(seed), [], 0
    for key in "abc":
        for who in "xy":
            at = rng.random() * 5
            for _ in range(rng.choice([1, 40, 70])):
                at += rng.choice([0.0, 0.3, 1.0, 2.5, 9.0, 30.0])
                rows.append((key, who, n, round(at, 3), round(at + rng.choice([0.4, 2.0, 6.0, 14.0]), 3)))
                n += 1
    ends = {"a": 150.0, "b": 1e6}
    df = spark.createDataFrame(rows, "k string, who string, id long, start double, stop double")
    e_df = spark.createDataFrame(list(ends.items()), "k string, end double")
    windows = intervals.target_windows(df, ["k"], "who", LEAD, LENGTH, LONGEST, REST, SEED, e_df)
    got = sorted((r.k, r.who, r.id, round(r.lo, 6), round(r.hi, 6)) for r in windows.collect())
    want = plain_windows(rows, ends)
    assert got == want and len(want) > 12
    turns = {(r.window, r.id): (round(r.start, 6), round(r.stop, 6), r.clipped) for r in intervals.window_turns(windows, df, ["k"], "who", 20.0).collect()}
    plain = {}
    for k, who, i, lo, hi in want:
        for k2, other, j, start, stop in rows:
            if k2 == k and start < hi and stop > lo and (other != who or (lo <= start and stop <= hi)):
                plain[(i, j)] = (max(start, lo), min(stop, hi), start < lo or stop > hi)
    assert turns == plain


def test_no_target_windows(spark):
    empty = spark.createDataFrame([], "k string, who string, id long, start double, stop double")
    assert intervals.target_windows(empty, ["k"], "who", LEAD, LENGTH, LONGEST, REST, SEED).count() == 0


@pytest.mark.parametrize("length", [(8.0, 22.0), (0.0, 22.0)])
def test_last_ends_meet_no_pairs(spark, length):
    draw = random.Random(5)
    rows = []
    for n in range(150):
        start = round(draw.random() * 60, 1)
        rows.append(("ab"[n % 2], n, start, start + draw.choice([0.0, 1.0, 9.0, 40.0]), start + length[0] + draw.random() * (length[1] - length[0])))
    df = spark.createDataFrame(rows, "k string, no int, start double, stop double, until double")
    found = intervals._last_ends(df, ["k"], length, 16)
    got = {r.no: r.reach for r in found.collect()}
    want = {n: max((d for k2, _, c, d, _ in rows if k2 == k and s <= c < u), default=None) for k, n, s, _, u in rows}
    assert {n: got.get(n) for n in want} == want
    if length[0]:
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "begin#" not in plan
