"""Sequential interval rules against plain loops over drawn intervals."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemill.operators import intervals


def drawn(n=120, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = rng.randrange(0, 400)
        rows.append((i, rng.choice("ab"), rng.choice("xy"), float(start), float(start + rng.randrange(1, 12))))
    return rows


def test_merged_turns(spark):
    rows = drawn()
    want = []
    for k in "ab":
        last = None
        for _, _, who, start, stop in sorted((r for r in rows if r[1] == k), key=lambda r: (r[3], r[4], r[0])):
            if last and last[1] == who and start - last[3] <= 3 and max(stop, last[3]) - last[2] <= 30:
                last[3], last[4] = max(stop, last[3]), last[4] + 1
            else:
                last = [k, who, start, stop, 1]
                want.append(last)
    df = spark.createDataFrame(rows, "id long, k string, who string, start double, stop double")
    got = intervals.merged_turns(df, ["k"], "who", 3.0, 30.0).select("k", "who", "first", "last", "n").collect()
    assert sorted(map(list, got)) == sorted(want)
    got = intervals.merged_turns(df, ["k"], "who", 3.0, 30.0, slice_rows=10).select("k", "who", "first", "last", "n").collect()
    assert sorted(map(list, got)) == sorted(want)
    assert intervals.merged_turns(df.limit(0), ["k"], "who", 3.0, 30.0).count() == 0


def test_disjoint_picks(spark):
    rows = drawn()
    want = set()
    for k in "ab":
        taken = []
        for i, _, _, start, stop in sorted((r for r in rows if r[1] == k), key=lambda r: (r[3], r[4], r[0])):
            if all(min(stop, b) - max(start, a) <= 0.5 * min(stop - start, b - a) for a, b in taken):
                taken.append((start, stop))
                want.add(i)
    df = spark.createDataFrame(rows, "id long, k string, who string, start double, stop double")
    assert {r["id"] for r in intervals.disjoint_picks(df, ["k"], 0.5).collect()} == want
    assert {r["id"] for r in intervals.disjoint_picks(df, ["k"], 0.5, slice_rows=12).collect()} == want


def packed(rows, limit, gap):
    """Packs of a plain loop over (key, id, start, stop)."""
    out = []
    for k in {r[0] for r in rows}:
        pack = None
        for start, stop, i in sorted((a, b, i) for kk, i, a, b in rows if kk == k):
            if pack and (stop - start > limit or max(stop, pack[3]) - pack[2] > limit or start - pack[3] > gap):
                pack = None
            if stop - start <= limit:
                if pack is None:
                    out.append(pack := [k, i, start, stop, 0])
                pack[3:] = [max(stop, pack[3]), pack[4] + 1]
    return out


def test_greedy_windows_over_slices(spark):
    # One key without pauses, intervals beyond the limit, repeated rows, a key of null, and rows that take no part.
    rng = random.Random(9)
    rows = [("hot", i, i * 0.5, i * 0.5 + rng.choice([0.2, 0.4, 1.0, 7.0])) for i in range(300)] + [(None, i, float(i * rng.choice([1, 3])), i * 3.0 + 1) for i in range(40)]
    rows += [rows[5], rows[5], ("one", 7, 0.0, 0.0)]
    df = spark.createDataFrame([*rows, ("hot", 900, None, 1.0), ("hot", 901, 1.0, float("nan"))], "k string, id long, start double, stop double").withColumn("label", F.lit("x"))
    want = sorted(packed(rows, 6.0, 1.5), key=str)
    for size in (50, 20_000):
        got = intervals.greedy_windows(df, ["k"], 6.0, 1.5, slice_rows=size).select("k", "head", "first", "last", "n").collect()
        assert sorted(map(list, got), key=str) == want
    assert intervals.greedy_windows(df.limit(0), ["k"], 6.0, 1.5).count() == 0


def test_a_state_is_carried_through_every_slice(spark):
    # A rule that never forgets: the number of rows so far. Two keys, so that a slice begins in the middle of one.
    rows = [(k, i, float(i), float(i)) for k in "ab" for i in range(200)]

    def rule(state, numbers, *_):
        at = state[0] if state else 0
        return [at + i for i in range(1, len(numbers) + 1)], [at + len(numbers)]

    got = intervals.in_slices(spark.createDataFrame(rows, "k string, id int, start double, stop double"), ["k"], rule, slice_rows=60)
    assert {(r.k, r.id): r.label for r in got.collect()} == {(k, i): i + 1 for k, i, _, _ in rows}


def _drawn(key, seed, lo, hi):
    import hashlib

    return lo + int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:12], 16) / 16**12 * (hi - lo)


def _some_spans(seed):
    import random

    draw, rows, at = random.Random(seed), [], 0.0
    for i in range(160):
        at += draw.choice([0.1, 0.5, 1.0, 3.0, 20.0])
        rows.append((i % 2, i, at, at + draw.choice([0.3, 1.0, 2.5])))
    return rows


def test_clean_windows(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(f"file://{tmp_path}")
    rows = _some_spans(3)
    got = intervals.clean_windows(spark.createDataFrame(rows, "k int, id int, start double, stop double"), ["k"], 0.4, 3.0, 12.0, 5)
    want = []
    for k in (0, 1):
        own = sorted((a, b, i) for kk, i, a, b in rows if kk == k)
        reach = [max(b for _, b, _ in own[: n + 1]) for n in range(len(own))]
        clean = [n + 1 == len(own) or own[n + 1][0] - reach[n] >= 0.4 for n in range(len(own))]
        i = 0
        while i < len(own):
            if i and not clean[i - 1]:
                i += 1
                continue
            length = _drawn(own[i][2], 5, 3.0, 12.0)
            fits = [j for j in range(i, len(own)) if clean[j] and reach[j] - own[i][0] <= length]
            if not fits:
                i += 1
                continue
            want.append((k, own[i][2], own[i][0], reach[max(fits)], max(fits) - i + 1))
            i = max(fits) + 1
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 10


def test_closed_windows(spark):
    rows = _some_spans(4)
    got = intervals.closed_windows(spark.createDataFrame(rows, "k int, id int, start double, stop double"), ["k"], 2.0, 6.0, 15.0, 0.5, 8)
    want = []
    for k in (0, 1):
        own = sorted((a, b, i) for kk, i, a, b in rows if kk == k)
        cursor = float("-inf")
        for a, _, i in own:
            if a < cursor:
                continue
            lo, hi = a, a + _drawn(i, 8, 2.0, 6.0)
            while True:
                inside = [(x, y) for x, y, _ in own if x < hi and y > lo]
                wider = min([lo, *(x for x, _ in inside)]), max([hi, *(y for _, y in inside)])
                if wider == (lo, hi):
                    break
                lo, hi = wider
            if hi - lo > 15.0 or lo < cursor:
                continue
            want.append((k, i, lo, hi))
            cursor = hi + 0.5
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 10
