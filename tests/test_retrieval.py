"""Retrieval and caps against plain versions."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import picks, retrieval


def plain_score(w, wu, q, qu):
    pairs = lambda t: {t[i : i + 2] for i in range(len(t) - 1)} or ({t} if t else set())
    both, every = len(pairs(w) & pairs(q)), len(pairs(w) | pairs(q))
    aligned = 0.0
    if wu and qu:
        aligned = sum(u in qu for u in wu) if len(wu) > len(qu) else max(sum(a == b for a, b in zip(wu, qu[s:], strict=False)) for s in range(len(qu) - len(wu) + 1))
        aligned /= len(wu)
    return 2.0 * (w != "" and w in q) + 0.5 * sum(c in q for c in w) / max(len(w), 1) + 0.3 * (both / every if both else 0.0) + 1.5 * aligned


def test_ranked_terms_are_those_of_all_pairs(spark):
    draw = random.Random(6)
    form = lambda n: "".join(draw.choices("abcdé", k=draw.randrange(n)))
    units = lambda t: [t[i : i + 2] for i in range(0, len(t), 2)]
    terms = [(p, t) for p in ("x", "y") for t in {form(7) for _ in range(120)}] + [("z", "only"), ("y", "")]
    queries = [(i, draw.choice(["x", "y", "z", "none"]), form(12)) for i in range(60)] + [(100, "x", ""), (101, "x", None)]
    excluded = [(i, t) for i in range(60) for _, t in draw.sample(terms, 9)]
    t_df = spark.createDataFrame([(p, t, t, units(t)) for p, t in terms * 2], "pool string, term string, form string, units array<string>")
    q_df = spark.createDataFrame([(i, p, q, None if q is None else units(q)) for i, p, q in queries], "query_id long, pool string, form string, units array<string>")
    e_df = spark.createDataFrame(excluded, "query_id long, term string")
    for n, options in ((8, {}), (5, {"units": False}), (150, {"excluded": e_df}), (6, {"excluded": e_df, "without_held": True})):
        want = []
        for i, p, q in queries:
            q = q or ""
            found = []
            for pool, t in set(terms):
                if pool == p and not ("excluded" in options and (i, t) in excluded) and not (options.get("without_held") and t and t in q):
                    score = plain_score(t, units(t) if options.get("units", True) else [], q, units(q))
                    found.append((-round(score, 6), hashlib.sha256(t.encode()).hexdigest(), t))
            want += [(i, r + 1, t, -s) for r, (s, _, t) in enumerate(sorted(found)[:n])]
        got = [(r.query_id, r["rank"], r.term, round(r.score, 6)) for r in retrieval.ranked_terms(q_df, t_df, n, **options).collect()]
        assert sorted(got) == sorted((i, r, t, s + 0.0) for i, r, t, s in want), options


def test_no_query_meets_its_whole_pool(spark):
    df = spark.createDataFrame([(1, "x", "abc")], "query_id long, pool string, form string")
    terms = spark.createDataFrame([("x", f"t{i}", "zz") for i in range(20)] + [("x", "abd", "abd")], "pool string, term string, form string")
    ranked = retrieval.ranked_terms(df, terms, 3, units=False)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    rows = ranked.orderBy("rank").collect()
    assert rows[0].term == "abd" and rows[1].score == rows[2].score == 0.0


@pytest.mark.parametrize(("cap", "n"), [(1, None), (3, 10), (4, 10_000)])
def test_caps_in_order_are_those_of_a_scan(spark, cap, n):
    draw = random.Random(cap)
    rows = [(f"{draw.random():.12f}", ["hot"] * (draw.random() < 0.5) + [f"k{draw.randrange(40)}" for _ in range(draw.randrange(4))]) for _ in range(200)] + [("0.5000x", None), ("0.5001x", [None, "k1", "k1"])]
    used, chosen, want = {}, 0, {}
    for o, keys in sorted(rows):
        keys = {k for k in keys or [] if k is not None}
        if n is not None and chosen >= n:
            want[o] = "over"
        elif any(used.get(k, 0) >= cap for k in keys):
            want[o] = "capped"
        else:
            want[o], chosen = "chosen", chosen + 1
            for k in keys:
                used[k] = used.get(k, 0) + 1
    df = spark.createDataFrame([(o, k, 1) for o, k in rows], "o string, k array<string>, status2 int")
    got = {r.o: r.status for r in picks.capped_in_order(df, "k", "o", cap, n).collect()}
    assert got == want


def test_caps_of_nothing(spark):
    assert picks.capped_in_order(spark.createDataFrame([], "o string, k array<string>"), "k", "o", 2, 5).count() == 0
    some = spark.createDataFrame([("a", ["x"]), ("b", ["x"])], "o string, k array<string>")
    assert {r.status for r in picks.capped_in_order(some.withColumn("extra", F.lit(1)), "k", "o", 0).collect()} == {"capped"}


def test_queries_that_ask_the_same_are_ranked_once(spark):
    rows = spark.range(400).selectExpr("id AS query_id", "'x' AS pool", "concat('ab', id % 4) AS form", "array('ab') AS units")
    terms = spark.createDataFrame([("x", t, t, [t[:2]]) for t in ("ab", "ba", "abc", "b0", "zz")], "pool string, term string, form string, units array<string>")
    left_out = rows.selectExpr("query_id", "if(query_id % 8 = 0, 'ab', 'none') AS term").union(rows.selectExpr("query_id", "'ba'")).union(rows.selectExpr("query_id", "'ba'"))
    members, asked, excluded = retrieval._asked_once(rows, left_out, True)
    assert members.count() == 400 and asked.count() == 5 and excluded.count() == 10
    got = {}
    for r in retrieval.ranked_terms(rows, terms, 2, excluded=left_out).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.term))
    assert len(got) == 400 and all(sorted(got[i]) == sorted(got[i % 8]) for i in got) and (1, "ab") in got[1] and sorted(got[0]) == [(1, "b0"), (2, "abc")]


def test_no_table_of_queries_is_broadcast(spark):
    rows = spark.range(50).selectExpr("id AS query_id", "'x' AS pool", "concat('ab', id) AS form")
    terms = spark.createDataFrame([("x", "ab", "ab")], "pool string, term string, form string")
    plan = retrieval.ranked_terms(rows, terms, 1, units=False)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [query_id" not in plan and "BroadcastHashJoin [__first" not in plan
