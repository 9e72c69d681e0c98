"""Turns, closures and selections of intervals over the events of users."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import intervals, picks
from tidemill.plans.measure_queries import _SPAN, _spans
from tidemill.plans.registry import query, table

_DAY = f"SELECT s.id, s.start // 86400 AS day, s.user_id, event_type AS who, s.start, s.stop FROM ({_SPAN}) s JOIN events e ON e.event_id = s.id"

# Sequential rules in SQL: the rows of a key in order, one more in each step of a recursion.
_TURNS = f"""WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY start, stop, id) AS r FROM ({_DAY})),
g AS (SELECT DISTINCT day, 0::BIGINT AS r, 0::BIGINT AS label, NULL::VARCHAR AS who, 0::BIGINT AS first, 0::BIGINT AS last FROM s
UNION ALL SELECT s.day, s.r, CASE WHEN same THEN label ELSE s.r END, s.who, CASE WHEN same THEN first ELSE s.start END, CASE WHEN same THEN greatest(last, s.stop) ELSE s.stop END FROM (SELECT g.label, g.first, g.last, s.*, g.r > 0 AND g.who IS NOT DISTINCT FROM s.who AND s.start - last <= 600 AND greatest(s.stop, last) - first <= 7200 AS same FROM g JOIN s ON s.day = g.day AND s.r = g.r + 1) s)
SELECT day, any_value(who) AS who, CAST(max(first) AS DOUBLE) AS first, CAST(max(last) AS DOUBLE) AS last, count(*) AS n FROM g WHERE r > 0 GROUP BY day, label"""
_PICKS = f"""WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start, stop, id) AS r FROM ({_SPAN})),
g AS (SELECT DISTINCT user_id, 0::BIGINT AS r, 0::BIGINT AS id, false AS fits, []::STRUCT(a BIGINT, b BIGINT)[] AS taken FROM s
UNION ALL SELECT user_id, r, id, fits, CASE WHEN fits THEN list_append(taken, {{'a': start, 'b': stop}}) ELSE taken END FROM (SELECT s.user_id, s.r, s.id, s.start, s.stop, g.taken, len(list_filter(g.taken, lambda t: least(s.stop, t.b) - greatest(s.start, t.a) > 0.5 * least(s.stop - s.start, t.b - t.a))) = 0 AS fits FROM g JOIN s ON s.user_id = g.user_id AND s.r = g.r + 1))
SELECT user_id, id FROM g WHERE fits"""
_DRAWN = "CAST(('0x' || substr(sha256('{seed}:' || id), 1, 12)) AS BIGINT)::DOUBLE / 281474976710656.0"
_ROWS = f"""s AS (SELECT *, row_number() OVER w AS no, max(stop) OVER (PARTITION BY user_id ORDER BY start, stop, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, max(stop) OVER (PARTITION BY user_id ORDER BY start, stop, id ROWS UNBOUNDED PRECEDING) AS reach, lead(start) OVER w AS nxt FROM ({_SPAN}) WINDOW w AS (PARTITION BY user_id ORDER BY start, stop, id))"""
_CHAIN = "p AS (SELECT user_id, min(no) AS no FROM f GROUP BY 1 UNION ALL SELECT p.user_id, h.next FROM p JOIN h ON h.user_id = p.user_id AND h.no = p.no WHERE h.next IS NOT NULL)"
_CLEAN = f"""WITH RECURSIVE {_ROWS}, k AS (SELECT *, nxt IS NULL OR nxt - reach >= 600 AS clean FROM s), o AS (SELECT *, start + 3600.0 + {_DRAWN.format(seed=3)} * 196400.0 AS t FROM (SELECT *, coalesce(lag(clean) OVER (PARTITION BY user_id ORDER BY no), true) AS opens FROM k) WHERE opens),
f AS (SELECT o.user_id, o.no, o.id, o.start, max(c.no) AS cut, max(c.reach) AS hi FROM o LEFT JOIN k c ON c.user_id = o.user_id AND c.clean AND c.no >= o.no AND c.reach <= o.t GROUP BY 1, 2, 3, 4),
h AS (SELECT user_id, no, coalesce((SELECT g.no FROM f g WHERE g.user_id = f.user_id AND g.no = f.cut + 1), CASE WHEN cut IS NULL THEN lead(no) OVER (PARTITION BY user_id ORDER BY no) END) AS next FROM f), {_CHAIN}
SELECT user_id, id, start AS lo, CAST(hi AS DOUBLE) AS hi, cut - no + 1 AS n FROM p JOIN f USING (user_id, no) WHERE cut IS NOT NULL"""
# What a window is widened to: every interval that it overlaps, in turn, until nothing more is.
_CLOSED = f"""WITH RECURSIVE {_ROWS}, e AS (SELECT user_id, no, id, start::DOUBLE AS lo, start + 3600.0 + {_DRAWN.format(seed=4)} * 16400.0 AS hi, 0 AS step FROM s
UNION ALL SELECT * FROM (SELECT e.user_id, e.no, e.id, least(e.lo, min(s.start)) AS lo, greatest(e.hi, max(s.stop)) AS hi, step + 1 AS step FROM e JOIN s ON s.user_id = e.user_id AND s.start < e.hi AND s.stop > e.lo GROUP BY e.user_id, e.no, e.id, e.lo, e.hi, e.step HAVING min(s.start) < e.lo OR max(s.stop) > e.hi)),
f AS (SELECT user_id, no, id, min(lo) AS lo, max(hi) AS hi FROM e GROUP BY 1, 2, 3 HAVING max(hi) - min(lo) <= 60000),
h AS (SELECT user_id, no, (SELECT min(g.no) FROM f g WHERE g.user_id = f.user_id AND g.lo >= f.hi + 600) AS next FROM f), {_CHAIN}
SELECT user_id, id, lo, hi FROM p JOIN f USING (user_id, no)"""


def _days(spark, sf):
    """Spans of a day's events, dealt by day: speakers are the event types."""
    kinds = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("who"))
    return _spans(spark, sf).join(kinds, "id").withColumn("day", F.floor(F.col("start") / 86400))


@query("W05_closures", f"WITH s AS (SELECT *, max(stop) OVER (PARTITION BY user_id ORDER BY start, stop, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ({_SPAN})), r AS (SELECT *, sum(CASE WHEN reach IS NULL OR start >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start, stop, id) AS run FROM s) SELECT id, min(start) OVER (PARTITION BY user_id, run) AS lo, max(stop) OVER (PARTITION BY user_id, run) AS hi FROM r")
def closures(spark, sf):
    return intervals.closures(_spans(spark, sf), ["user_id"]).select("id", "lo", "hi")


@query("W08_merged_turns", _TURNS)
def merged_turns(spark, sf):
    return intervals.merged_turns(_days(spark, sf), ["day"], "who", 600.0, 7200.0)


@query("W11_others", f"WITH d AS ({_DAY}), h AS (SELECT a.id AS w, greatest(a.start, b.start) AS start, least(a.stop, b.stop) AS stop, b.id AS id FROM d a JOIN d b ON a.user_id = b.user_id AND a.who <> b.who AND a.start < b.stop AND b.start < a.stop), m AS (SELECT *, max(stop) OVER (PARTITION BY w ORDER BY start, stop, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM h), u AS (SELECT w, sum(greatest(stop - greatest(start, coalesce(reach, start)), 0)) AS n FROM m GROUP BY 1) SELECT d.id, CAST(coalesce(n, 0) AS BIGINT) AS others FROM d LEFT JOIN u ON u.w = d.id")
def others(spark, sf):
    days = _days(spark, sf).select("id", "user_id", "who", "start", "stop")
    return intervals.others_length(days, days, ["user_id"], "who", 3600.0)


@query("W12_first_clear", f"WITH s AS ({_SPAN}) SELECT user_id, arg_min(id, (start, id)) AS id FROM s a WHERE NOT EXISTS (SELECT 1 FROM s b WHERE a.user_id = b.user_id AND a.id <> b.id AND a.start < b.stop AND b.start < a.stop) GROUP BY 1")
def first_clear(spark, sf):
    spans = _spans(spark, sf)
    clear = intervals.alone(spans, ["user_id"]).select("id").join(spans, "id")
    return clear.groupBy("user_id").agg(F.min_by("id", F.struct("start", "id")).alias("id"))


@query("W15_disjoint_picks", _PICKS)
def disjoint_picks(spark, sf):
    return intervals.disjoint_picks(_spans(spark, sf), ["user_id"], 0.5)


@query("W25_priority_draw", "WITH t AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY text ORDER BY CASE source WHEN 'src0' THEN 0 ELSE 1 END, sha256('3:' || doc_id), doc_id) AS r, CASE source WHEN 'src0' THEN 0 ELSE 1 END AS pri, sha256('3:' || doc_id) AS key FROM documents) SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY pri, key, doc_id) AS place FROM t WHERE r <= 1) WHERE place <= 20")
def priority_draw(spark, sf):
    from tidemill.functions.order import order_key

    rank = F.when(F.col("source") == "src0", 0).otherwise(1)
    rows = table(spark, sf, "documents").select("doc_id", "lang", F.xxhash64("text").alias("h1"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("h2"), F.struct(rank.alias("r"), order_key(3, "doc_id").alias("k")).alias("key"))
    once = rows.groupBy("h1", "h2").agg(F.min_by(F.struct("doc_id", "lang", "key"), F.struct("key", "doc_id")).alias("row")).select("row.*")
    return picks.smallest(once, ["lang"], "key", "doc_id", 20).select("doc_id")


@query("W04_clean_windows", _CLEAN)
def clean_windows(spark, sf):
    return intervals.clean_windows(_spans(spark, sf), ["user_id"], 600.0, 3600.0, 200_000.0, 3)


@query("W06_closed_windows", _CLOSED)
def closed_windows(spark, sf):
    return intervals.closed_windows(_spans(spark, sf), ["user_id"], 3600.0, 20_000.0, 60_000.0, 600.0, 4)
