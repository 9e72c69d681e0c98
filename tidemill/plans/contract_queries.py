"""Layers, catalog and stream queries over the corpus tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import catalog, intervals, layers, measures
from tidemill.plans.registry import query, table
from tidemill.streaming import sessions


@query(
    "L05_replay_layer",
    """SELECT d.doc_id AS id, coalesce(quality <> 0, true) AS retained, '{"language":"' || lang || '"' || CASE WHEN toxic IS NOT NULL THEN ',"metadata":{"toxic":' || toxic || '}' ELSE '' END || '}' AS record_json
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def replay_layer(spark, sf):
    records = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.to_json(F.struct(F.col("lang").alias("language"))).alias("record_json"), F.lit(True).alias("retained"))
    layer = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.create_map(F.lit("metadata.toxic"), F.col("toxic").cast("string")).alias("changes"), F.when(F.col("quality") == 0, "delete").otherwise("keep").alias("status"))
    step = layers.Step("labels", ("metadata.toxic", "$membership"))
    return layers.replay(records, layer, step).select("id", "retained", "record_json")


@query("L04_layer_problems", "SELECT doc_id AS id, 'no visible parent' AS problem FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang <> 'de')")
def layer_problems(spark, sf):
    parent = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), (F.col("lang") != "de").alias("retained"))
    return layers.layer_problems(table(spark, sf, "labels").select(F.col("doc_id").alias("id")), parent)


@query("G12_families", "WITH RECURSIVE r(node, root, depth) AS (SELECT c_custkey, c_custkey, 0 FROM customer WHERE c_custkey % 16 = 1 UNION ALL SELECT c.c_custkey, r.root, r.depth + 1 FROM customer c JOIN r ON c.c_custkey - 1 = r.node AND c.c_custkey % 16 <> 1) SELECT node, root, CAST(depth AS BIGINT) AS depth FROM r")
def families(spark, sf):
    # Key 0 has no predecessor among the customers and so belongs to no family.
    edges = table(spark, sf, "customer").filter("c_custkey > 0").select(F.col("c_custkey").alias("node"), F.when(F.col("c_custkey") % 16 != 1, F.col("c_custkey") - 1).alias("parent"))
    return catalog.roots(edges, 16)


_PATHS = "SELECT DISTINCT split_part(split_part(url, '://', 2), '?', 1) AS path FROM pages"


@query("G10_zones", f"WITH p AS ({_PATHS}), z AS (SELECT DISTINCT split_part(path, '/', 1) AS zone FROM p UNION SELECT DISTINCT split_part(path, '/', 1) || '/en' FROM p) SELECT path, arg_max(zone, length(zone)) AS zone FROM p LEFT JOIN z ON path = zone OR starts_with(path, zone || '/') GROUP BY 1")
def zones(spark, sf):
    paths = table(spark, sf, "pages").select(F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("?"), F.lit(1)).alias("path")).distinct()
    hosts = paths.select(F.split_part("path", F.lit("/"), F.lit(1)).alias("zone")).distinct()
    return catalog.classified(paths, hosts.unionByName(hosts.select(F.concat("zone", F.lit("/en")).alias("zone"))))


@query("U07_outermost", f"WITH p AS ({_PATHS} UNION SELECT DISTINCT split_part(split_part(url, '://', 2), '/', 1) || '/en' FROM pages) SELECT path FROM p a WHERE NOT EXISTS (SELECT 1 FROM p b WHERE starts_with(a.path, b.path || '/'))")
def outermost(spark, sf):
    pages = table(spark, sf, "pages")
    paths = pages.select(F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("?"), F.lit(1)).alias("path"))
    hosts = pages.select(F.concat(F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1)), F.lit("/en")).alias("path"))
    return catalog.outermost(paths.unionByName(hosts))


_ROLLED = "SELECT up AS path, CAST(sum(n) AS BIGINT) AS n FROM (SELECT length(html) AS n, unnest(list_transform(range(1, len(string_split(p, '/')) + 1), lambda i: array_to_string(list_slice(string_split(p, '/'), 1, i), '/'))) AS up FROM (SELECT html, regexp_replace(split_part(split_part(url, '://', 2), '?', 1), '/$', '') AS p FROM pages {0})) GROUP BY 1"


@query(
    "A12_growth",
    f"""WITH o AS ({_ROLLED.format("WHERE page_id % 2 = 0")}), w AS ({_ROLLED.format("")}), b AS (SELECT path, w.n - coalesce(o.n, 0) AS growth, regexp_extract(path, '^(.*)/[^/]*$', 1) AS parent FROM w LEFT JOIN o USING (path)),
g AS (SELECT * FROM b WHERE growth >= 5000), d AS (SELECT path, growth FROM g WHERE path NOT IN (SELECT parent FROM g)), c AS (SELECT d.path, b.path AS child, b.growth AS grown, row_number() OVER (PARTITION BY d.path ORDER BY b.growth DESC, b.path) AS r FROM d JOIN b ON b.parent = d.path AND b.growth >= d.growth * 0.1),
k AS (SELECT path, string_agg(child || '=' || grown, ',' ORDER BY r) AS children FROM c WHERE r <= 3 GROUP BY 1)
SELECT d.path, d.growth, coalesce(children, '') AS children FROM d LEFT JOIN k USING (path)""",
)
def growth(spark, sf):
    pages = table(spark, sf, "pages")
    path = F.regexp_replace(F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("?"), F.lit(1)), "/$", "")
    sizes = lambda df: measures.rolled_up(df, path, {"n_bytes": F.length("html").cast("long")})
    return catalog.growth(sizes(pages.filter("page_id % 2 = 0")), sizes(pages), 5000)


@query("L18_state_moves", "WITH s AS (SELECT user_id AS key, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before, event_type AS state FROM events) SELECT key, before AS \"from\", state AS \"to\" FROM s WHERE before IS NOT NULL AND before <> state AND NOT (before = 'view' AND state = 'click')")
def state_moves(spark, sf):
    events = table(spark, sf, "events").select(F.col("user_id").alias("key"), F.col("event_type").alias("state"), "event_id")
    kinds = [r[0] for r in events.select("state").distinct().collect()]  # the states' names
    return catalog.allowed_moves(events, {(k, k) for k in kinds} | {("view", "click")}, F.col("event_id"))


@query("W02_gap_sessions", "WITH e AS (SELECT user_id, epoch_us(ts) AS t, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events), s AS (SELECT *, sum(CASE WHEN before IS NULL OR t - before > 86400000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t) AS s FROM e) SELECT user_id, min(t) AS start, max(t) + 86400000000 AS stop, count(*) AS n FROM s GROUP BY user_id, s")
def gap_sessions(spark, sf):
    rows = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return sessions.gap_sessions(rows, "user_id", "ts", "1 day", "2 days").select("user_id", F.unix_micros("start").alias("start"), F.unix_micros("stop").alias("stop"), "n")


@query("S06_shards", "SELECT source, CAST((row_number() OVER (ORDER BY sha256('1:2:' || source), source) - 1) % 4 AS INTEGER) AS shard FROM (SELECT DISTINCT source FROM documents)")
def shards(spark, sf):
    from tidemill.operators.picks import shard_of

    return shard_of(table(spark, sf, "documents").select("source").distinct(), 1, 2, 4, "source")


@query("J14_clipped", "SELECT event_id, greatest(e, 10) - 10 AS start, least(e + 20, 40) - 10 AS stop, e < 10 OR e + 20 > 40 AS clipped FROM (SELECT event_id, event_id % 50 AS e FROM events) WHERE e < 40 AND e + 20 > 10")
def clipped(spark, sf):
    rows = table(spark, sf, "events").select("event_id", (F.col("event_id") % 50).alias("e")).filter("e < 40 and e + 20 > 10")
    start, stop, cut = intervals.clipped(F.col("e"), F.col("e") + 20, F.lit(10), F.lit(40))
    return rows.select("event_id", start.alias("start"), stop.alias("stop"), cut.alias("clipped"))
