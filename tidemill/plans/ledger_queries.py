"""Views, versions, protocols, storage and timelines over the corpus tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import intervals, joins
from tidemill.operators import registry_checks as checks
from tidemill.plans.interval_queries import _DAY, _days
from tidemill.plans.registry import query, table


@query(
    "L14_resolved_views",
    """WITH v AS (SELECT DISTINCT p_brand AS name, p_size AS version FROM part WHERE p_partkey % 40 = 0), q AS (SELECT p_partkey, p_brand AS name, CASE WHEN p_partkey % 3 > 0 THEN p_size END AS version FROM part), k AS (SELECT name, count(*) AS n, min(version) AS lone FROM v GROUP BY 1)
SELECT name, coalesce(q.version, -1) AS version, coalesce(CASE WHEN q.version IS NOT NULL THEN v.version WHEN n = 1 THEN lone END, -1) AS found, CASE WHEN n IS NULL THEN 'unknown view' WHEN q.version IS NULL AND n > 1 THEN 'version required' WHEN q.version IS NOT NULL AND v.version IS NULL THEN 'unknown version' END AS problem
FROM q LEFT JOIN k USING (name) LEFT JOIN v USING (name, version)""",
)
def resolved_views(spark, sf):
    part = table(spark, sf, "part")
    views = part.filter("p_partkey % 40 = 0").select(F.col("p_brand").alias("name"), F.col("p_size").alias("version"))
    asked = part.select(F.col("p_brand").alias("name"), F.when(F.col("p_partkey") % 3 > 0, F.col("p_size")).alias("version"))
    return checks.resolved_views(asked, views).select("name", F.coalesce("version", F.lit(-1)).alias("version"), F.coalesce("found", F.lit(-1)).alias("found"), "problem")


@query("L19_deepest_round", "SELECT l_orderkey, CAST(coalesce(max(n) FILTER (WHERE n = r), 0) AS INTEGER) AS head FROM (SELECT l_orderkey, n, row_number() OVER (PARTITION BY l_orderkey ORDER BY n) AS r FROM (SELECT DISTINCT l_orderkey, l_linenumber AS n FROM lineitem)) GROUP BY 1")
def deepest_round(spark, sf):
    return checks.deepest_round(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber").select("l_orderkey", F.col("head").cast("int").alias("head"))


_FIX = "SELECT doc_id * 2 AS doc_id, CASE WHEN quality = 1 THEN 'src0' ELSE 'src1' END AS f, 'fixed' AS t FROM labels"


@query("L20_exact_patches", f"SELECT d.doc_id, CASE WHEN p.f = d.source THEN p.t ELSE d.source END AS source FROM documents d LEFT JOIN ({_FIX}) p USING (doc_id)")
def exact_patches(spark, sf):
    return checks.exact_patched(table(spark, sf, "documents").select("doc_id", "source"), _fixes(spark, sf), "doc_id", "source")[0]


@query("L20_patch_problems", f"SELECT p.doc_id, CASE WHEN d.doc_id IS NULL THEN 'missing' ELSE 'stale' END AS problem FROM ({_FIX}) p LEFT JOIN documents d USING (doc_id) WHERE d.source IS DISTINCT FROM p.f")
def patch_problems(spark, sf):
    return checks.exact_patched(table(spark, sf, "documents").select("doc_id", "source"), _fixes(spark, sf), "doc_id", "source")[1]


def _fixes(spark, sf):
    return table(spark, sf, "labels").select((F.col("doc_id") * 2).alias("doc_id"), F.when(F.col("quality") == 1, "src0").otherwise("src1").alias("from"), F.lit("fixed").alias("to"))


@query(
    "J22_protocol_problems",
    """WITH p AS (SELECT doc_id, source FROM documents WHERE doc_id % 7 <> 0), f AS (SELECT doc_id FROM documents WHERE doc_id % 8 <> 0), l AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'x' ELSE source END AS source FROM documents WHERE doc_id % 9 <> 0)
SELECT doc_id, problem FROM (SELECT d.doc_id, CASE WHEN p.doc_id IS NULL AND f.doc_id IS NOT NULL THEN 'stray file' WHEN p.doc_id IS NULL AND l.doc_id IS NOT NULL THEN 'stray label' WHEN p.doc_id IS NULL THEN NULL WHEN f.doc_id IS NULL THEN 'missing file' WHEN l.doc_id IS NULL THEN 'missing label' WHEN p.source <> l.source THEN 'labels disagree' END AS problem
 FROM documents d LEFT JOIN p USING (doc_id) LEFT JOIN f USING (doc_id) LEFT JOIN l USING (doc_id)) WHERE problem IS NOT NULL""",
)
def protocol_problems(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    labels = docs.filter("doc_id % 9 <> 0").withColumn("source", F.when(F.col("doc_id") % 10 == 0, "x").otherwise(F.col("source")))
    return checks.protocol_problems(docs.filter("doc_id % 7 <> 0"), docs.filter("doc_id % 8 <> 0"), labels, "doc_id", "source")


@query(
    "A09_inventory",
    """WITH s AS (SELECT p_partkey AS id, p_brand AS family, CASE WHEN p_size % 10 = 0 THEN p_partkey - 1 END AS sup, p_type = 'PROMO' AS planned, p_size % 4 AS n FROM part), l AS (SELECT * FROM s WHERE id NOT IN (SELECT sup FROM s WHERE sup IS NOT NULL))
SELECT id AS dataset_id, CASE WHEN planned THEN 'planned' WHEN n > 1 THEN 'mixture' ELSE 'single' END AS kind, min(id) OVER (PARTITION BY family) AS head FROM l""",
)
def inventory(spark, sf):
    specs = table(spark, sf, "part").select(F.col("p_partkey").alias("dataset_id"), F.col("p_brand").alias("family"), F.when(F.col("p_size") % 10 == 0, F.col("p_partkey") - 1).alias("supersedes"), (F.col("p_type") == "PROMO").alias("planned"), (F.col("p_size") % 4).alias("n_parts"))
    return checks.inventory(specs)


@query(
    "G11_storage_findings",
    """WITH p AS (SELECT p_name AS path, p_partkey AS n_bytes, CASE WHEN p_size % 5 > 0 THEN p_brand END AS zone FROM part), z AS (SELECT DISTINCT p_brand AS zone, 40000 AS budget FROM part UNION ALL SELECT 'Brand#none', 1)
SELECT 'unregistered' AS category, path, n_bytes FROM p WHERE zone IS NULL UNION ALL SELECT 'over_budget', zone, CAST(sum(n_bytes) AS BIGINT) FROM p JOIN z USING (zone) GROUP BY zone, budget HAVING sum(n_bytes) > budget UNION ALL SELECT 'missing', zone, 0 FROM z WHERE zone NOT IN (SELECT zone FROM p WHERE zone IS NOT NULL)""",
)
def storage_findings(spark, sf):
    part = table(spark, sf, "part")
    paths = part.select(F.col("p_name").alias("path"), F.col("p_partkey").alias("n_bytes"), F.when(F.col("p_size") % 5 > 0, F.col("p_brand")).alias("zone"))
    zones = part.select(F.col("p_brand").alias("zone")).distinct().unionByName(spark.range(1).select(F.lit("Brand#none").alias("zone")))
    return checks.storage_findings(paths, zones.withColumn("budget", F.when(F.col("zone") == "Brand#none", 1).otherwise(40000)))


@query(
    "G13_role_totals",
    "WITH s AS (SELECT l_orderkey, sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS a, sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS r FROM lineitem GROUP BY 1) SELECT l_orderkey, CASE WHEN a IS NOT NULL THEN 'A' ELSE 'R' END AS role, coalesce(a, r) AS total FROM s WHERE coalesce(a, r) IS NOT NULL",
)
def role_totals(spark, sf):
    return checks.role_totals(table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "role"), "l_orderkey", ("A", "R"), "l_quantity")


@query(
    "G16_conversation_checks",
    """SELECT CAST(conv_id % 3 AS INTEGER) AS split, count(*) AS n, count(*) FILTER (WHERE coalesce(text, '') = '') AS n_empty, count(*) FILTER (WHERE role NOT IN ('user', 'assistant', 'system')) AS n_roles, count(*) - count(DISTINCT (conv_id, turn)) AS n_repeated,
 count(*) FILTER (WHERE length(text) > 4000) AS n_long FROM conversations GROUP BY 1""",
)
def conversation_checks(spark, sf):
    rows = table(spark, sf, "conversations")
    flags = {"n_empty": F.coalesce("text", F.lit("")) == "", "n_roles": ~F.col("role").isin("user", "assistant", "system"), "n_long": F.length("text") > 4000}
    per_turn = rows.groupBy("conv_id", "turn").agg(F.count("*").alias("n"), *[F.count_if(c).alias(k) for k, c in flags.items()])
    sums = [F.sum(c).alias(c) for c in ("n", *flags)]
    return per_turn.groupBy((F.col("conv_id") % 3).cast("int").alias("split")).agg(*sums, (F.sum("n") - F.count("*")).alias("n_repeated"))


@query("J26_contained", "WITH n AS (SELECT item_id, array_to_string(list_slice(string_split(text, ' '), 1, 5), ' ') AS needle FROM benchmark) SELECT item_id, count(doc_id) AS n_docs FROM n LEFT JOIN documents d ON contains(d.text, needle) GROUP BY 1")
def contained(spark, sf):
    needles = table(spark, sf, "benchmark").select("item_id", F.array_join(F.slice(F.split("text", " "), 1, 5), " ").alias("needle"))
    return joins.contained(needles, table(spark, sf, "documents"), "item_id", "needle", "doc_id", "text")


@query("J16_spoken_inside", f"WITH d AS ({_DAY}) SELECT a.id, sum(least(a.stop, b.stop) - greatest(a.start, b.start)) AS spoken FROM d a JOIN d b ON a.user_id = b.user_id AND a.who = 'error' AND b.who = 'click' AND a.start < b.stop AND b.start < a.stop GROUP BY 1")
def spoken_inside(spark, sf):
    days = _days(spark, sf)
    cols = ["user_id", "id", "start", "stop"]
    return intervals.spoken_inside(days.filter("who = 'error'").select(*cols), days.filter("who = 'click'").select(*cols), ["user_id"], 3600.0)


@query(
    "J31_timeline",
    f"""WITH d AS ({_DAY}), w AS (SELECT *, id % 2 = 0 AS present FROM d WHERE who <> 'view'), h AS (SELECT w.id, bool_or(w.who = d.who) AS speaks FROM w JOIN d ON w.user_id = d.user_id AND w.start < d.stop AND d.start < w.stop AND d.id % 5 > 0 GROUP BY 1)
SELECT w.id, CASE WHEN speaks IS NULL THEN 'no_annotation' WHEN speaks AND NOT present THEN 'absent_target_speaks' WHEN NOT speaks AND present THEN 'present_target_silent' END AS finding FROM w LEFT JOIN h USING (id)""",
)
def timeline(spark, sf):
    days = _days(spark, sf)
    windows = days.filter("who <> 'view'").withColumn("present", F.col("id") % 2 == 0)
    return intervals.timeline_findings(windows, days.filter("id % 5 > 0"), ["user_id"], "who", 3600.0)


@query(
    "W26_turn_windows",
    f"""WITH d AS ({_DAY}), i AS (SELECT a.id, a.user_id, a.start, max(b.stop) AS hi, count(*) AS n_turns, sum(b.stop - b.start) AS spoken FROM d a JOIN d b ON a.user_id = b.user_id AND b.start >= a.start AND b.stop <= a.start + 40000 GROUP BY 1, 2, 3)
SELECT i.id, hi, n_turns, spoken, EXISTS (SELECT 1 FROM d b WHERE b.user_id = i.user_id AND b.start < hi AND b.stop > hi AND b.stop > i.start AND b.start < i.start + 40000) AS crossed FROM i""",
)
def turn_windows(spark, sf):
    return intervals.turn_windows(_days(spark, sf).select("user_id", "id", "start", "stop"), ["user_id"], 40000.0, 20000.0)


@query(
    "G03_registration",
    """WITH a AS (SELECT p_partkey AS name, 'r' || p_size % 7 AS alias, p_brand AS path, p_size AS n_bytes FROM part), f AS (SELECT 'r' || p_size % 7 AS alias, p_brand AS path, min(p_size) AS size FROM part WHERE p_size > 9 GROUP BY 1, 2)
SELECT name, problem FROM (SELECT name, CASE WHEN a.alias IN ('r5', 'r6') THEN 'unknown alias' WHEN size IS NULL THEN 'missing file' WHEN size <> n_bytes THEN 'other size' END AS problem FROM a LEFT JOIN f USING (alias, path)) WHERE problem IS NOT NULL""",
)
def registration(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("name"), F.concat(F.lit("r"), (F.col("p_size") % 7).cast("string")).alias("alias"), F.col("p_brand").alias("path"), F.col("p_size").alias("n_bytes"))
    files = part.filter("n_bytes > 9").groupBy("alias", "path").agg(F.min("n_bytes").alias("size"))
    return checks.registration_problems(part, part.select("alias").filter("alias not in ('r5', 'r6')"), files)


@query("S08_samples", "SELECT doc_id, lang FROM documents WHERE doc_id % 5 > 0")
def samples(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang", F.when(F.col("doc_id") % 5 > 0, F.col("source")).alias("text"))
    return checks.samples(rows, None, "doc_id", "text").select("doc_id", "lang")


@query("S08_annotated_samples", "SELECT d.doc_id, 'q' || quality AS text FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE toxic = 0")
def annotated_samples(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.lit(None).cast("string").alias("text"))
    found = table(spark, sf, "labels").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("text"), F.when(F.col("toxic") == 0, "ok").otherwise("failed").alias("status"))
    return checks.samples(rows, found, "doc_id", "text").select("doc_id", "text")


@query(
    "Q06_dropped_windows",
    f"""WITH d AS ({_DAY}), i AS (SELECT a.id, a.user_id, a.start, max(b.stop) AS hi, count(*) AS n_turns, sum(b.stop - b.start) AS spoken FROM d a JOIN d b ON a.user_id = b.user_id AND b.start >= a.start AND b.stop <= a.start + 40000 GROUP BY 1, 2, 3),
c AS (SELECT *, EXISTS (SELECT 1 FROM d b WHERE b.user_id = i.user_id AND b.start < hi AND b.stop > hi AND b.stop > i.start AND b.start < i.start + 40000) AS crossed FROM i)
SELECT CASE WHEN crossed THEN 'crossed' WHEN n_turns < 2 THEN 'one turn' WHEN spoken < 0.1 * (hi - start) THEN 'sparse' ELSE 'kept' END AS verdict, count(*) AS n, sum(n_turns)::BIGINT AS n_turns FROM c GROUP BY 1""",
)
def dropped_windows(spark, sf):
    days = _days(spark, sf).select("user_id", "id", "start", "stop")
    rows = intervals.turn_windows(days, ["user_id"], 40000.0, 20000.0).join(days.select("id", "start"), "id")
    verdict = F.when(F.col("crossed"), "crossed").when(F.col("n_turns") < 2, "one turn").when(F.col("spoken") < 0.1 * (F.col("hi") - F.col("start")), "sparse").otherwise("kept")
    return rows.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"), F.sum("n_turns").alias("n_turns"))


@query(
    "U08_shared_between_splits",
    """WITH k AS (SELECT DISTINCT source AS s, 'text' AS kind, md5(text) AS key FROM documents WHERE text IS NOT NULL UNION SELECT DISTINCT source, 'size', CAST(n_chars AS VARCHAR) FROM documents)
SELECT a.kind, a.s AS a, b.s AS b, count(*) AS n FROM k a JOIN k b ON a.kind = b.kind AND a.key = b.key AND a.s < b.s GROUP BY 1, 2, 3""",
)
def shared_between_splits(spark, sf):
    return checks.shared_between(table(spark, sf, "documents"), "source", {"text": F.md5("text"), "size": F.col("n_chars")})


@query("W19_last_values", "SELECT user_id, event_type, arg_max(round(value, 2), event_id) AS value FROM events GROUP BY 1, 2")
def last_values(spark, sf):
    return table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.max_by(F.round("value", 2), "event_id").alias("value"))


@query(
    "A05_duration_ladder",
    """WITH r AS (SELECT l_orderkey, CASE WHEN l_linenumber = 7 THEN 'legacy' WHEN l_linestatus = 'O' THEN 'top' ELSE 'split' END AS role, l_quantity AS q FROM lineitem), s AS (SELECT l_orderkey, sum(q) FILTER (WHERE role = 'legacy') AS a, sum(q) FILTER (WHERE role = 'top') AS b, sum(q) FILTER (WHERE role = 'split') AS c FROM r GROUP BY 1)
SELECT l_orderkey, CASE WHEN a IS NOT NULL THEN 'legacy' WHEN b IS NOT NULL THEN 'top' ELSE 'split' END AS role, coalesce(a, b, c) AS total FROM s""",
)
def duration_ladder(spark, sf):
    role = F.when(F.col("l_linenumber") == 7, "legacy").when(F.col("l_linestatus") == "O", "top").otherwise("split")
    return checks.role_totals(table(spark, sf, "lineitem").withColumn("role", role), "l_orderkey", ("legacy", "top", "split"), "l_quantity")


@query("J04_located_or_missing", "SELECT l_orderkey, l_linenumber, l_partkey, coalesce(p_brand, '') AS place, p_partkey IS NULL AS missing FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 3) ON l_partkey = p_partkey")
def located_or_missing(spark, sf):
    facts = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    places = table(spark, sf, "part").filter("p_size > 3").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("place"))
    found, missing = joins.located(facts, places, "l_partkey")
    rows = found.withColumn("missing", F.lit(False)).unionByName(missing.withColumn("place", F.lit("")).withColumn("missing", F.lit(True)))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "place", "missing")


@query("A04_merged_parts", "SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS n_chars, max(n_chars) AS longest FROM documents GROUP BY 1")
def merged_parts(spark, sf):
    # Parts of 1000 documents, as a run writes them, and then their sums: parts can be added in any order.
    parts = table(spark, sf, "documents").groupBy("lang", F.floor(F.col("doc_id") / 1000).alias("part")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"), F.max("n_chars").alias("longest"))
    return parts.groupBy("lang").agg(F.sum("n").alias("n"), F.sum("n_chars").alias("n_chars"), F.max("longest").alias("longest"))
