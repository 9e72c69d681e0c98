"""Further joins, set operations and audit counts over the corpus tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import joins, picks, similarity
from tidemill.plans.registry import query, table


@query("J08_unseen", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND text NOT IN (SELECT text FROM conversations WHERE text IS NOT NULL)")
def unseen(spark, sf):
    digest = F.sha2("text", 256).alias("digest")  # texts themselves aren't shuffled
    docs = table(spark, sf, "documents").filter("text is not null").select("doc_id", digest)
    return docs.join(table(spark, sf, "labels"), "doc_id", "left_anti").join(table(spark, sf, "conversations").select(digest), "digest", "left_anti").select("doc_id")


@query("J10_three_way", "SELECT l_orderkey, l_linenumber, o_orderpriority, CASE WHEN p_type = 'PROMO' THEN p_name END AS promo FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R'")
def three_way(spark, sf):
    lines = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_partkey")
    rows = lines.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return rows.select("l_orderkey", "l_linenumber", "o_orderpriority", F.when(F.col("p_type") == "PROMO", F.col("p_name")).alias("promo"))


@query(
    "J12_misaligned",
    """WITH a AS (SELECT doc_id AS k, count(*) AS n, min(lang) AS v FROM documents WHERE lang <> 'fr' GROUP BY 1), b AS (SELECT conv_id AS k, count(*) AS n, 'en' AS v FROM conversations GROUP BY 1)
SELECT * FROM (SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.n IS NULL THEN 'missing' WHEN a.n IS NULL THEN 'stray' WHEN a.n > 1 OR b.n > 1 THEN 'repeated' WHEN a.v IS DISTINCT FROM b.v THEN 'different' END AS problem FROM a FULL JOIN b ON a.k = b.k) WHERE problem IS NOT NULL""",
)
def misaligned(spark, sf):
    docs = table(spark, sf, "documents").filter("lang <> 'fr'").select(F.col("doc_id").alias("k"), F.col("lang").alias("v"))
    return joins.misaligned(docs, table(spark, sf, "conversations").select(F.col("conv_id").alias("k"), F.lit("en").alias("v")), "k", "v")


@query("J19_covered_terms", "WITH t AS (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS term FROM part), w AS (SELECT DISTINCT term FROM t UNION SELECT 'unheard') SELECT w.term, count(p_partkey) AS n, min(p_partkey) AS first FROM w LEFT JOIN t ON t.term = w.term GROUP BY 1")
def covered_terms(spark, sf):
    parts, words = table(spark, sf, "part"), F.split("p_name", " ")
    terms = parts.select(F.explode(words).alias("term")).unionByName(spark.range(1).select(F.lit("unheard").alias("term")))
    return joins.covering(terms, parts, "p_partkey", words)


@query(
    "J20_shared_openings",
    "WITH k AS (SELECT doc_id, source, string_split(text, ' ')[1] AS opening FROM documents) SELECT doc_id, (SELECT count(*) FROM k b WHERE b.opening = a.opening AND b.source <> a.source) AS n_others FROM k a WHERE n_others > 0",
)
def shared_openings(spark, sf):
    return joins.shared_openings(table(spark, sf, "documents"), ["doc_id"], F.split("text", " ")[0], "source")


@query("J23_missing_by", "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO') GROUP BY 1")
def missing_by(spark, sf):
    return table(spark, sf, "lineitem").join(table(spark, sf, "part").filter("p_type = 'PROMO'").select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_anti").groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("J27_attached", "SELECT d.doc_id, lang, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def attached(spark, sf):
    rows, _ = joins.attached(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id", ["quality", "toxic"])
    return rows.select("doc_id", "lang", "quality", "toxic")


@query("J27_problems", "SELECT count(*) AS n_labels, 0::BIGINT AS n_twice, count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')) AS n_without_parent, 0 AS n_clashes FROM labels")
def attach_problems(spark, sf):
    return joins.attached(table(spark, sf, "documents").filter("lang = 'en'"), table(spark, sf, "labels"), "doc_id", ["quality", "toxic"])[1]


@query(
    "J28_group_fit",
    """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), u AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS v FROM e WHERE list_inner_product(v, v) > 0),
c AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM u), r AS (SELECT vec_id, label, x, sum(x) OVER (PARTITION BY label, pos) - x AS rest FROM c)
SELECT vec_id, label, CASE WHEN sum(rest * rest) > 1e-18 THEN round(sum(x * rest) / sqrt(sum(rest * rest)), 4) END AS fit FROM r GROUP BY 1, 2""",
)
def group_fit(spark, sf):
    return similarity.group_fit(table(spark, sf, "embeddings"), "vec_id", "embedding", "label").withColumn("fit", F.round("fit", 4))


@query("U01_ordered_union", "SELECT 0 AS part, doc_id AS seq, text FROM documents WHERE lang = 'en' UNION ALL SELECT 1, item_id, text FROM benchmark")
def ordered_union(spark, sf):
    parts = [table(spark, sf, "documents").filter("lang = 'en'").select(F.col("doc_id").alias("seq"), "text"), table(spark, sf, "benchmark").select(F.col("item_id").alias("seq"), "text")]
    a, b = (p.withColumn("part", F.lit(i)) for i, p in enumerate(parts))
    return a.unionByName(b)


@query("U02_reference_keys", "SELECT s_nationkey AS key FROM supplier UNION SELECT c_nationkey FROM customer")
def reference_keys(spark, sf):
    return table(spark, sf, "supplier").select(F.col("s_nationkey").alias("key")).union(table(spark, sf, "customer").select("c_nationkey")).distinct()


@query("U05_split_lists", "SELECT source, string_agg(lang, ',' ORDER BY lang) AS splits FROM (SELECT DISTINCT source, lang FROM documents) GROUP BY 1")
def split_lists(spark, sf):
    return table(spark, sf, "documents").groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("splits"))


@query("U06_disjoint", "SELECT 'text' AS kind, count(DISTINCT text) AS n FROM documents WHERE text IN (SELECT text FROM benchmark) UNION ALL SELECT 'id', count(DISTINCT doc_id) FROM documents WHERE doc_id IN (SELECT item_id FROM benchmark)")
def disjoint(spark, sf):
    digests = lambda df: df.withColumn("text", F.sha2("text", 256))
    docs, held = digests(table(spark, sf, "documents")), digests(table(spark, sf, "benchmark").withColumnRenamed("item_id", "doc_id"))
    shared = lambda kind, c: docs.select(c).join(held.select(c), c, "left_semi").agg(F.count_distinct(c).alias("n")).select(F.lit(kind).alias("kind"), "n")
    return shared("text", "text").unionByName(shared("id", "doc_id"))


@query("O09_versions", "SELECT p_brand, string_agg(v, ',' ORDER BY v) AS versions FROM (SELECT DISTINCT p_brand, p_type AS v FROM part) GROUP BY 1")
def versions(spark, sf):
    return table(spark, sf, "part").groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("versions"))


@query("A07_coverage", "SELECT CASE WHEN toxic IS NOT NULL THEN 'reported' WHEN l.doc_id IS NOT NULL THEN 'reference' ELSE 'missing' END AS coverage, count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1")
def coverage(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels").withColumn("there", F.lit(True)), "doc_id", "left")
    return rows.groupBy(F.when(F.col("toxic").isNotNull(), "reported").when(F.col("there"), "reference").otherwise("missing").alias("coverage")).agg(F.count("*").alias("n"))


@query("A21_audit", "SELECT CASE WHEN quality = 1 THEN 'pass' ELSE 'reject' END AS verdict, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars, count(*) FILTER (WHERE toxic = 1) AS n_toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2")
def audit(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return rows.groupBy(F.when(F.col("quality") == 1, "pass").otherwise("reject").alias("verdict"), "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"), F.count_if(F.col("toxic") == 1).alias("n_toxic"))


@query("A27_status_counts", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY 1, 2")
def status_counts(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("n_customers"))


@query("A33_tally", "SELECT event_type, count(*) AS n, sum(CASE WHEN value IS NULL THEN 0 ELSE 1 END)::BIGINT AS n_valued, round(sum(CAST(value AS DECIMAL(38,9)))::DOUBLE / 3600, 6) AS hours FROM events GROUP BY 1")
def tally(spark, sf):
    from tidemill.operators.measures import exact_sum

    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count("value").alias("n_valued"), F.round(exact_sum(F.col("value")) / 3600, 6).alias("hours"))


@query("A34_twins", "SELECT a.label, avg(CASE WHEN a.embedding = b.embedding THEN 1.0 ELSE 0.0 END) AS same FROM embeddings a JOIN embeddings b ON a.vec_id + 1 = b.vec_id GROUP BY 1")
def twins(spark, sf):
    rows = table(spark, sf, "embeddings")
    other = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("e2"))
    return rows.join(other, "vec_id").groupBy("label").agg(F.avg((F.col("embedding") == F.col("e2")).cast("double")).alias("same"))


@query("W19_last_answers", "SELECT user_id, event_type, arg_max(event_id, event_id) AS event_id FROM events GROUP BY 1, 2")
def last_answers(spark, sf):
    return table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.max_by("event_id", "event_id").alias("event_id"))


@query("W22_hash_sample", "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY sha256('9:' || doc_id), doc_id) AS r FROM documents) WHERE r <= 5")
def hash_sample(spark, sf):
    from tidemill.functions.order import order_key

    rows = table(spark, sf, "documents").select("source", "doc_id").withColumn("key", order_key(9, "doc_id"))
    return picks.smallest(rows, ["source"], "key", "doc_id", 5).select("source", "doc_id")


@query("W24_index_runs", "WITH r AS (SELECT user_id, event_id, event_id - row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM events) SELECT user_id, min(event_id) AS first, count(*) AS n FROM r GROUP BY user_id, run")
def index_runs(spark, sf):
    return picks.index_runs(table(spark, sf, "events"), ["user_id"], "event_id")


@query("O03_ranked_findings", "SELECT kind, n_bytes, row_number() OVER (ORDER BY rank, n_bytes DESC, kind)::INTEGER AS place FROM (SELECT event_type AS kind, count(*) AS n_bytes, coalesce(nullif(list_position(['error', 'purchase'], event_type), 0), 99) AS rank FROM events GROUP BY 1)")
def ranked_findings(spark, sf):
    kinds = table(spark, sf, "events").groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("n_bytes"))
    return picks.ranked_kinds(kinds, "kind", ["error", "purchase"], "n_bytes")
