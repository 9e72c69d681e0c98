"""Catalog checks and quality gates over the corpus tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import catalog
from tidemill.operators import registry_checks as checks
from tidemill.plans.contract_queries import _PATHS
from tidemill.plans.registry import query, table


@query("L12_write_conflicts", "SELECT l_orderkey, step, field FROM (SELECT l_orderkey, l_linenumber AS step, l_returnflag AS field, l_linestatus = 'O' AS ok, min(l_linenumber) OVER (PARTITION BY l_orderkey, l_returnflag) AS first FROM lineitem) WHERE step > first AND NOT ok")
def write_conflicts(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("step"), F.col("l_returnflag").alias("field"), (F.col("l_linestatus") == "O").alias("override"))
    return checks.write_conflicts(rows, ["l_orderkey"])


@query(
    "L13_lineage_problems",
    """SELECT * FROM (SELECT p_partkey AS name, CASE WHEN NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = p_size * 3) THEN 'no source' WHEN NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = p_size * 2) THEN 'no result'
 WHEN p_type = 'PROMO' AND NOT coalesce(CASE WHEN a.s_nationkey = b.s_nationkey THEN b.s_acctbal < 0 ELSE b.s_acctbal >= 0 AND a.s_nationkey = b.s_suppkey % 25 END, false) THEN 'lineage' END AS problem
FROM part LEFT JOIN supplier a ON a.s_suppkey = p_size * 3 LEFT JOIN supplier b ON b.s_suppkey = p_size * 2) WHERE problem IS NOT NULL""",
)
def lineage_problems(spark, sf):
    sets = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ref"), F.col("s_nationkey").cast("long").alias("dataset_id"), F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey") % 25).alias("derived_from"))
    views = table(spark, sf, "part").select(F.col("p_partkey").alias("name"), (F.col("p_size") * 3).cast("long").alias("source"), (F.col("p_size") * 2).cast("long").alias("result"), F.when(F.col("p_type") == "PROMO", "exact").otherwise("inferred").alias("lineage"))
    return checks.lineage_problems(views, sets)


@query("L15_lookup", "WITH n AS (SELECT 'Brand ' || r_regionkey AS dataset_id, 'ID ' || r_regionkey AS alias FROM region UNION ALL SELECT p_brand, p_type FROM part), i AS (SELECT DISTINCT dataset_id AS name, dataset_id, 0 AS rank FROM n UNION SELECT alias, dataset_id, 1 FROM n) SELECT name, arg_min(dataset_id, (rank, dataset_id)) AS dataset_id FROM i GROUP BY 1 HAVING count(*) FILTER (WHERE rank = 0) = 1 OR count(*) FILTER (WHERE rank = 1) = 1")
def lookup(spark, sf):
    own = table(spark, sf, "region").select(F.concat(F.lit("Brand "), "r_regionkey").alias("dataset_id"), F.concat(F.lit("ID "), "r_regionkey").alias("alias"))
    return checks.lookup(own.unionByName(table(spark, sf, "part").select(F.col("p_brand").alias("dataset_id"), F.col("p_type").alias("alias"))))


@query("L16_dangling", "SELECT c_custkey, c_nationkey FROM customer WHERE c_acctbal < 0 AND c_nationkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')")
def dangling(spark, sf):
    # A customer in debt counts as superseded by the one that its nation's number names, unless that one is live and no builder.
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.col("c_custkey").alias("version_key"), F.when(F.col("c_acctbal") < 0, F.col("c_nationkey").cast("long")).alias("superseded_by"), "c_mktsegment")
    known = rows.withColumn("version_key", F.when(F.col("c_mktsegment") != "BUILDING", F.col("version_key")))
    return catalog.dangling(known).select("c_custkey", "c_nationkey")


@query("G05_dependents", f"WITH p AS (SELECT split_part(split_part(url, '://', 2), '?', 1) AS path FROM pages), z AS (SELECT DISTINCT split_part(path, '/', 1) AS prefix FROM ({_PATHS}) UNION SELECT 'no.such.host') SELECT prefix, count(path) AS n FROM z LEFT JOIN p ON path = prefix OR starts_with(path, prefix || '/') GROUP BY 1")
def dependents(spark, sf):
    paths = table(spark, sf, "pages").select(F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("?"), F.lit(1)).alias("path"))
    hosts = paths.select(F.split_part("path", F.lit("/"), F.lit(1)).alias("prefix"))
    return checks.dependents(paths, hosts.unionByName(spark.range(1).select(F.lit("no.such.host").alias("prefix"))))


@query("G07_index_gaps", "SELECT DISTINCT source, lang FROM documents WHERE (source, lang) NOT IN (SELECT (d.source, d.lang) FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE toxic = 1)")
def index_gaps(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang")
    return docs.join(docs.join(table(spark, sf, "labels").filter("toxic = 1"), "doc_id"), ["source", "lang"], "left_anti").select("source", "lang").distinct()


@query("G14_filled", "SELECT doc_id, coalesce(CASE WHEN n_chars < 1000 THEN n_chars END, toxic) AS size FROM documents d LEFT JOIN labels l USING (doc_id)")
def filled(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") < 1000, F.col("n_chars")).alias("size"))
    return checks.filled(rows, table(spark, sf, "labels").select("doc_id", F.col("toxic").cast("long").alias("size")), "doc_id", ["size"])


@query(
    "G15_contamination_report",
    "SELECT lang, count(*) AS n, count(*) FILTER (WHERE n_chars <> length(text)) AS n_span, count(*) FILTER (WHERE text IN (SELECT text FROM benchmark)) AS n_text, count(*) FILTER (WHERE doc_id IN (SELECT item_id FROM benchmark)) AS n_id FROM documents GROUP BY 1",
)
def contamination_report(spark, sf):
    digest = F.sha2("text", 256).alias("digest")
    held = table(spark, sf, "benchmark")
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars", F.length("text").alias("length"), digest)
    rows = docs.join(held.select(digest).distinct().withColumn("t", F.lit(True)), "digest", "left").join(held.select(F.col("item_id").alias("doc_id")).distinct().withColumn("i", F.lit(True)), "doc_id", "left")
    return rows.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("n_chars") != F.col("length")).alias("n_span"), F.count_if(F.col("t")).alias("n_text"), F.count_if(F.col("i")).alias("n_id"))


@query(
    "G17_gates",
    """WITH f AS (SELECT lang, count(*)::DOUBLE AS n, max(n_chars)::DOUBLE AS max, avg(n_chars) AS mean, median(n_chars)::DOUBLE AS median, count(*) FILTER (WHERE text IS NULL OR text = '')::DOUBLE AS n_empty FROM documents GROUP BY 1),
u AS (UNPIVOT f ON n, max, mean, median, n_empty INTO NAME gate VALUE value), l AS (SELECT unnest(['n', 'max', 'mean', 'median', 'n_empty']) AS gate, unnest([100.0, 0, 500, 800, 0]) AS least, unnest([300.0, 20000, 3000, 2000, 0]) AS most)
SELECT lang, gate, round(value, 4) AS value FROM u JOIN l USING (gate) WHERE value < least OR value > most UNION ALL SELECT 'xx', 'n', NULL""",
)
def quality_gates(spark, sf):
    limits = spark.createDataFrame([("n", 100.0, 300.0), ("max", 0.0, 20000.0), ("mean", 500.0, 3000.0), ("median", 800.0, 2000.0), ("n_empty", 0.0, 0.0)], "gate string, least double, most double")
    docs = table(spark, sf, "documents")
    known = docs.select("lang").distinct().join(F.broadcast(limits))  # five limits for each language
    extra = spark.createDataFrame([("xx", "n", 1.0, 9.0)], "lang string, gate string, least double, most double")
    return checks.gates(docs, "lang", "n_chars", F.coalesce(F.col("text") == "", F.lit(True)), known.unionByName(extra)).withColumn("value", F.round("value", 4))


@query(
    "A30_capped_shares",
    """WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), w AS (SELECT *, coalesce(sum(n) OVER (ORDER BY n, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, count(*) OVER () - row_number() OVER (ORDER BY n, source) + 1 AS remaining FROM c),
l AS (SELECT source, n, (100.0::DOUBLE - below) / remaining AS level FROM w) SELECT source, round(least(n::DOUBLE, coalesce(max(CASE WHEN n >= level THEN level END) OVER (), n::DOUBLE)), 6) AS share FROM l""",
)
def capped_shares(spark, sf):
    counts = table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return checks.stretched(counts, 100.0, "source", "n").withColumn("share", F.round("share", 6))


@query("A18_fragile", "WITH g AS (SELECT lang, source, count(*) AS n, avg(n_chars) AS size FROM documents GROUP BY 1, 2) SELECT lang, arg_max(source, (size, source)) AS source, round(max(size), 4) AS size FROM g WHERE n > 1 GROUP BY 1")
def fragile(spark, sf):
    cells = table(spark, sf, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"), F.avg("n_chars").alias("size")).filter("n > 1")
    return cells.groupBy("lang").agg(F.max_by("source", F.struct("size", "source")).alias("source"), F.round(F.max("size"), 4).alias("size"))


@query(
    "A22_split_ratios",
    "WITH s AS (SELECT lang, avg(n_chars) FILTER (WHERE source = 'src0') AS a, avg(n_chars) FILTER (WHERE source <> 'src0') AS b FROM documents GROUP BY 1) SELECT lang, round(a / b, 4) AS ratio, coalesce(a / b NOT BETWEEN 0.5 AND 2, true) AS off FROM s",
)
def split_ratios(spark, sf):
    side = lambda ok: F.avg(F.when(ok, F.col("n_chars")))
    rows = table(spark, sf, "documents").groupBy("lang").agg(side(F.col("source") == "src0").alias("a"), side(F.col("source") != "src0").alias("b")).withColumn("r", F.col("a") / F.col("b"))
    return rows.select("lang", F.round("r", 4).alias("ratio"), F.coalesce(~F.col("r").between(0.5, 2), F.lit(True)).alias("off"))
