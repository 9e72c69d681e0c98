"""Compositions of several operators over the corpus tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.functions import text
from tidemill.functions.order import order_key
from tidemill.operators import decisions, intervals, measures, records
from tidemill.operators import registry_checks as checks
from tidemill.plans.interval_queries import _DAY, _days
from tidemill.plans.registry import query, table


@query(
    "Q01_candidates",
    """WITH r AS (SELECT d.doc_id, d.text, CASE WHEN toxic = 1 THEN 'toxic' WHEN d.text IN (SELECT text FROM benchmark) THEN 'held out' WHEN n_chars < 200 THEN 'short' END AS reason, sha256('11:' || d.doc_id) AS key FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY reason, text ORDER BY key) AS place FROM r)
SELECT doc_id, coalesce(reason, CASE WHEN place > 1 THEN 'repeated' ELSE 'kept' END) AS reason FROM k""",
)
def candidates(spark, sf):
    digest = F.sha2("text", 256).alias("digest")
    held = table(spark, sf, "benchmark").select(digest).distinct().withColumn("held", F.lit(True))
    rows = table(spark, sf, "documents").select("doc_id", "n_chars", digest).join(table(spark, sf, "labels"), "doc_id", "left").join(held, "digest", "left")
    reason = text.first_reason([("toxic", F.col("toxic") == 1), ("held out", F.col("held")), ("short", F.col("n_chars") < 200)])
    named = rows.select("doc_id", "digest", reason.alias("reason"), order_key(11, "doc_id").alias("key"))
    # The first of each text among the rows without a reason: an aggregate, so that a text with very many copies is no hot window.
    first = named.filter("reason is null").groupBy("digest").agg(F.min("key").alias("first"))
    place = F.when(F.col("key") == F.col("first"), "kept").otherwise("repeated")
    return named.join(first, "digest", "left").select("doc_id", F.coalesce("reason", place).alias("reason"))


@query(
    "Q05_paired_scores",
    """WITH s AS (SELECT l_orderkey AS k, l_linenumber AS i, l_quantity AS e, l_extendedprice / 1000 AS n FROM lineitem)
SELECT a.i AS scenario, count(*) AS n, round(CAST(sum(a.e) AS DOUBLE) / greatest(sum(a.n), 1), 6) AS rate, round(CAST(sum(b.e) AS DOUBLE) / greatest(sum(b.n), 1), 6) AS base FROM s a JOIN s b ON a.k = b.k AND b.i = 1 AND a.i > 1 GROUP BY 1""",
)
def paired_scores(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("i"), F.col("l_quantity").alias("e"), (F.col("l_extendedprice") / 1000).alias("n"))
    base = rows.filter("i = 1").select("k", F.col("e").alias("be"), F.col("n").alias("bn"))
    both = rows.filter("i > 1").join(base, "k")
    return both.groupBy(F.col("i").alias("scenario")).agg(F.count("*").alias("n"), F.round(measures.ratio(F.col("e"), F.col("n")), 6).alias("rate"), F.round(measures.ratio(F.col("be"), F.col("bn")), 6).alias("base"))


@query("Q09_kept_labels", "SELECT lang, CASE WHEN n_chars = 0 THEN 'empty' WHEN n_chars < 200 OR toxic IS NULL OR toxic = 0 THEN 'kept' ELSE 'error rate' END AS verdict, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2")
def kept_labels(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    verdict = F.when(F.col("n_chars") == 0, "empty").when((F.col("n_chars") < 200) | F.col("toxic").isNull() | (F.col("toxic") == 0), "kept").otherwise("error rate")
    return rows.groupBy("lang", verdict.alias("verdict")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"))


@query("Q11_agreement", "WITH a AS (SELECT conv_id, lower(role) AS t, count(*) AS n FROM conversations GROUP BY 1, 2) SELECT x.t AS a, y.t AS b, count(*) AS n, count(*) FILTER (WHERE x.n = y.n) AS n_same FROM a x JOIN a y ON x.conv_id = y.conv_id AND x.t < y.t GROUP BY 1, 2")
def agreement(spark, sf):
    one = table(spark, sf, "conversations").groupBy("conv_id", F.lower("role").alias("t")).agg(F.count("*").alias("n"))
    x, y = (one.select("conv_id", F.col("t").alias(c), F.col("n").alias(f"n_{c}")) for c in "ab")
    return x.join(y, "conv_id").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("n"), F.count_if(F.col("n_a") == F.col("n_b")).alias("n_same"))


@query("Q12_reviewed", "SELECT coalesce(CASE WHEN toxic = 1 THEN 'review' END, source) AS final, CASE WHEN l.doc_id IS NULL THEN 'open' WHEN toxic = 1 THEN 'changed' ELSE 'agreed' END AS status, count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2")
def reviewed(spark, sf):
    reviews = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("seen"), F.when(F.col("toxic") == 1, "review").alias("word"))
    rows = table(spark, sf, "documents").join(reviews, "doc_id", "left")
    status = F.when(F.col("seen").isNull(), "open").when(F.col("word").isNotNull(), "changed").otherwise("agreed")
    return rows.groupBy(F.coalesce("word", "source").alias("final"), status.alias("status")).agg(F.count("*").alias("n"))


@query("Q13_release_changes", "SELECT coalesce(o.k, n.k) AS brand, CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'updated' END AS change FROM (SELECT p_brand AS k, count(*) AS c FROM part WHERE p_type <> 'PROMO' GROUP BY 1) o FULL JOIN (SELECT p_brand AS k, count(*) AS c FROM part WHERE p_size > 5 GROUP BY 1) n ON o.k = n.k WHERE o.c IS DISTINCT FROM n.c")
def release_changes(spark, sf):
    from tidemill.operators import joins

    release = lambda ok: table(spark, sf, "part").filter(ok).groupBy(F.col("p_brand").alias("brand")).agg(F.count("*").alias("n"))
    kinds = joins.differences(release("p_type <> 'PROMO'"), release("p_size > 5"), "brand", ["n"])
    return kinds.select("brand", F.when(F.col("kind") == "changed", "updated").otherwise(F.col("kind")).alias("change"))


@query("Q14_overview", "SELECT task, sum(CASE WHEN language = 'en' THEN 1 ELSE 0 END)::BIGINT AS english, count(*) AS n, round(CAST(sum(n_chars) AS DOUBLE) / 1000, 4) AS size FROM (SELECT source AS task, lang AS language, n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE coalesce(quality <> 0, true)) GROUP BY 1")
def overview(spark, sf):
    from tidemill.plans.record_queries import _records

    rows = records.RecordQuery().apply(_records(spark, sf))
    return rows.groupBy("task").agg(F.count_if(F.col("language") == "en").alias("english"), F.count("*").alias("n"), F.round(F.sum("n_chars").cast("double") / 1000, 4).alias("size"))


@query(
    "Q09_label_sets",
    """WITH r AS (SELECT p_brand, p_size / 10 AS seconds, length(p_name) AS n, levenshtein(p_name, substr(p_name, 1, greatest(1, length(p_name) - p_size % 7))) AS e FROM part), k AS (SELECT *, seconds < 2 OR 100 * e < 30 * n AS keep FROM r)
SELECT p_brand, count(*) AS n_full, count(*) FILTER (WHERE keep) AS n_kept, round(CAST(sum(e) AS DOUBLE) / greatest(sum(n), 1), 6) AS rate, round(coalesce(CAST(sum(e) FILTER (WHERE keep) AS DOUBLE), 0) / greatest(coalesce(sum(n) FILTER (WHERE keep), 0), 1), 6) AS kept_rate FROM k GROUP BY 1""",
)
def label_sets(spark, sf):
    heard = F.expr("substring(p_name, 1, greatest(1, length(p_name) - p_size % 7))")
    rows = table(spark, sf, "part").select("p_brand", F.col("p_name"), (F.col("p_size") / 10).alias("seconds"), F.length("p_name").alias("n"), F.levenshtein("p_name", heard).alias("e"))
    keep, _ = decisions.keep_rule(F.col("p_name"), F.col("seconds"), F.col("e"), F.col("n"))
    only = lambda c: F.coalesce(F.sum(F.when(F.col("keep"), F.col(c))), F.lit(0))
    rate = lambda e, n: F.round(e.cast("double") / F.greatest(n, F.lit(1)), 6)
    return rows.withColumn("keep", keep).groupBy("p_brand").agg(F.count("*").alias("n_full"), F.count_if("keep").alias("n_kept"), rate(F.sum("e"), F.sum("n")).alias("rate"), rate(only("e"), only("n")).alias("kept_rate"))


@query(
    "Q11_transcripts",
    """WITH t AS (SELECT p_partkey AS id, p_size % 6 AS cut, ['a', 'b', 'c'] AS who, [p_name, substr(p_name, 1 + p_size % 6), CASE WHEN p_size % 2 = 0 THEN p_name ELSE lower(p_type) END] AS said FROM part), r AS (SELECT id, unnest(who) AS who, unnest(said) AS said FROM t)
SELECT x.who AS a, y.who AS b, count(*) AS n, count(*) FILTER (WHERE x.said = y.said) AS n_same, round(CAST(sum(levenshtein(x.said, y.said)) AS DOUBLE) / greatest(sum(length(x.said)), 1), 6) AS rate FROM r x JOIN r y ON x.id = y.id AND x.who < y.who GROUP BY 1, 2""",
)
def transcripts_agree(spark, sf):
    part = table(spark, sf, "part")
    said = {"a": F.col("p_name"), "b": F.expr("substring(p_name, 1 + p_size % 6)"), "c": F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.lower("p_type"))}
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), said[a].alias("x"), said[b].alias("y")) for a in said for b in said if a < b])
    rows = part.select(F.explode(pairs).alias("p")).select("p.*")
    return rows.groupBy("a", "b").agg(F.count("*").alias("n"), F.count_if(F.col("x") == F.col("y")).alias("n_same"), F.round(measures.ratio(F.levenshtein("x", "y").cast("double"), F.length("x")), 6).alias("rate"))


@query(
    "Q14_families",
    """WITH s AS (SELECT p_partkey AS id, p_brand AS family, CASE WHEN p_size % 10 = 0 THEN p_partkey - 1 END AS sup, p_type = 'PROMO' AS planned, p_retailprice AS hours FROM part), l AS (SELECT * FROM s WHERE id NOT IN (SELECT sup FROM s WHERE sup IS NOT NULL)),
f AS (SELECT family, count(*) AS n, count(*) FILTER (WHERE planned) AS n_planned, max(hours) FILTER (WHERE NOT planned) AS hours FROM l GROUP BY 1) SELECT family, n, n_planned, hours, row_number() OVER (ORDER BY hours DESC NULLS LAST, family) AS place FROM f""",
)
def family_overview(spark, sf):
    specs = table(spark, sf, "part").select(F.col("p_partkey").alias("dataset_id"), F.col("p_brand").alias("family"), F.when(F.col("p_size") % 10 == 0, F.col("p_partkey") - 1).alias("supersedes"), (F.col("p_type") == "PROMO").alias("planned"), F.lit(1).alias("n_parts"))
    live = checks.inventory(specs).join(table(spark, sf, "part").select(F.col("p_partkey").alias("dataset_id"), F.col("p_brand").alias("family"), "p_retailprice"), "dataset_id")
    cells = live.groupBy("family").agg(F.count("*").alias("n"), F.count_if(F.col("kind") == "planned").alias("n_planned"), F.max(F.when(F.col("kind") != "planned", F.col("p_retailprice"))).alias("hours"))
    # One row for each family: small enough for one ordered window.
    return cells.withColumn("place", F.row_number().over(Window.orderBy(F.desc_nulls_last("hours"), "family")).cast("long"))


@query(
    "Q07_window_pairs",
    f"""WITH d AS ({_DAY}), w AS (SELECT id, user_id, start - 3600 AS start, stop + 3600 AS stop, who FROM d), k AS (SELECT w.id, x.who AS target FROM w, (SELECT DISTINCT who FROM d) x), h AS (SELECT w.id, d.who AS target, sum(least(w.stop, d.stop) - greatest(w.start, d.start)) AS spoken FROM w JOIN d ON w.user_id = d.user_id AND w.start < d.stop AND d.start < w.stop GROUP BY 1, 2)
SELECT k.id, k.target, CASE WHEN spoken IS NULL THEN 'negative' ELSE 'positive' END AS kind, coalesce(spoken, 0) AS spoken FROM k LEFT JOIN h USING (id, target)""",
)
def window_pairs(spark, sf):
    days = _days(spark, sf)
    windows = days.select("user_id", "id", (F.col("start") - 3600).alias("start"), (F.col("stop") + 3600).alias("stop"))
    kinds = [r[0] for r in days.select("who").distinct().collect()]  # the speakers' names
    hits = intervals.overlap_join(windows, days.select("user_id", "id", "start", "stop", "who"), ["user_id"], 7200.0)
    spoken = hits.groupBy(F.col("l_id").alias("id"), F.col("r_who").alias("target")).agg(F.sum(F.least("l_stop", "r_stop") - F.greatest("l_start", "r_start")).alias("spoken"))
    every = windows.select("id", F.explode(F.array(*map(F.lit, kinds))).alias("target"))
    return every.join(spoken, ["id", "target"], "left").select("id", "target", F.when(F.col("spoken").isNull(), "negative").otherwise("positive").alias("kind"), F.coalesce("spoken", F.lit(0)).alias("spoken"))
