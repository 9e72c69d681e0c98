"""Aggregates, intervals, similarity and text rules over the corpus tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import text
from tidemill.operators import intervals, measures, picks, similarity
from tidemill.plans.registry import query, table

_SPAN = "SELECT event_id AS id, user_id, epoch_us(ts) / 1000000 AS start, epoch_us(ts) / 1000000 + CAST(floor(coalesce(value, 0) * 60) AS BIGINT) + 1 AS stop FROM events"
_SPAN = _SPAN.replace("epoch_us(ts) / 1000000", "(epoch_us(ts) // 1000000)")


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    at = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).cast("long")
    rows = table(spark, sf, "events").select(F.col("event_id").alias("id"), "user_id", at.alias("start"), "value")
    return rows.select("id", "user_id", "start", (F.col("start") + F.floor(F.coalesce("value", F.lit(0.0)) * 60).cast("long") + 1).alias("stop"))


@query("A01_count", "SELECT count(*) AS n FROM documents WHERE lang = 'en'")
def count(spark, sf):
    return table(spark, sf, "documents").filter("lang = 'en'").agg(F.count("*").alias("n"))


@query("A02_split_counts", "SELECT split, count(*) AS n FROM (SELECT unnest([lang, source]) AS split FROM documents) GROUP BY 1")
def split_counts(spark, sf):
    return table(spark, sf, "documents").select(F.explode(F.array("lang", "source")).alias("split")).groupBy("split").agg(F.count("*").alias("n"))


@query("A03_exact_totals", "SELECT event_type, count(value) AS n, count(*) - count(value) AS skipped, CAST(sum(CAST(value AS DECIMAL(38,9))) AS DOUBLE) AS total FROM events GROUP BY 1")
def totals(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("value").alias("n"), (F.count("*") - F.count("value")).alias("skipped"), measures.exact_sum(F.col("value")).alias("total"))


@query("A05_precedence", "SELECT source, coalesce(max(n_chars) FILTER (WHERE lang = 'de'), max(n_chars) FILTER (WHERE lang = 'fr'), 0) AS best FROM documents GROUP BY 1")
def precedence(spark, sf):
    best = lambda x: F.max(F.when(F.col("lang") == x, F.col("n_chars")))
    return table(spark, sf, "documents").groupBy("source").agg(F.coalesce(best("de"), best("fr"), F.lit(0)).alias("best"))


@query("A06_peak", "SELECT source, arg_max(doc_id, n_chars * 1000000 - doc_id) AS doc_id FROM documents GROUP BY 1")
def peak(spark, sf):
    return table(spark, sf, "documents").groupBy("source").agg(F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id"))).alias("doc_id"))


@query("A08_pass_rate", "SELECT lang, count(*) FILTER (WHERE quality = 1) AS passed, count(*) FILTER (WHERE quality = 0) AS rejected, avg(CAST(quality AS DOUBLE)) AS rate FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def pass_rate(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return rows.groupBy("lang").agg(F.count_if(F.col("quality") == 1).alias("passed"), F.count_if(F.col("quality") == 0).alias("rejected"), F.avg("quality").alias("rate"))


@query("A10_sections", "SELECT source, CASE WHEN len(list(DISTINCT lang)) > 1 THEN 'multilingual' ELSE min(lang) END AS section FROM documents GROUP BY 1")
def sections(spark, sf):
    return table(spark, sf, "documents").groupBy("source").agg(F.when(F.size(F.collect_set("lang")) > 1, "multilingual").otherwise(F.min("lang")).alias("section"))


@query("A11_roll_up", "WITH p AS (SELECT string_split(split_part(split_part(url, '://', 2), '?', 1), '/') AS parts, CAST(length(html) AS BIGINT) AS n_bytes FROM pages) SELECT array_to_string(parts[1:n], '/') AS path, count(*) AS n, CAST(sum(n_bytes) AS BIGINT) AS n_bytes FROM (SELECT parts, n_bytes, unnest(range(1, len(parts) + 1)) AS n FROM p) GROUP BY 1")
def roll_up(spark, sf):
    path = F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("?"), F.lit(1))
    return measures.rolled_up(table(spark, sf, "pages"), path, {"n_bytes": F.length("html").cast("long")})


@query("A13_ratio_of_sums", "SELECT source, CAST(sum(toxic) AS DOUBLE) / greatest(sum(quality), 1) AS rate FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def ratio_of_sums(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").groupBy("source").agg(measures.ratio(F.col("toxic"), F.col("quality")).alias("rate"))


@query(
    "A16_wilson",
    """WITH s AS (SELECT lang, CAST(sum(toxic) AS DOUBLE) k, CAST(count(*) AS DOUBLE) n FROM documents JOIN labels USING (doc_id) GROUP BY 1)
SELECT lang, round(greatest((k/n + 1.96*1.96/(2*n) - 1.96*sqrt(k/n*(1-k/n)/n + 1.96*1.96/(4*n*n))) / (1 + 1.96*1.96/n), 0), 6) AS low, round(least((k/n + 1.96*1.96/(2*n) + 1.96*sqrt(k/n*(1-k/n)/n + 1.96*1.96/(4*n*n))) / (1 + 1.96*1.96/n), 1), 6) AS high FROM s""",
)
def wilson(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").groupBy("lang").agg(F.sum("toxic").cast("double").alias("k"), F.count("*").cast("double").alias("n"))
    low, high = measures.wilson(F.col("k"), F.col("n"))
    return rows.select("lang", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query("A15_bootstrap", None)
def bootstrap(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "doc_id", (F.col("n_chars") % 7 - 3).cast("double").alias("delta"), (F.col("n_chars") % 5).cast("double").alias("weight"))
    return measures.bootstrap(docs, ["lang"], "delta", "weight")


@query("A19_vocabulary", "SELECT word, n FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS word, count(*) AS n FROM documents GROUP BY 1) WHERE word <> '' AND n >= 50")
def vocabulary(spark, sf):
    return table(spark, sf, "documents").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).filter("word <> ''").groupBy("word").agg(F.count("*").alias("n")).filter("n >= 50")


@query("A23_percentiles", "SELECT lang, quantile_cont(n_chars, 0.1) AS p10, quantile_cont(n_chars, 0.5) AS p50, quantile_cont(n_chars, 0.9) AS p90 FROM documents GROUP BY 1")
def percentiles(spark, sf):
    p = lambda q: F.percentile("n_chars", F.lit(q)).alias(f"p{round(q * 100)}")
    return table(spark, sf, "documents").groupBy("lang").agg(p(0.1), p(0.5), p(0.9))


@query("A24_distinct_sizes", "SELECT lang, count(DISTINCT source) AS sources, count(DISTINCT text) AS texts FROM documents GROUP BY 1")
def distinct_sizes(spark, sf):
    # Texts are told apart by digest, so that none is shuffled; a first step spreads each language over its texts.
    docs = table(spark, sf, "documents")
    texts = docs.select("lang", F.sha2("text", 256).alias("digest")).distinct().groupBy("lang").agg(F.count("digest").alias("texts"))
    sources = docs.groupBy("lang").agg(F.count_distinct("source").alias("sources"))
    return texts.join(sources, "lang").select("lang", "sources", "texts")


@query("A25_multiset_digest", "SELECT CAST(sum(CAST('0x' || substr(h, 1, 8) AS BIGINT)) AS DOUBLE) AS w0, CAST(sum(CAST('0x' || substr(h, 57, 8) AS BIGINT)) AS DOUBLE) AS w7 FROM (SELECT sha256(doc_id || ':' || lang) AS h FROM documents)")
def digest(spark, sf):
    words = measures.multiset_digest(F.concat_ws(":", F.col("doc_id").cast("string"), "lang"))
    return table(spark, sf, "documents").agg(*words).select(F.col("w0").cast("double").alias("w0"), F.col("w7").cast("double").alias("w7"))


@query("A28_content_aliases", "SELECT sha256(text) AS k, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last FROM documents GROUP BY 1")
def aliases(spark, sf):
    return table(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("k")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


@query("A29_quotas", "WITH c AS (SELECT source, count(*) AS w FROM documents GROUP BY 1), s AS (SELECT source, w * 100.0::DOUBLE / sum(w) OVER () AS share FROM c), b AS (SELECT source, CAST(floor(share) AS BIGINT) AS base, row_number() OVER (ORDER BY round(share - floor(share), 9) DESC, source) AS r FROM s) SELECT source, base + CASE WHEN r <= 100 - (SELECT sum(base) FROM b) THEN 1 ELSE 0 END AS quota FROM b")
def quotas(spark, sf):
    cells = table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("w"))
    return picks.quotas(cells, 100, "w", "source")


@query("A32_reasons", "SELECT reason, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN n_chars < 500 THEN 'short' END, CASE WHEN lang <> 'en' THEN 'language' END, CASE WHEN contains(text, '###') THEN 'marks' END], lambda x: x IS NOT NULL)) AS reason FROM documents) GROUP BY 1")
def reasons(spark, sf):
    found = F.array(F.when(F.col("n_chars") < 500, "short"), F.when(F.col("lang") != "en", "language"), F.when(F.contains("text", F.lit("###")), "marks"))
    return table(spark, sf, "documents").select(F.explode(F.filter(found, lambda x: x.isNotNull())).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("O02_top_sources", "SELECT source, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_sources(spark, sf):
    return table(spark, sf, "documents").groupBy("source").agg(F.sum("n_chars").alias("n_chars")).orderBy(F.desc("n_chars"), "source").limit(10)


@query("O06_top_and_other", "WITH s AS (SELECT source, sum(n_chars) AS v, row_number() OVER (ORDER BY sum(n_chars) DESC, source) AS r FROM documents GROUP BY 1) SELECT CASE WHEN r <= 5 THEN source ELSE 'other' END AS source, CAST(sum(v) AS BIGINT) AS v FROM s GROUP BY 1")
def top_and_other(spark, sf):
    return measures.top_and_other(table(spark, sf, "documents").groupBy("source").agg(F.sum("n_chars").alias("v")), "source", "v", 5)


@query("J13_overlap_join", f"WITH s AS ({_SPAN}) SELECT a.user_id, count(*) AS n, CAST(sum(least(a.stop, b.stop) - greatest(a.start, b.start)) AS BIGINT) AS shared FROM s a JOIN s b ON a.user_id = b.user_id AND a.start < b.stop AND b.start < a.stop AND a.id < b.id GROUP BY 1")
def overlap_join(spark, sf):
    spans = _spans(spark, sf)
    pairs = intervals.overlap_join(spans, spans, ["user_id"], 3600.0).filter("l_id < r_id")
    return pairs.groupBy("user_id").agg(F.count("*").alias("n"), F.sum(F.least("l_stop", "r_stop") - F.greatest("l_start", "r_start")).alias("shared"))


@query("J15_alone", f"WITH s AS ({_SPAN}) SELECT id FROM s a WHERE NOT EXISTS (SELECT 1 FROM s b WHERE a.user_id = b.user_id AND a.id <> b.id AND a.start < b.stop AND b.start < a.stop)")
def alone(spark, sf):
    return intervals.alone(_spans(spark, sf), ["user_id"]).select("id")


@query("W02_sessions", f"WITH s AS ({_SPAN}), f AS (SELECT *, CASE WHEN start - lag(start) OVER w > 86400 THEN 1 ELSE 0 END AS new FROM s WINDOW w AS (PARTITION BY user_id ORDER BY start, id)) SELECT user_id, 1 + sum(new) AS sessions FROM f GROUP BY 1")
def sessions(spark, sf):
    rows = intervals.sessions(_spans(spark, sf), ["user_id"], "start", 86400, "id")
    return rows.groupBy("user_id").agg(F.max("session").alias("sessions"))


@query("W09_union_length", f"WITH s AS ({_SPAN}), r AS (SELECT *, max(stop) OVER (PARTITION BY user_id ORDER BY start, stop, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s), i AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY start, stop, id) AS island FROM r) SELECT user_id, CAST(sum(n) AS BIGINT) AS covered FROM (SELECT user_id, island, max(stop) - min(start) AS n FROM i GROUP BY 1, 2) GROUP BY 1")
def union_length(spark, sf):
    return intervals.union_length(_spans(spark, sf), ["user_id"])


@query("W10_crowded", f"WITH s AS ({_SPAN}), e AS (SELECT user_id, start AS t, 1 AS d FROM s UNION ALL SELECT user_id, stop, -1 FROM s), g AS (SELECT user_id, t, sum(d) AS d FROM e GROUP BY 1, 2), a AS (SELECT user_id, t, sum(d) OVER (PARTITION BY user_id ORDER BY t) AS active, lead(t) OVER (PARTITION BY user_id ORDER BY t) AS nxt FROM g) SELECT user_id, CAST(coalesce(sum(CASE WHEN active >= 2 THEN nxt - t END), 0) AS BIGINT) AS crowded FROM a GROUP BY 1")
def crowded(spark, sf):
    return intervals.crowded_length(_spans(spark, sf), ["user_id"])


@query("W03_clean_cuts", f"WITH s AS ({_SPAN}), r AS (SELECT *, max(stop) OVER (PARTITION BY user_id ORDER BY start, stop, id ROWS UNBOUNDED PRECEDING) AS reach, lead(start) OVER (PARTITION BY user_id ORDER BY start, stop, id) AS nxt FROM s) SELECT id, reach FROM r WHERE nxt IS NULL OR nxt - reach >= 600")
def clean_cuts(spark, sf):
    return intervals.clean_cuts(_spans(spark, sf), ["user_id"], 600).select("id", "reach")


@query(
    "W01_greedy_windows",
    f"""WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start, stop, id) AS r FROM ({_SPAN})),
g AS (SELECT DISTINCT user_id, 0::BIGINT AS r, NULL::BIGINT AS head, 0::BIGINT AS first, 0::BIGINT AS last FROM s
UNION ALL SELECT user_id, r, CASE WHEN stop - start > 36000 THEN NULL WHEN goes THEN head ELSE id END, CASE WHEN goes THEN first ELSE start END, CASE WHEN goes THEN greatest(last, stop) ELSE stop END FROM (SELECT s.*, g.head, g.first, g.last, g.head IS NOT NULL AND greatest(s.stop, last) - first <= 36000 AND s.start - last <= 86400 AS goes FROM g JOIN s ON s.user_id = g.user_id AND s.r = g.r + 1))
SELECT user_id, head, CAST(max(first) AS DOUBLE) AS first, CAST(max(last) AS DOUBLE) AS last, count(*) AS n FROM g WHERE head IS NOT NULL GROUP BY 1, 2""",
)
def greedy_windows(spark, sf):
    return intervals.greedy_windows(_spans(spark, sf), ["user_id"], 36000.0, 86400.0)


@query("J17_cosine_top", "WITH p AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id AND a.vec_id % 50 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 6) DESC, vec_id) AS rank FROM p) SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(s, 4) AS score FROM r WHERE rank <= 10")
def cosine_top(spark, sf):
    rows = table(spark, sf, "embeddings")
    return similarity.cosine_top(rows.filter("vec_id % 50 = 0"), rows, 10, "vec_id", "embedding").select("query_id", "vec_id", "rank", F.round("score", 4).alias("score"))


@query("J18_nearer_pairs", "SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS score FROM embeddings a, embeddings b WHERE a.vec_id < b.vec_id AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.3")
def nearer_pairs(spark, sf):
    return similarity.similar_pairs(table(spark, sf, "embeddings"), 0.3, "vec_id", "embedding").select("a", "b", F.round("score", 4).alias("score"))


@query("J18_similar_pairs", "SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS score FROM embeddings a, embeddings b WHERE a.vec_id < b.vec_id AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.9")
def similar_pairs(spark, sf):
    return similarity.similar_pairs(table(spark, sf, "embeddings"), 0.9, "vec_id", "embedding").select("a", "b", F.round("score", 4).alias("score"))


@query("F03_holds_word", "SELECT doc_id, contains(' ' || text || ' ', ' the ') AS has FROM documents")
def holds_word(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.holds_word(F.col("text"), F.lit("the")).alias("has"))


_PAIRS = "list_distinct(list_transform(range(1, length({0})), lambda i: substr({0}, i, 2)))"


@query("F09_bigram_jaccard", f"SELECT p_partkey, CAST(len(list_intersect({_PAIRS.format('p_name')}, {_PAIRS.format('p_brand')})) AS DOUBLE) / len(list_distinct(list_concat({_PAIRS.format('p_name')}, {_PAIRS.format('p_brand')}))) AS score FROM part")
def bigram_jaccard(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", text.jaccard(text.bigrams(F.col("p_name")), text.bigrams(F.col("p_brand"))).alias("score"))
    return rows


@query("F18_loops", None)
def loops(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.loops(F.col("text"), F.lit("x" * 5000)).alias("looped"))


@query("F13_edit_distance", "SELECT p_partkey, levenshtein(p_name, p_brand) AS distance FROM part")
def edit_distance(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.levenshtein("p_name", "p_brand").cast("long").alias("distance"))


@query("F45_number_kinds", "SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(text, '[0-9]+'), lambda r: CASE WHEN length(r) = 11 THEN 'phone' WHEN length(r) IN (17, 18) THEN 'id' END), lambda k: k IS NOT NULL))), ',') AS kinds FROM documents")
def number_kinds(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(text.number_kinds(F.col("text")), ",").alias("kinds"))


@query("F37_ancestors", "SELECT page_id, unnest(list_transform(range(1, len(string_split(url, '/')) + 1), lambda n: array_to_string(string_split(url, '/')[1:n], '/'))) AS path FROM pages")
def url_ancestors(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.explode(text.ancestors(F.col("url"))).alias("path"))
