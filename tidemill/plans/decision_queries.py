"""Keep rules, judges, pools, retrieval and word rules over the corpus tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.functions import text
from tidemill.functions import transcripts as T
from tidemill.functions.order import order_key
from tidemill.operators import decisions, picks
from tidemill.plans.registry import query, table


@query("P13_clean_action", "SELECT event_id, coalesce(event_type <> 'error' AND (event_type = 'click' OR event_id % 3 = 0), false) AS keep FROM events")
def clean_action(spark, sf):
    passed = F.when(F.col("event_type") == "error", "false").otherwise("true")
    action = F.when((F.col("event_type") == "click") | (F.col("event_id") % 3 == 0), "keep_original").otherwise("rewrite")
    document = F.try_parse_json(F.concat(F.lit('{"clean":{"pass":'), passed, F.lit(',"action":"'), action, F.lit('"}}')))
    keep = F.try_variant_get(document, "$.clean.pass", "boolean") & (F.try_variant_get(document, "$.clean.action", "string") == "keep_original")
    return table(spark, sf, "events").select("event_id", F.coalesce(keep, F.lit(False)).alias("keep"))


@query("P16_gate", "SELECT event_id, CASE WHEN value IS NULL THEN 'unmeasured' WHEN value < 5 THEN 'quiet' WHEN value < 20 AND event_type = 'view' THEN 'sparse' ELSE 'kept' END AS verdict FROM events")
def gate(spark, sf):
    reason = text.first_reason([("unmeasured", F.col("value").isNull()), ("quiet", F.col("value") < 5), ("sparse", (F.col("value") < 20) & (F.col("event_type") == "view"))])
    return table(spark, sf, "events").select("event_id", F.coalesce(reason, F.lit("kept")).alias("verdict"))


@query(
    "P17_keep_rule",
    """WITH e AS (SELECT p_partkey, CASE WHEN p_size % 13 = 0 THEN '' ELSE p_name END AS label, p_size / 10 AS seconds, levenshtein(p_name, substr(p_name, 1, greatest(1, length(p_name) - p_size % 7))) AS errors, length(p_name) AS n FROM part),
r AS (SELECT p_partkey, CASE WHEN label = '' THEN 'label empty' WHEN seconds < 2 THEN 'short, not judged' WHEN 100 * errors < 30 * n THEN 'few errors' ELSE 'many errors' END AS reason FROM e)
SELECT p_partkey, reason IN ('short, not judged', 'few errors') AS keep, reason FROM r""",
)
def keep_rule(spark, sf):
    heard = F.expr("substring(p_name, 1, greatest(1, length(p_name) - p_size % 7))")
    label = F.when(F.col("p_size") % 13 == 0, "").otherwise(F.col("p_name"))
    keep, reason = decisions.keep_rule(label, F.col("p_size") / 10, F.levenshtein("p_name", heard), F.length("p_name"))
    return table(spark, sf, "part").select("p_partkey", keep.alias("keep"), reason.alias("reason"))


@query(
    "P18_consensus",
    """WITH r AS (SELECT p_partkey, p_name AS g, CASE WHEN p_size % 5 = 0 THEN '' ELSE substr(p_name, 1 + p_size % 9) END AS q, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN p_name ELSE lower(p_type) END AS f FROM part),
e AS (SELECT *, levenshtein(q, f) / greatest(length(q), length(f), 1) AS apart, levenshtein(g, q) / greatest(length(g), 1) AS a, levenshtein(g, f) / greatest(length(g), 1) AS b FROM r),
d AS (SELECT p_partkey, CASE WHEN q = '' AND f = '' THEN 'both empty' WHEN a <= 0.2 AND b <= 0.2 THEN 'both read it' WHEN a >= 0.6 AND b >= 0.6 THEN CASE WHEN q = '' OR f = '' THEN 'one empty, other far' WHEN apart >= 0.6 THEN 'both far and apart' ELSE 'both far but agree' END ELSE 'partly read' END AS reason FROM e)
SELECT p_partkey, reason, CASE WHEN reason = 'both read it' THEN 'text' WHEN reason IN ('both empty', 'one empty, other far', 'both far and apart') THEN 'empty' END AS label FROM d""",
)
def consensus(spark, sf):
    first = F.when(F.col("p_size") % 5 == 0, "").otherwise(F.expr("substring(p_name, 1 + p_size % 9)"))
    case = F.col("p_partkey") % 4
    second = F.when(case == 0, "").when(case == 1, F.col("p_name")).otherwise(F.lower("p_type"))
    label, reason = decisions.consensus(F.col("p_name"), first, second)
    return table(spark, sf, "part").select("p_partkey", label.alias("label"), reason.alias("reason"))


@query("P21_left_over", "SELECT p_partkey, trim(replace(replace(replace(replace(p_name, 'widget', ''), 'small', ''), 'ring', ''), 'red', '')) AS rest FROM part")
def left_over(spark, sf):
    return table(spark, sf, "part").select("p_partkey", decisions.left_over(F.col("p_name"), ["red", "ring", "small", "widget"]).alias("rest"))


@query("P22_scrubbed", """SELECT page_id, '{"id":"' || page_id || '","size":"' || length(html) || '"}' AS document, 2 AS n_dropped FROM pages""")
def scrubbed(spark, sf):
    document = F.to_json(F.struct(F.col("page_id").cast("string").alias("id"), F.col("url").alias("path"), F.length("html").cast("string").alias("size"), F.lit("/a").alias("audio_path")))
    clean, dropped = text.scrubbed(document, ("path", "audio_path"))
    return table(spark, sf, "pages").select("page_id", clean.alias("document"), dropped.alias("n_dropped"))


@query(
    "P24_pools",
    """SELECT doc_id, 'short' AS pool FROM documents WHERE n_chars < 500 AND lang IN ('en', 'fr') UNION ALL SELECT doc_id, 'numbered' FROM documents WHERE regexp_matches(text, '[0-9]{3}') AND source <> 'src0'
UNION ALL SELECT doc_id, 'terms' FROM documents WHERE regexp_matches(text, 'onand|thand|and')""",
)
def pools(spark, sf):
    conditions = {
        "short": (F.col("n_chars") < 500) & F.col("lang").isin("en", "fr"),
        "numbered": F.col("text").rlike("[0-9]{3}") & (F.col("source") != "src0"),
        "terms": F.col("text").rlike("onand|thand|and"),
    }
    return decisions.pools(table(spark, sf, "documents"), conditions).select("doc_id", "pool")


_BIGRAMS = "CASE WHEN length({0}) < 2 THEN list_filter([{0}], lambda x: x <> '') ELSE list_distinct(list_transform(range(1, length({0})), lambda i: substr({0}, i, 2))) END"
_SCORE = f"""CASE WHEN w <> '' AND contains(q, w) THEN 2.0 ELSE 0.0 END + 0.5 * len(list_filter(string_split(w, ''), lambda c: contains(q, c))) / greatest(length(w), 1)
 + 0.3 * len(list_intersect({_BIGRAMS.format('w')}, {_BIGRAMS.format('q')})) / greatest(len(list_distinct(list_concat({_BIGRAMS.format('w')}, {_BIGRAMS.format('q')}))), 1)"""


@query("F10_retrieval_score", f"SELECT p_partkey, round(CAST({_SCORE} AS DOUBLE), 6) AS score FROM (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN split_part(p_name, ' ', 2) ELSE lower(p_type) END AS w, replace(p_name, ' ', '') AS q FROM part)")
def retrieval_score(spark, sf):
    word = F.when(F.col("p_size") % 3 == 0, F.split_part("p_name", F.lit(" "), F.lit(2))).otherwise(F.lower("p_type"))
    return table(spark, sf, "part").select("p_partkey", F.round(decisions.retrieval_score(word, F.replace("p_name", F.lit(" "), F.lit(""))), 6).alias("score"))


@query(
    "Q03_best_terms",
    f"""WITH t AS (SELECT DISTINCT p_size % 5 AS pool, split_part(p_name, ' ', 2) AS w FROM part UNION SELECT DISTINCT p_size % 5, lower(p_type) FROM part), s AS (SELECT p_partkey AS query_id, w AS term, round(CAST({_SCORE} AS DOUBLE), 6) AS score FROM (SELECT p_partkey, p_size % 5 AS pool, replace(p_name, ' ', '') AS q FROM part) JOIN t USING (pool))
SELECT * FROM (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, sha256(term)) AS INTEGER) AS rank, term, score FROM s) WHERE rank <= 4""",
)
def best_terms(spark, sf):
    part = table(spark, sf, "part").withColumn("pool", F.col("p_size") % 5)
    terms = part.select("pool", F.split_part("p_name", F.lit(" "), F.lit(2)).alias("term")).union(part.select("pool", F.lower("p_type"))).distinct()
    return decisions.best_terms(part.select(F.col("p_partkey").alias("query_id"), "pool", F.replace("p_name", F.lit(" "), F.lit("")).alias("query")), terms, "pool", 4)


@query("F11_reading_key", "WITH k AS (SELECT c_custkey, replace(replace(lower(c_mktsegment || 'Ñéè'), 'éè', 'ee'), 'ch', 'x') AS s FROM customer) SELECT c_custkey, array_to_string(list_transform(range(1, length(s) + 1), lambda i: CASE WHEN i > 1 AND substr(s, i, 1) = substr(s, i - 1, 1) THEN '' ELSE substr(s, i, 1) END), '') AS key FROM k")
def reading_key(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", text.reading_key(F.concat("c_mktsegment", F.lit("Ñéè")), [("ch", "x")]).alias("key"))


@query("F12_variant_groups", "SELECT regexp_replace(lower(CASE WHEN p_size % 2 = 0 THEN p_name ELSE upper(replace(p_name, ' ', '-')) END), '[-. ]+', '', 'g') AS key, count(*) AS n FROM part GROUP BY 1")
def variant_groups(spark, sf):
    spelling = F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.upper(F.replace("p_name", F.lit(" "), F.lit("-"))))
    return table(spark, sf, "part").groupBy(text.variant_key(spelling).alias("key")).agg(F.count("*").alias("n"))


@query("F23_foreign_spans", "SELECT p_partkey, CASE WHEN p_name = lower(p_type) THEN p_name ELSE p_name || ',' || lower(p_type) END AS spans FROM part")
def foreign_spans(spark, sf):
    mixed = F.concat(F.lit("中"), "p_name", F.lit("的the "), F.lower("p_type"), F.lit(" uh，x。one two three four"))
    return table(spark, sf, "part").select("p_partkey", F.array_join(text.foreign_spans(mixed, fillers=("the", "uh")), ",").alias("spans"))


@query("F31_fields_anywhere", """SELECT p_partkey, p_name || '|' || p_brand || ' "q"' AS texts FROM part""")
def fields_anywhere(spark, sf):
    document = F.to_json(F.struct(F.col("p_name").alias("text"), F.struct(F.array(F.struct(F.concat("p_brand", F.lit(' "q"')).alias("text"), F.lit("no").alias("texts"))).alias("x")).alias("y")))
    return table(spark, sf, "part").select("p_partkey", F.array_join(text.fields_at(document, "text"), "|").alias("texts"))


@query("F34_rendered", "SELECT doc_id, CASE CAST('0x' || substr(sha256('5:' || doc_id), 1, 8) AS BIGINT) % 2 WHEN 0 THEN 'Read ' || lang || ' of ' || source ELSE source || ': ' || lang END AS prompt FROM documents")
def rendered(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.rendered(["Read {lang} of {source}", "{source}: {lang}"], 5, F.col("doc_id"), {"lang": F.col("lang"), "source": F.col("source")}).alias("prompt"))


@query("F35_message_refs", "SELECT conv_id, coalesce(string_agg(turn, ',' ORDER BY turn) FILTER (WHERE role = 'user'), '') AS refs FROM conversations GROUP BY 1")
def message_refs(spark, sf):
    part = F.struct(F.col("role").alias("kind"), F.col("turn").cast("string").alias("ref"))
    messages = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.array(part).alias("parts")))).alias("m"))
    return messages.select("conv_id", F.array_join(text.message_refs(F.col("m"), "user"), ",").alias("refs"))


@query("F36_portable_path", "WITH p AS (SELECT page_id, '/data/' || CASE WHEN page_id % 3 = 0 THEN 'a/b/' WHEN page_id % 3 = 1 THEN 'ab/' ELSE 'a/' END || page_id AS path FROM pages) SELECT page_id, CASE WHEN path LIKE '/data/a/b/%' THEN 'deep' WHEN path LIKE '/data/a/%' THEN 'a' END AS alias, CASE WHEN path LIKE '/data/a/%' THEN CAST(page_id AS VARCHAR) END AS relative FROM p")
def portable_path(spark, sf):
    case = F.col("page_id") % 3
    path = F.concat(F.lit("/data/"), F.when(case == 0, "a/b/").when(case == 1, "ab/").otherwise("a/"), F.col("page_id").cast("string"))
    return table(spark, sf, "pages").select("page_id", text.portable_path(path, {"a": "/data/a", "deep": "/data/a/b"}).alias("p")).select("page_id", "p.alias", "p.relative")


@query("F41_vector_products", "SELECT a.vec_id, round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS dot, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def vector_products(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    both = rows.join(rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next")), "vec_id")
    return both.select("vec_id", F.round(text.dot(F.col("embedding"), F.col("next")), 4).alias("dot"), F.round(text.cosine(F.col("embedding"), F.col("next")), 4).alias("cosine"))


@query("F47_raw_matches", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) IN (SELECT p_size FROM part WHERE p_partkey < 20)")
def raw_matches(spark, sf):
    # The id is taken from the raw text; only rows that are wanted are parsed.
    wanted = table(spark, sf, "part").filter("p_partkey < 20").select(F.col("p_size").cast("string").alias("raw")).distinct()
    rows = table(spark, sf, "events").withColumn("raw", F.regexp_extract("props", r'"k"\s*:\s*(-?[0-9]+)', 1)).join(wanted, "raw", "left_semi")
    return rows.select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("F02_script_compact", r"WITH p AS (SELECT p_partkey, p_size % 2 = 0 AS zh, trim(regexp_replace(regexp_replace(lower(p_name || ' (' || p_brand || ')!'), '[\p{P}\p{S}]', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM part) SELECT p_partkey, CASE WHEN zh THEN replace(t, ' ', '') ELSE t END AS form FROM p")
def script_compact(spark, sf):
    language = F.when(F.col("p_size") % 2 == 0, "zh").otherwise("en")
    return table(spark, sf, "part").select("p_partkey", text.script_compact(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")!")), language).alias("form"))


@query(
    "Q02_word_lists",
    """WITH r AS (SELECT p_partkey AS id, p_name AS t, string_split(p_name, ' ') AS gold FROM part), w AS (SELECT DISTINCT lower(p_type) AS word FROM part UNION SELECT DISTINCT split_part(p_name, ' ', 1) FROM part), v AS (SELECT word, row_number() OVER (ORDER BY sha256(word)) - 1 AS no FROM w),
n AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS word, split_part(p_name, ' ', 2) AS near FROM part WHERE p_size > 45), c AS (SELECT min(x) AS p FROM (SELECT unnest(range(greatest(count(*), 2), 2 * count(*) + 3)) AS x FROM v) WHERE len(list_filter(range(2, x), lambda d: x % d = 0)) = 0),
g AS (SELECT id, t, unnest(gold) AS word FROM r), b AS (SELECT id, t, p, CAST('0x' || substr(sha256('9:' || id), 1, 8) AS BIGINT) % p AS start, CAST('0x' || substr(sha256('9:' || id), 9, 8) AS BIGINT) % (p - 1) + 1 AS step, unnest(range(p)) AS k FROM r, c),
e AS (SELECT id, t, word, 0 AS kind, 0 AS k FROM g UNION ALL SELECT id, t, near, 1, 0 FROM g JOIN n USING (word) UNION ALL SELECT id, t, word, 2, k FROM b JOIN v ON no = (start + k * step) % p),
o AS (SELECT id, word, min(kind) AS kind, arg_min(k, kind) AS k FROM e WHERE kind = 0 OR NOT contains(t, word) GROUP BY 1, 2), l AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY kind, k, CASE WHEN kind < 2 THEN sha256('9:' || id || ':' || word) ELSE '' END, word) AS place FROM o)
SELECT id, string_agg(word, ',' ORDER BY place) AS words FROM l WHERE place <= 6 GROUP BY 1""",
)
def word_lists(spark, sf):
    part = table(spark, sf, "part")
    first, second = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    pool = part.select(F.lower("p_type").alias("word")).union(part.select(first)).distinct()
    near = part.filter("p_size > 45").select(first.alias("word"), second.alias("near")).distinct()
    rows = part.select(F.col("p_partkey").alias("id"), "p_name", F.split("p_name", " ").alias("gold"))
    return decisions.word_lists(rows, "gold", pool, "p_name", 6, 9, near).select("id", F.array_join("words", ",").alias("words"))


@query(
    "Q04_judged",
    """WITH a AS (SELECT user_id, event_type AS judge, arg_max(CASE WHEN value > 20 THEN 'high' ELSE 'low' END, event_id) AS a FROM events GROUP BY 1, 2), c AS (SELECT user_id, count(*) AS n_judges, count(DISTINCT a) AS n_answers, min(a) AS answer FROM a GROUP BY 1)
SELECT user_id, CASE WHEN n_judges < 2 THEN 'open' WHEN n_answers = 1 AND answer = 'low' THEN 'unchanged' WHEN n_answers = 1 THEN 'corrected' ELSE 'quarantined' END AS verdict, CASE WHEN n_judges >= 2 AND n_answers = 1 AND answer <> 'low' THEN answer END AS text, n_judges, n_answers FROM c""",
)
def judged(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_type", "event_id", F.lit("low").alias("original"), F.when(F.col("value") > 20, "high").otherwise("low").alias("answer"))
    return decisions.judged(rows, ["user_id"], "original", "event_type", "answer", "event_id")


@query("Q08_gated_pool", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY sha256('8:' || doc_id), doc_id) AS r FROM documents WHERE n_chars >= 300 AND NOT (lang = 'de' AND n_chars < 900)) WHERE r <= 15")
def gated_pool(spark, sf):
    reason = text.first_reason([("short", F.col("n_chars") < 300), ("sparse", (F.col("lang") == "de") & (F.col("n_chars") < 900))])
    rows = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars").filter(reason.isNull()).withColumn("key", order_key(8, "doc_id"))
    return picks.smallest(rows, ["source"], "key", "doc_id", 15).select("doc_id")


@query("Q10_covered_needs", "SELECT l_orderkey, count(*) AS n_items, count(*) FILTER (WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)) AS n_missing, bool_and(l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 5)) AS covered FROM lineitem GROUP BY 1")
def covered_needs(spark, sf):
    facts = table(spark, sf, "part").filter("p_size > 5").select(F.col("p_partkey").alias("l_partkey"))
    return decisions.covered_needs(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey"), facts, "l_orderkey", "l_partkey")


@query("A20_nearest_choice", "WITH c AS (SELECT k, count(*) AS n, sum(l_quantity) AS q FROM lineitem JOIN (SELECT unnest(range(1, 8)) AS k) ON l_linenumber <= k GROUP BY 1), t AS (SELECT count(*) * 0.5 AS n, sum(l_quantity) * 0.6 AS q FROM lineitem) SELECT c.k, c.n, c.q FROM c, t ORDER BY round(abs(c.n - t.n) / t.n + abs(c.q - t.q) / t.q, 9), c.k LIMIT 1")
def nearest_choice(spark, sf):
    rows = table(spark, sf, "lineitem")
    # How much the first k line numbers hold: sums of a table of seven rows.
    per_line = rows.groupBy("l_linenumber").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    choices = spark.range(1, 8).select(F.col("id").alias("k")).join(per_line, F.col("l_linenumber") <= F.col("k")).groupBy("k").agg(F.sum("n").alias("n"), F.sum("q").alias("q"))
    total = rows.agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q")).first()
    return decisions.nearest_choice(choices, {"n": total["n"] * 0.5, "q": total["q"] * 0.6}).select("k", "n", "q")


@query("O07_first_examples", "SELECT lang, string_agg(doc_id, ',' ORDER BY doc_id) AS examples FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents WHERE n_chars > 700) WHERE r <= 10 GROUP BY 1")
def first_examples(spark, sf):
    rows = table(spark, sf, "documents").filter("n_chars > 700").select("lang", "doc_id", F.lit(0).alias("tie"))
    ten = picks.smallest(rows, ["lang"], "doc_id", "tie", 10)
    return ten.groupBy("lang").agg(F.array_join(F.array_sort(F.collect_list("doc_id")).cast("array<string>"), ",").alias("examples"))


def _heard(spark, sf):
    """The words of a name, and the same with some words before it and one behind."""
    words = F.split("p_name", " ")
    before = F.array_repeat(F.lit("zz"), (F.col("p_size") % 4).cast("int"))
    return table(spark, sf, "part").select("p_partkey", "p_name", words.alias("words"), F.concat(before, words, F.array(F.lit("qq"))).alias("heard"))


@query("F15_inner_errors", "SELECT p_partkey, 0 AS errors FROM part")
def inner_errors(spark, sf):
    return _heard(spark, sf).select("p_partkey", T.errors_between_edges(F.col("words"), F.col("heard")).alias("errors"))


@query("F16_inserted_run", "SELECT p_partkey, CAST(greatest(p_size % 4, 1) AS INTEGER) AS run FROM part")
def inserted_run(spark, sf):
    return _heard(spark, sf).select("p_partkey", T.longest_inserted_run(F.col("words"), F.col("heard")).alias("run"))


@query("F17_tokens_missed", "SELECT p_partkey, 1 AS missed FROM part")
def tokens_missed(spark, sf):
    return _heard(spark, sf).select("p_partkey", T.tokens_missed(F.concat("words", F.array(F.lit("yy"))), F.col("heard")).alias("missed"))


@query("F04_occurrences", "SELECT p_partkey, '0:' || p_name || ',' || length(p_name) + 2 || ':' || split_part(p_name, ' ', 1) AS found FROM part")
def occurrences(spark, sf):
    first = F.split_part("p_name", F.lit(" "), F.lit(1))
    found = T.occurrences(F.concat("p_name", F.lit(", "), first), F.array(first, F.col("p_name"), F.lit("none")))
    return table(spark, sf, "part").select("p_partkey", F.array_join(F.transform(found, lambda f: F.concat(f["at"].cast("string"), F.lit(":"), f["word"])), ",").alias("found"))


@query(
    "A18_fragile_conditions",
    """WITH c AS (SELECT lang AS family, source AS condition, count(*) AS n, avg(n_chars - 1000) AS delta, avg(n_chars - 1000) - 1.96 * stddev_samp(n_chars) / sqrt(count(*)) AS low FROM documents GROUP BY 1, 2 HAVING count(*) > 1), f AS (SELECT *, row_number() OVER (ORDER BY delta DESC, family, condition) AS place, delta = max(delta) OVER (PARTITION BY family) AS worst FROM c WHERE low > 0)
SELECT family, condition, round(delta, 4) AS delta, round(low, 4) AS low, place, worst FROM f WHERE place <= 8 OR worst""",
)
def fragile_conditions(spark, sf):
    value = F.col("n_chars")
    cells = table(spark, sf, "documents").groupBy(F.col("lang").alias("family"), F.col("source").alias("condition")).agg(F.count("*").alias("n"), F.avg(value - 1000).alias("delta"), (F.avg(value - 1000) - 1.96 * F.stddev_samp(value) / F.sqrt(F.count("*"))).alias("low"))
    # One row for each condition from here on.
    rows = cells.filter("n > 1 and low > 0").withColumn("place", F.row_number().over(Window.orderBy(F.desc("delta"), "family", "condition")).cast("long"))
    rows = rows.withColumn("worst", F.col("delta") == F.max("delta").over(Window.partitionBy("family"))).filter("place <= 8 or worst")
    return rows.select("family", "condition", F.round("delta", 4).alias("delta"), F.round("low", 4).alias("low"), "place", "worst")


@query("A34_split_twins", "WITH s AS (SELECT page_id // 2 AS i, page_id % 2 AS split, md5(url[:24]) AS d FROM pages) SELECT count(*) AS n, count(*) FILTER (WHERE a.d = b.d) AS n_same, round(avg(CASE WHEN a.d = b.d THEN 1.0 ELSE 0.0 END), 6) AS share, count(*) FILTER (WHERE a.d <> b.d) <= 0.99 * count(*) AS bounded FROM s a JOIN s b ON a.i = b.i AND a.split = 0 AND b.split = 1")
def split_twins(spark, sf):
    rows = table(spark, sf, "pages").select(F.floor(F.col("page_id") / 2).alias("i"), (F.col("page_id") % 2).alias("split"), F.md5(F.substring("url", 1, 24)).alias("d"))
    both = rows.filter("split = 0").join(rows.filter("split = 1").select("i", F.col("d").alias("e")), "i")
    same = F.col("d") == F.col("e")
    return both.agg(F.count("*").alias("n"), F.count_if(same).alias("n_same"), F.round(F.avg(same.cast("double")), 6).alias("share"), (F.count_if(~same) <= 0.99 * F.count("*")).alias("bounded"))


@query(
    "A21_audit_reasons",
    """WITH r AS (SELECT CASE WHEN quality = 0 AND toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'poor' ELSE 'none' END AS reason, CASE WHEN n_chars % 5 = 0 THEN 'rewrite' ELSE 'keep_original' END AS action, n_chars / 15.0 AS seconds, n_chars % 5 = 0 AS changed FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
SELECT reason, action, reason = 'none' AS passed, count(*) AS n, round(sum(seconds), 4) AS seconds, count(*) FILTER (WHERE changed) AS n_changed FROM r GROUP BY 1, 2""",
)
def audit_reasons(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    changed = F.col("n_chars") % 5 == 0
    reason = F.coalesce(text.first_reason([("toxic", (F.col("quality") == 0) & (F.col("toxic") == 1)), ("poor", F.col("quality") == 0)]), F.lit("none"))
    cells = rows.groupBy(reason.alias("reason"), F.when(changed, "rewrite").otherwise("keep_original").alias("action"))
    return cells.agg(F.count("*").alias("n"), F.round(F.sum(F.col("n_chars") / 15.0), 4).alias("seconds"), F.count_if(changed).alias("n_changed")).withColumn("passed", F.col("reason") == "none")


@query(
    "W25_pool_draw",
    """WITH p AS (SELECT doc_id, md5(text) AS t, unnest(list_filter([CASE WHEN n_chars < 800 THEN 'short' END, CASE WHEN source <> 'src0' THEN 'other' END], lambda x: x IS NOT NULL)) AS pool, CASE source WHEN 'src0' THEN 0 ELSE 1 END AS split, sha256('12:' || doc_id) AS key FROM documents),
c AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY split, key, pool) AS copy FROM p), q AS (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY split, key, pool) AS place FROM c WHERE copy <= 2) SELECT doc_id, pool, row_number() OVER (ORDER BY place, pool) AS turn FROM q WHERE place <= 20""",
)
def pool_draw(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "source", F.md5("text").alias("t"))
    rows = decisions.pools(docs, {"short": F.col("n_chars") < 800, "other": F.col("source") != "src0"})
    split = F.when(F.col("source") == "src0", 0).otherwise(1)
    order = [split.alias("split"), order_key(12, "doc_id").alias("key"), F.col("pool").alias("p")]
    taken = decisions.drawn(rows, "pool", order, "t", 2, 20)
    # Twenty rows of each pool from here on: pools take turns.
    return taken.select("doc_id", "pool", F.row_number().over(Window.orderBy("place", "pool")).cast("long").alias("turn"))


@query("F22_mixed_blanks", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 4 ELSE 1 END AS n FROM part")
def mixed_blanks(spark, sf):
    marked = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("中 "), "p_name", F.lit(" 国b 中a  国 b"))).otherwise(F.concat("p_name", F.lit(" 国，中  a")))
    return table(spark, sf, "part").select("p_partkey", text.mixed_script_blanks(marked).alias("n"))


@query("F30_dotted_values", """SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN p_name WHEN 1 THEN p_size::VARCHAR WHEN 2 THEN '{"z":[1,"' || p_brand || '"]}' WHEN 3 THEN 'true' END AS value FROM part""")
def dotted_values(spark, sf):
    case = F.col("p_size") % 5
    inner = F.when(case == 0, F.concat(F.lit('"'), "p_name", F.lit('"'))).when(case == 1, F.col("p_size").cast("string")).when(case == 2, F.concat(F.lit('{"z": [1, "'), "p_brand", F.lit('"]}'))).when(case == 3, "true").otherwise("null")
    return table(spark, sf, "part").select("p_partkey", text.value_at(F.concat(F.lit('{"a": {"b": '), inner, F.lit("}}")), "a.b").alias("value"))


@query("F26_framing", "SELECT p_partkey, p_name AS plain FROM part")
def framing(spark, sf):
    case = F.col("p_size") % 3
    reply = F.when(case == 0, F.concat(F.lit("Sure, here is the text: “"), "p_name", F.lit("”"))).when(case == 1, F.concat(F.lit("  Transcription:\n"), "p_name")).otherwise(F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", text.without_framing(reply, ("sure", "here is", "transcription")).alias("plain"))


@query("K04_exported_lines", """SELECT doc_id, '{"id":"' || doc_id || '","language":"' || lang || '","slots":[{"cut_id":"' || source || '-' || doc_id || '","duration":' || n_chars || '}]}' AS line FROM documents WHERE source = 'src1'""")
def exported_lines(spark, sf):
    slot = F.struct(F.concat("source", F.lit("-"), F.col("doc_id").cast("string")).alias("cut_id"), F.col("n_chars").alias("duration"))
    record = F.struct(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("language"), F.array(slot).alias("slots"))
    return table(spark, sf, "documents").filter("source = 'src1'").select("doc_id", F.to_json(record).alias("line"))


@query("F24_rule_phrases", "SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'said' WHEN 1 THEN 'parts,said' WHEN 2 THEN 'parts' ELSE '' END AS rules FROM part")
def rule_phrases(spark, sf):
    case = F.col("p_size") % 6
    said = F.when(case == 0, "灰色的灰。").when(case == 1, "弓长张，是张大的张然后").when(case == 2, "弓长张的好").when(case == 3, "灰色的灰尘多").when(case == 4, "我们的我").otherwise("灰一二三四的灰")
    rules = T.rule_phrases(F.concat("p_name", said), {"parts": ["弓长张", "木子李"]}, "said", "我你的是", "，。", ["然后"])
    return table(spark, sf, "part").select("p_partkey", F.array_join(rules, ",").alias("rules"))
