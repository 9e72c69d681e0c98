"""Transcript rules, scoring and label queries over the corpus tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.functions import transcripts as T
from tidemill.operators import measures
from tidemill.plans.registry import query, table


@query("F05_scoring_form", r"SELECT doc_id, md5(regexp_replace(lower(text), '[^\p{L}\p{N}]+', '', 'g')) AS form FROM documents")
def scoring_form(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(T.scoring_form(F.col("text"))).alias("form"))


@query("F07_letters", r"SELECT conv_id, turn, md5(regexp_replace(text, '[\s\p{Z}\p{P}\p{S}]+', '', 'g')) AS letters FROM conversations")
def only_letters(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", F.md5(T.letters(F.col("text"))).alias("letters"))


@query("F08_unmarked", r"SELECT item_id, regexp_replace(strip_accents(text), '[^\p{L}\p{N}_]+', ' ', 'g') AS plain FROM benchmark")
def unmarked(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", T.unmarked(F.col("text")).alias("plain"))


@query("F14_token_errors", None)
def token_errors(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", F.split(F.lower("text"), r"\s+").alias("tokens"))
    pairs = turns.withColumn("before", F.lag("tokens").over(Window.partitionBy("conv_id").orderBy("turn"))).filter("before is not null")
    return pairs.select("conv_id", "turn", T.token_errors(F.col("before"), F.col("tokens")).alias("errors"), F.greatest(F.size("before"), F.lit(1)).alias("n_tokens"))


@query(
    "P15_transcript_rules",
    r"""WITH r AS (SELECT doc_id, n_chars, lang || '-XX' AS language, CASE WHEN source = 'src1' THEN 'dev' ELSE 'train_a' END AS split, text FROM documents),
c AS (SELECT *, ltrim(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(text, '</?(?:i|b|u)>|<color=[^>]*>|</color>', '', 'g'), '\[\s*\]', ' ', 'g'), '\s+', ' ', 'g')), '^#+', '')) AS clean FROM r)
SELECT coalesce(CASE WHEN split = 'dev' THEN 'eval_split' WHEN n_chars / 100 > 30 THEN 'too_long' WHEN regexp_matches(clean, '[{}<>\[\]]') THEN 'markup'
 WHEN NOT regexp_matches(clean, '[\p{L}\p{N}]') THEN 'no_lexical' WHEN regexp_matches(clean, '[\x{3040}-\x{30ff}\x{ac00}-\x{d7a3}\x{4e00}-\x{9fff}]') THEN 'script_mismatch' END, 'kept') AS reason,
 split_part(language, '-', 1) AS language, count(*) AS n FROM c GROUP BY 1, 2""",
)
def transcript_rules(spark, sf):
    split = F.when(F.col("source") == "src1", "dev").otherwise("train_a")
    _, language, reason = T.transcript(F.col("text"), F.concat("lang", F.lit("-XX")), split, F.col("n_chars") / 100)
    return table(spark, sf, "documents").groupBy(F.coalesce(reason, F.lit("kept")).alias("reason"), language.alias("language")).agg(F.count("*").alias("n"))


@query("F22_tags", "SELECT page_id, CAST(len(regexp_extract_all(html, '<[^>]*>')) AS INTEGER) AS n_tags FROM pages")
def tags(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.size(F.regexp_extract_all("html", F.lit("<[^>]*>"), F.lit(0))).alias("n_tags"))


@query("F25_rendered_turns", "SELECT conv_id, md5(string_agg('[' || role || '] ' || text, chr(10) ORDER BY turn)) AS rendered FROM conversations GROUP BY 1")
def rendered(spark, sf):
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    lines = F.transform("turns", lambda t: F.concat(F.lit("["), t["role"], F.lit("] "), t["text"]))
    return turns.select("conv_id", F.md5(F.array_join(lines, "\n")).alias("rendered"))


@query(
    "F27_joined_turns",
    r"""SELECT conv_id, md5(string_agg(CASE WHEN last THEN text WHEN regexp_matches(text, '\p{P}$') THEN text ELSE text || ',' END, '' ORDER BY turn)) AS joined
FROM (SELECT *, turn = max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations) GROUP BY 1""",
)
def joined_turns(spark, sf):
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("turns"))
    return turns.select("conv_id", F.md5(T.joined(F.col("turns.text"))).alias("joined"))


@query("F28_markup", "SELECT doc_id, 'a ' || lang || ' b' AS gold, 'a ' || source || ' b' AS other FROM documents")
def markup(spark, sf):
    marked = F.concat(F.lit("a [[T:"), F.col("lang"), F.lit(" / "), F.col("source"), F.lit("]] b"))
    return table(spark, sf, "documents").select("doc_id", T.markup_side(marked).alias("gold"), T.markup_side(marked, True).alias("other"))


@query("F29_json_reply", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_reply(spark, sf):
    reply = F.concat(F.lit("Sure:\n```json\n["), F.col("props"), F.lit(",]\n```\nDone."))
    return table(spark, sf, "events").select("event_id", F.try_variant_get(T.json_reply(reply), "$[0].k", "long").alias("k"))


@query("F30_source_keys", "SELECT event_id, 'event:' || json_extract_string(props, '$.k') AS key FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def source_keys(spark, sf):
    key = F.try_variant_get(F.try_parse_json("props"), "$.k", "string")
    return table(spark, sf, "events").select("event_id", F.concat(F.lit("event:"), key).alias("key")).filter("key is not null")


@query(
    "F33_sizes",
    """WITH s AS (SELECT doc_id, 0 AS power, n_chars AS n FROM documents UNION ALL SELECT doc_id, power, (n_chars + 1) * CAST(1024 ** power AS BIGINT) FROM documents, (SELECT unnest([1, 2, 3]) AS power))
SELECT doc_id, power, CASE WHEN n >= 1024.0 ** 4 THEN printf('%.1f T', n / 1024.0 ** 4) WHEN n >= 1024.0 ** 3 THEN printf('%.1f G', n / 1024.0 ** 3) WHEN n >= 1024.0 ** 2 THEN printf('%.1f M', n / 1024.0 ** 2) WHEN n >= 1024 THEN printf('%.1f K', n / 1024.0) ELSE n || ' B' END AS size FROM s""",
)
def sizes(spark, sf):
    # Every document's size, and larger ones made of it, so that each unit occurs.
    n = F.when(F.col("power") == 0, F.col("n_chars")).otherwise((F.col("n_chars") + 1) * F.expr("shiftleft(1L, 10 * power)"))
    rows = table(spark, sf, "documents").select("doc_id", "n_chars", F.explode(F.array(*map(F.lit, range(4)))).alias("power"))
    return rows.select("doc_id", "power", T.size_text(n).alias("size"))


@query("F38_uri_parts", r"SELECT page_id, regexp_extract(url, '^([a-z]+)://([^/?#]*)(/[^?#]*)?', 1) AS scheme, regexp_extract(url, '^([a-z]+)://([^/?#]*)(/[^?#]*)?', 2) AS host, regexp_extract(url, '^([a-z]+)://([^/?#]*)(/[^?#]*)?', 3) AS key FROM pages")
def uri_parts(spark, sf):
    part = lambda i: F.regexp_extract("url", r"^([a-z]+)://([^/?#]*)(/[^?#]*)?", i)
    return table(spark, sf, "pages").select("page_id", part(1).alias("scheme"), part(2).alias("host"), part(3).alias("key"))


@query("F39_mixed_length", "SELECT l_orderkey, max(l_linenumber + l_quantity) AS seconds FROM lineitem GROUP BY 1")
def mixed_length(spark, sf):
    tracks = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("offset"), F.col("l_quantity").alias("duration"))).alias("tracks"))
    return tracks.select("l_orderkey", T.whole_seconds(F.col("tracks")).alias("seconds"))


@query("F44_times", "SELECT event_id, event_type <> 'error' AS good FROM events")
def times(spark, sf):
    written = F.concat(F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_type") == "error", "").otherwise("Z"))
    return table(spark, sf, "events").select("event_id", T.rfc3339(written).alias("good"))


@query("F46_first_spellings", "WITH w AS (SELECT source, doc_id, CASE WHEN n_chars > 2000 THEN upper(lang) ELSE lang END AS word FROM documents), f AS (SELECT source, lower(word) AS k, arg_min(word, doc_id) AS word, min(doc_id) AS pos FROM w GROUP BY 1, 2) SELECT source, string_agg(word, ',' ORDER BY pos) AS words FROM f GROUP BY 1")
def first_spellings(spark, sf):
    words = table(spark, sf, "documents").select("source", "doc_id", F.when(F.col("n_chars") > 2000, F.upper("lang")).otherwise(F.col("lang")).alias("word"))
    firsts = words.groupBy("source", F.lower("word").alias("k")).agg(F.min_by("word", "doc_id").alias("word"), F.min("doc_id").alias("at"))
    return firsts.groupBy("source").agg(F.array_join(F.array_sort(F.collect_list(F.struct("at", "word")))["word"], ",").alias("words"))


@query(
    "A14_scenarios",
    """SELECT role AS scenario, count(*) AS n, CAST(sum(length(text)) AS DOUBLE) / greatest(sum(turn), 1) AS rate, CAST(count(*) FILTER (WHERE turn > 2) AS DOUBLE) / count(*) AS late,
 CAST(count(*) FILTER (WHERE turn > 2 AND length(text) > 100) AS DOUBLE) / nullif(count(*) FILTER (WHERE turn > 2), 0) AS long_share FROM conversations GROUP BY 1""",
)
def scenarios(spark, sf):
    rows, late = table(spark, sf, "conversations"), F.col("turn") > 2
    share = F.sum((late & (F.length("text") > 100)).cast("double")) / F.nullif(F.sum(late.cast("double")), F.lit(0.0))
    return rows.groupBy(F.col("role").alias("scenario")).agg(F.count("*").alias("n"), measures.ratio(F.length("text"), F.col("turn")).alias("rate"), F.avg(late.cast("double")).alias("late"), share.alias("long_share"))


@query("A17_slices", "SELECT kind, bucket, count(*) AS n FROM (SELECT 'lang' AS kind, lang AS bucket FROM documents UNION ALL SELECT 'source', source FROM documents UNION ALL SELECT 'size', CASE WHEN n_chars <= 1000 THEN 'short' ELSE 'long' END FROM documents) GROUP BY 1, 2")
def slices(spark, sf):
    size = F.when(F.col("n_chars") <= 1000, "short").otherwise("long")
    return table(spark, sf, "documents").select(F.stack(F.lit(3), F.lit("lang"), "lang", F.lit("source"), "source", F.lit("size"), size).alias("kind", "bucket")).groupBy("kind", "bucket").agg(F.count("*").alias("n"))
