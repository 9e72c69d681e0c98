"""Lookups, retrieval, caps, containment and alignment over the corpus tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemill.functions import transcripts as T
from tidemill.functions import transfer
from tidemill.functions.order import order_key
from tidemill.operators import intervals, picks, retrieval
from tidemill.plans.registry import query, table
from tidemill.session import shared_folder
from tidemill.sources import clustered


def _clustered(spark, sf, files: int):
    root = f"{shared_folder(spark)}/clustered-{uuid.uuid4().hex}"
    rows = table(spark, sf, "documents").select("doc_id", "lang", "n_chars", "text")
    return root, clustered.write_clustered(rows, root, "doc_id", files=files)


@query(
    "S09_point_lookup",
    """SELECT k.doc_id, d.lang, d.n_chars FROM (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1 UNION SELECT DISTINCT -1 - item_id FROM benchmark) k LEFT JOIN documents d ON d.doc_id = k.doc_id""",
)
def point_lookup(spark, sf):
    root, _ = _clustered(spark, sf, 32)
    keys = table(spark, sf, "labels").filter("toxic = 1").select("doc_id").unionByName(table(spark, sf, "benchmark").select((-1 - F.col("item_id")).alias("doc_id")))
    found, missing, _ = clustered.lookup(spark, root, keys, "doc_id", ["lang", "n_chars"])
    return found.unionByName(missing, allowMissingColumns=True)


@query("O01_total_order", "SELECT 32 AS files, 0 AS overlaps, count(*) AS n, min(doc_id) AS least, max(doc_id) AS most FROM documents")
def total_order(spark, sf):
    root, _ = _clustered(spark, sf, 32)
    ranges = clustered.file_ranges(spark.read.parquet(f"{root}/rows"), "doc_id")
    overlaps = clustered.range_problems(ranges).agg(F.count("*").alias("overlaps")).first()["overlaps"]
    return ranges.agg(F.count("*").alias("files"), F.lit(overlaps).alias("overlaps"), F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))


_BIGRAMS = "CASE WHEN length({0}) < 2 THEN list_filter([{0}], lambda x: x <> '') ELSE list_distinct(list_transform(range(1, length({0})), lambda i: substr({0}, i, 2))) END"
_AMONG = "len(list_filter(wu, lambda u: list_contains(qu, u)))"
_ALIGNED = f"CASE WHEN len(wu) = 0 OR len(qu) = 0 THEN 0 WHEN len(wu) > len(qu) THEN {_AMONG} / len(wu) ELSE list_max(list_transform(range(0, len(qu) - len(wu) + 1), lambda s: len(list_filter(range(1, len(wu) + 1), lambda i: wu[i] = qu[s + i])))) / len(wu) END"
_SCORE = f"""CASE WHEN w <> '' AND contains(q, w) THEN 2.0 ELSE 0.0 END + 0.5 * len(list_filter(string_split(w, ''), lambda c: contains(q, c))) / greatest(length(w), 1)
 + 0.3 * len(list_intersect({_BIGRAMS.format('w')}, {_BIGRAMS.format('q')})) / greatest(len(list_distinct(list_concat({_BIGRAMS.format('w')}, {_BIGRAMS.format('q')}))), 1) + 1.5 * ({_ALIGNED})"""
#: Units of a form: runs of consonants and the vowels behind them.
_UNITS = "[^aeiou]*[aeiou]+"


def _units(form):
    return F.regexp_extract_all(form, F.lit(_UNITS), F.lit(0))


@query("F10_aligned_share", f"SELECT p_partkey, round(CAST({_ALIGNED} AS DOUBLE), 6) AS share FROM (SELECT p_partkey, regexp_extract_all(CASE WHEN p_size % 4 = 0 THEN p_name || p_name ELSE split_part(p_name, ' ', 2) END, '{_UNITS}') AS wu, regexp_extract_all('a' || p_name || lower(p_type), '{_UNITS}') AS qu FROM part)")
def aligned_share(spark, sf):
    word = F.when(F.col("p_size") % 4 == 0, F.concat("p_name", "p_name")).otherwise(F.split_part("p_name", F.lit(" "), F.lit(2)))
    heard = F.concat(F.lit("a"), "p_name", F.lower("p_type"))
    return table(spark, sf, "part").select("p_partkey", F.round(retrieval.aligned_share(_units(word), _units(heard)), 6).alias("share"))


_TERMS = "SELECT DISTINCT p_size % 3 AS pool, replace(p_name, ' ', '') AS w FROM part UNION SELECT DISTINCT p_size % 3, lower(p_type) FROM part UNION SELECT DISTINCT p_size % 3, lower(p_brand) FROM part"


def _ranked(spark, sf, **options):
    part = table(spark, sf, "part").withColumn("pool", F.col("p_size") % 3)
    forms = [F.replace("p_name", F.lit(" "), F.lit("")), F.lower("p_type"), F.lower("p_brand")]
    terms = part.select("pool", F.explode(F.array(*forms)).alias("term")).distinct().withColumn("form", F.col("term")).withColumn("units", _units(F.col("form")))
    form = F.concat(F.split_part("p_name", F.lit(" "), F.lit(1)), F.lower("p_type"))
    asked = part.select(F.col("p_partkey").alias("query_id"), "pool", form.alias("form")).withColumn("units", _units(F.col("form")))
    return retrieval.ranked_terms(asked, terms, 50, **options), asked, terms


@query(
    "O04_retrieved_terms",
    f"""WITH t AS ({_TERMS}), s AS (SELECT query_id, w AS term, round(CAST({_SCORE} AS DOUBLE), 6) AS score FROM (SELECT query_id, w, q, regexp_extract_all(w, '{_UNITS}') AS wu, regexp_extract_all(q, '{_UNITS}') AS qu
 FROM (SELECT p_partkey AS query_id, p_size % 3 AS pool, p_name, split_part(p_name, ' ', 1) || lower(p_type) AS q FROM part) JOIN t USING (pool) WHERE NOT contains(q, w) AND w <> replace(p_name, ' ', '')))
SELECT * FROM (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, sha256(term), term) AS INTEGER) AS rank, term, score FROM s) WHERE rank <= 50""",
)
def retrieved_terms(spark, sf):
    own = table(spark, sf, "part").select(F.col("p_partkey").alias("query_id"), F.replace("p_name", F.lit(" "), F.lit("")).alias("term"))
    return _ranked(spark, sf, excluded=own, without_held=True)[0]


@query(
    "W14_capped_in_order",
    """WITH RECURSIVE r AS (SELECT user_id, row_number() OVER (ORDER BY sha256('4:' || user_id)) AS o, k FROM (SELECT user_id, list_sort(list_distinct(list(CAST(CAST(floor(value) AS INTEGER) % 12 AS VARCHAR)))) AS k FROM events WHERE event_type = 'error' GROUP BY 1)),
s AS (SELECT 0::BIGINT AS o, NULL::BIGINT AS user_id, map([]::VARCHAR[], []::INTEGER[]) AS used, '' AS status
 UNION ALL SELECT r.o, r.user_id, CASE WHEN b THEN s.used ELSE map_from_entries(list_concat(list_filter(map_entries(s.used), lambda e: NOT list_contains(r.k, e.key)), list_transform(r.k, lambda x: {'key': x, 'value': coalesce(s.used[x], 0) + 1}))) END, CASE WHEN b THEN 'capped' ELSE 'chosen' END
 FROM (SELECT s.*, len(list_filter(r.k, lambda x: coalesce(s.used[x], 0) >= 6)) > 0 AS b, r.o AS ro FROM s JOIN r ON r.o = s.o + 1) s JOIN r ON r.o = s.ro)
SELECT user_id, CASE WHEN o > coalesce((SELECT o FROM s WHERE status = 'chosen' ORDER BY o LIMIT 1 OFFSET 11), 1000000) THEN 'over' ELSE status END AS status FROM s WHERE o > 0""",
)
def capped_in_order(spark, sf):
    rows = table(spark, sf, "events").filter("event_type = 'error'").groupBy("user_id").agg(F.collect_set((F.col("value").cast("int") % 12).cast("string")).alias("k"))
    return picks.capped_in_order(rows.withColumn("o", order_key(4, "user_id")), "k", "o", 6, 12).select("user_id", "status")


@query("F04_word_occurrences", "SELECT p_partkey, upper(p_name) || ',' || split_part(p_name, ' ', 2) AS found FROM part")
def word_occurrences(spark, sf):
    second = F.split_part("p_name", F.lit(" "), F.lit(2))
    said = F.concat(F.lit("«"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("», "), second, F.lit("!"))
    return table(spark, sf, "part").select("p_partkey", F.array_join(T.word_occurrences(said, F.array(F.upper("p_name"), second, F.lit("none")), F.lit("en")), ",").alias("found"))


@query(
    "L21_transferred",
    r"""WITH t AS (SELECT doc_id, text, regexp_replace(regexp_replace(text, '[.,]', '', 'g'), '\s+', ' ', 'g') AS target, doc_id % 3 AS c, strpos(text, ', ') AS pl FROM documents WHERE text IS NOT NULL),
q AS (SELECT *, doc_id % 5 = 0 AS broken, CASE WHEN pl > 0 THEN substr(text, pl - 1, 4) ELSE 'none' END AS quote FROM t)
SELECT doc_id, CASE WHEN broken THEN CASE c WHEN 0 THEN 'quarantine' WHEN 1 THEN 'unchanged' ELSE 'not_hit' END ELSE CASE c WHEN 0 THEN 'quarantine' WHEN 1 THEN 'consistent' ELSE 'not_hit' END END AS decision,
 CASE WHEN broken OR NOT regexp_matches(quote, '[\p{L}\p{N}]') THEN quote ELSE regexp_extract(regexp_replace(regexp_replace(quote, '[.,]', '', 'g'), '\s+', ' ', 'g'), '[\p{L}\p{N}](.*[\p{L}\p{N}])?', 0) END AS quote,
 CASE WHEN broken AND c = 1 THEN 'transfer_text_differs,judged' ELSE 'judged' END AS reasons FROM q""",
)
def transferred(spark, sf):
    rows = table(spark, sf, "documents").filter("text is not null")
    other = F.regexp_replace(F.regexp_replace("text", "[.,]", ""), r"\s+", " ")
    target = F.when(F.col("doc_id") % 5 == 0, F.concat(other, F.lit(" more"))).otherwise(other)
    decision = F.element_at(F.array(F.lit("quarantine"), F.lit("consistent"), F.lit("not_hit")), (F.col("doc_id") % 3 + 1).cast("int"))
    at = F.instr("text", ", ")
    quote = F.when(at > 0, F.substring("text", at - 1, F.lit(4))).otherwise("none")
    none = F.array()
    found = transfer.transferred(F.col("text"), target, decision, F.lit(None).cast("string"), none.cast("array<int>"), F.array(quote), F.array(F.lit("judged")))
    return rows.select("doc_id", found.alias("x")).select("doc_id", "x.decision", F.get("x.quotes", F.lit(0)).alias("quote"), F.array_join("x.reasons", ",").alias("reasons"))


@query("W07_target_windows")
def target_windows(spark, sf):
    """Without SQL, as a window's place depends on the one before; held against a plain scan in tests."""
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    rows = table(spark, sf, "events").select(F.floor(seconds / 86_400).alias("day"), "event_type", F.col("event_id").alias("id"), (seconds % 86_400).alias("start"))
    rows = rows.withColumn("stop", F.col("start") + 30 + F.col("id") % 600)
    windows = intervals.target_windows(rows, ["day"], "event_type", (0.0, 120.0), (900.0, 2400.0), 3600.0, 30.0, 7, order="id")
    turns = intervals.window_turns(windows, rows, ["day"], "event_type", 3600.0)
    held = turns.groupBy(F.col("window").alias("id")).agg(F.count("*").alias("n_turns"), F.count_if("clipped").alias("n_clipped"))
    return windows.join(held, "id", "left").select("id", "day", "event_type", F.round("lo", 3).alias("lo"), F.round("hi", 3).alias("hi"), "n_turns", "n_clipped")
