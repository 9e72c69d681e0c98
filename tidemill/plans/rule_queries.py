"""Text rules, selections and audits over texts of many shapes, made of the corpus tables."""

from __future__ import annotations

import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.functions import text
from tidemill.functions import transcripts as T
from tidemill.operators import registry_checks as checks
from tidemill.plans.registry import query, table
from tidemill.sources import audio_sources


@query("F01_plain", r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(lower(nfc_normalize(text)), '[\p{P}\p{S}]', ' ', 'g'), '\s+', ' ', 'g'))) AS plain FROM documents")
def plain(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(text.plain(F.col("text"))).alias("plain"))


@query("F06_letters", r"SELECT doc_id, md5(regexp_replace(text, '[\s\p{Z}\p{P}\p{S}]+', '', 'g')) AS letters FROM documents")
def letters(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(T.letters(F.col("text"))).alias("letters"))


_LOOPED = "p_name || CASE p_size % 5 WHEN 0 THEN repeat(substr(p_name, 1, 1 + p_size % 12), 6 + p_size % 4) WHEN 1 THEN repeat('ab', p_size) WHEN 2 THEN repeat(p_brand, 8) WHEN 3 THEN ' no loop' ELSE repeat(p_type, 2) END"


@query("F18_repeats", f"SELECT p_partkey, len(list_filter(range(1, 11), lambda l: len(list_filter(range(1, length(t) - 8 * l + 2), lambda i: substr(t, i, 8 * l) = repeat(substr(t, i, l), 8))) > 0)) > 0 OR length(t) > 3 * length(p_name) + 30 AS looped FROM (SELECT p_partkey, p_name, {_LOOPED} AS t FROM part)")
def repeats(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.loops(F.expr(_LOOPED), F.col("p_name")).alias("looped"))


_CAPITALS = "CASE p_size % 3 WHEN 0 THEN '去 ' WHEN 1 THEN 'go ' ELSE 'x' END || upper(substr(p_name, 1, 1)) || ' ' || upper(substr(p_type, 1, 1)) || ' ' || upper(substr(p_brand, 1, 1)) || CASE WHEN p_size % 2 = 0 THEN ' 吧' ELSE ' b C' END"


@query(
    "F19_joined_capitals",
    f"""SELECT p_partkey, CASE WHEN p_size % 3 = 0 OR p_size % 2 = 0 THEN CASE p_size % 3 WHEN 0 THEN '去 ' WHEN 1 THEN 'go ' ELSE 'x' END || CASE WHEN p_size % 3 = 2 THEN a || ' ' || b || c ELSE a || b || c END || CASE WHEN p_size % 2 = 0 THEN ' 吧' ELSE ' b C' END ELSE t END AS joined
FROM (SELECT p_partkey, p_size, upper(substr(p_name, 1, 1)) AS a, upper(substr(p_type, 1, 1)) AS b, upper(substr(p_brand, 1, 1)) AS c, {_CAPITALS} AS t FROM part)""",
)
def joined_capitals(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.joined_capitals(F.expr(_CAPITALS)).alias("joined"))


_SCRIPTS = "p_name || CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN '你好' WHEN 2 THEN 'ありがと' WHEN 3 THEN '한국' WHEN 4 THEN '一二三四五六' WHEN 5 THEN 'カ一二三四五六' ELSE '漢한' END"
_LANGUAGE = "CASE p_size % 5 WHEN 0 THEN 'zh' WHEN 1 THEN 'ja' WHEN 2 THEN 'ko' WHEN 3 THEN 'en' ELSE 'N/A' END"
_FOREIGN = "CASE lang WHEN 'zh' THEN kana OR hangul WHEN 'ja' THEN hangul OR (NOT kana AND n_han >= 6) WHEN 'ko' THEN NOT hangul AND (kana OR n_han > 0) WHEN 'N/A' THEN false ELSE kana OR hangul OR n_han > 0 END"
_CLASSES = r"regexp_matches(t, '[\x{3040}-\x{30ff}]') AS kana, regexp_matches(t, '[\x{ac00}-\x{d7a3}]') AS hangul, len(regexp_extract_all(t, '[\x{4e00}-\x{9fff}]')) AS n_han"


@query("F21_foreign_script", f"SELECT p_partkey, {_FOREIGN} AS odd FROM (SELECT *, {_CLASSES} FROM (SELECT p_partkey, {_LANGUAGE} AS lang, {_SCRIPTS} AS t FROM part))")
def foreign_script(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.foreign_script(F.expr(_LANGUAGE), F.expr(_SCRIPTS)).alias("odd"))


_SPOKEN = "CASE p_size % 6 WHEN 0 THEN '<i>' || p_name || '</i>' WHEN 1 THEN '## ' || p_name || '  and ' WHEN 2 THEN p_name || ' {F1}' WHEN 3 THEN '[ ] ...' WHEN 4 THEN p_name || '[]' || p_type ELSE p_name || ' 你' END"


@query(
    "F20_transcript_reasons",
    f"""WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'dev.clean' ELSE 'train' END AS split, p_size * 0.7 AS seconds, CASE WHEN p_partkey % 2 = 0 THEN 'en-US' ELSE 'zh-CN' END AS lang, p_size % 6 AS c, p_name, p_type FROM part),
t AS (SELECT *, CASE c WHEN 0 THEN p_name WHEN 1 THEN ltrim(p_name) || ' and' WHEN 2 THEN p_name || ' {{F1}}' WHEN 3 THEN '...' WHEN 4 THEN p_name || ' ' || p_type ELSE p_name || ' 你' END AS clean FROM p)
SELECT p_partkey, clean, split_part(lower(lang), '-', 1) AS lang, CASE WHEN split <> 'train' THEN 'eval_split' WHEN seconds > 30 THEN 'too_long' WHEN c = 2 THEN 'markup' WHEN c = 3 THEN 'no_lexical' WHEN c = 5 AND lang = 'en-US' THEN 'script_mismatch' END AS reason FROM t""",
)
def transcript_reasons(spark, sf):
    split = F.when(F.col("p_partkey") % 9 == 0, "dev.clean").otherwise("train")
    lang = F.when(F.col("p_partkey") % 2 == 0, "en-US").otherwise("zh-CN")
    clean, primary, reason = T.transcript(F.expr(_SPOKEN), lang, split, F.col("p_size") * 0.7)
    return table(spark, sf, "part").select("p_partkey", clean.alias("clean"), primary.alias("lang"), reason.alias("reason"))


_FOLDERS = "SELECT o_orderpriority AS zone, o_orderpriority || '/' || (o_custkey % 60) AS path, CAST(count(*) * 100 + max(o_custkey) AS BIGINT) AS n_bytes, CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '1998-12-31') AS INTEGER) AS age_days FROM orders WHERE o_custkey % 60 <> 59 OR o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1, 2"


@query(
    "G11_zone_findings",
    f"""WITH f AS ({_FOLDERS}), s AS (SELECT zone, CAST(sum(n_bytes) AS BIGINT) AS n_bytes FROM f GROUP BY 1)
SELECT 'over_budget' AS category, zone AS path, n_bytes, zone FROM s WHERE n_bytes > 80000 AND zone < '4' UNION ALL SELECT 'expired', zone, n_bytes, zone FROM s WHERE zone >= '4'
UNION ALL SELECT 'over_budget', path, n_bytes, zone FROM f WHERE zone < '3' AND n_bytes > 1500 UNION ALL SELECT 'stale', path, n_bytes, zone FROM f WHERE age_days > 60 AND n_bytes >= 500""",
)
def zone_findings(spark, sf):
    late = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    orders = table(spark, sf, "orders").filter((F.col("o_custkey") % 60 != 59) | late)
    below = orders.groupBy(F.col("o_orderpriority").alias("parent"), F.concat("o_orderpriority", F.lit("/"), F.col("o_custkey") % 60).alias("path")).agg((F.count("*") * 100 + F.max("o_custkey")).alias("n_bytes"), F.date_diff(F.lit("1998-12-31").cast("date"), F.max("o_orderdate").cast("date")).alias("age_days"))
    tops = below.groupBy(F.col("parent").alias("path")).agg(F.lit("").alias("parent"), F.sum("n_bytes").alias("n_bytes"), F.min("age_days").alias("age_days"))
    early = F.col("path") < "4"
    zones = tops.select("path", F.when(early, 80_000).alias("budget"), F.when(F.col("path") < "3", 1500).alias("child_budget"), F.lit(60).alias("stale_days"), F.when(early, "2001-01-01").otherwise("1998-12-01").cast("date").alias("expires"))
    return checks.zone_findings(below.unionByName(tops), zones, datetime.date(1999, 1, 1), 500)


@query("P20_prefix_dependency", "SELECT page_id, lower(split_part(split_part(url, '://', 2), '/', 1)) = 'www.example.com' AND (path = '/en' OR starts_with(path, '/en/')) AS leans FROM (SELECT page_id, url, '/' || regexp_replace(split_part(split_part(url, '://', 2), '?', 1), '^[^/]*/?', '') AS path FROM pages)")
def prefix_dependency(spark, sf):
    rest = F.split_part("url", F.lit("://"), F.lit(2))
    host = F.lower(F.split_part(rest, F.lit("/"), F.lit(1)))
    path = F.concat(F.lit("/"), F.regexp_replace(F.split_part(rest, F.lit("?"), F.lit(1)), "^[^/]*/?", ""))
    return table(spark, sf, "pages").select("page_id", checks.leans_on(host, path, "www.example.com", "/en").alias("leans"))


@query("P23_selected_artifacts", "SELECT l_orderkey, string_agg(l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS names FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O' GROUP BY 1")
def selected_artifacts(spark, sf):
    found = checks.selected(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber", "l_partkey", l_returnflag="N", l_linestatus="O", l_suppkey=None)
    return found.select("l_orderkey", F.array_join("names", ",").alias("names"))


@query("G04_dead_references", "WITH l AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) SELECT c_custkey AS ref, c_custkey * 7 % 1000 AS to FROM customer WHERE c_acctbal >= 0 AND c_custkey * 7 % 1000 NOT IN (SELECT c_custkey FROM l)".replace(" AS to ", ' AS "to" '))
def dead_references(spark, sf):
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("ref"), F.when(F.col("c_acctbal") < 0, F.lit("x")).alias("superseded_by"))
    return checks.dead_references(rows, rows.select("ref", (F.col("ref") * 7 % 1000).alias("to")))


@query(
    "S12_audio_sources",
    """WITH p AS (SELECT p_partkey AS id, p_size % 5 AS form, CAST(p_size AS BIGINT) AS size, p_name AS name, p_brand AS brand FROM part), r AS (
SELECT id, form, 0 AS i, 'file' AS kind, '/data/' || brand || '/' || id || '.wav' AS path, NULL AS member, NULL AS skip, NULL AS size, NULL AS problem FROM p WHERE form IN (0, 3)
UNION ALL SELECT id, form, 1, 'file', '/rooms/' || size || '.wav', NULL, NULL, NULL, NULL FROM p WHERE form = 3
UNION ALL SELECT id, form, 0, 'tar', '/data/' || brand || '.tar', name || '.wav', NULL, NULL, NULL FROM p WHERE form = 1
UNION ALL SELECT id, form, 0, 'dd', '/data/' || name, NULL, id, size, NULL FROM p WHERE form = 2
UNION ALL SELECT id, form, 1, NULL, NULL, NULL, NULL, NULL, 'unsupported command' FROM p WHERE form = 2
UNION ALL SELECT id, form, 0, NULL, NULL, NULL, NULL, NULL, 'cut without recording' FROM p WHERE form = 4)
SELECT id, i, kind, path, member, skip, size, problem FROM r""",
)
def audio_sources_expanded(spark, sf):
    """Items of five forms from parts: recordings, cuts of a tar's member, mixed cuts of a file's range and of an unknown command, recordings with a room, cuts without anything."""
    key, form = F.col("p_partkey").cast("string"), F.col("p_size") % 5
    source = lambda kind, *text: F.struct(F.lit(kind).alias("type"), F.concat(*text).alias("source"))
    recording = lambda *sources: F.struct(F.array(*sources).alias("sources"), F.lit(16000).alias("sampling_rate"))
    cut = lambda of: F.struct(F.lit("MonoCut").alias("type"), of.alias("recording"))
    file = source("file", F.lit("x/.././"), "p_brand", F.lit("/"), key, F.lit(".wav"))
    room = recording(source("file", F.lit("/rooms/"), F.col("p_size").cast("string"), F.lit(".wav")))
    echo = F.array(F.struct(F.lit("ReverbWithImpulseResponse").alias("name"), F.struct(room.alias("rir")).alias("kwargs")))
    tar = source("command", F.lit("tar -xOf '"), "p_brand", F.lit(".tar' \""), "p_name", F.lit('.wav"'))
    timed = F.lit("timeout --signal=TERM --kill-after=5s 60s dd 'if=")
    dd = source("command", timed, "p_name", F.lit("' iflag=skip_bytes,count_bytes skip="), key, F.lit(" count="), F.col("p_size").cast("string"), F.lit(" status=none"))
    tracks = F.array(*[F.struct(F.to_json(x).alias("cut")) for x in (F.struct(F.lit("PaddingCut").alias("type")), cut(recording(dd)), cut(recording(source("command", F.lit("cat "), key))))])
    # Cuts of a mixed cut differ in their fields, so that they are joined as texts.
    mixed = F.concat(F.lit('{"type":"MixedCut","tracks":['), F.array_join(F.transform(tracks, lambda t: F.concat(F.lit('{"cut":'), t["cut"], F.lit("}"))), ","), F.lit("]}"))
    item = F.when(form == 0, F.to_json(recording(file))).when(form == 1, F.to_json(cut(recording(tar)))).when(form == 2, mixed)
    item = item.when(form == 3, F.to_json(F.struct(F.array(file).alias("sources"), F.lit(16000).alias("sampling_rate"), echo.alias("transforms")))).otherwise(F.lit('{"type":"MonoCut"}'))
    found = audio_sources.expanded_sources(table(spark, sf, "part").select("p_partkey", item.alias("item")), "p_partkey", "item", "/data")
    place = F.row_number().over(Window.partitionBy("id").orderBy("place")) - 1
    return found.withColumn("i", place).drop("place")
