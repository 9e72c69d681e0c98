"""Layers, record indexes and source keys over the corpus tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import layers, record_index
from tidemill.plans.registry import query, table

_FIELD = "CASE CAST(l_quantity AS INTEGER) % 6 WHEN 0 THEN 'target' WHEN 1 THEN 'metadata' WHEN 2 THEN 'metadata.' || l_returnflag WHEN 3 THEN 'metadata.' || l_returnflag || '.x' WHEN 4 THEN 'target.' || l_linestatus ELSE 'audio' END"


@query(
    "L01_step_problems",
    f"""WITH w AS (SELECT DISTINCT l_orderkey AS chain, l_linenumber AS step, {_FIELD} AS field, l_linestatus = 'O' AS o FROM lineitem)
SELECT chain, step, field, 'not a field' AS problem FROM w WHERE field = 'audio' OR field LIKE 'target.%'
UNION SELECT chain, step, field, 'written before' FROM w WHERE NOT (o AND (field = 'metadata' OR field LIKE 'metadata.%'))
 AND EXISTS (SELECT 1 FROM w e WHERE e.chain = w.chain AND e.step < w.step AND (e.field = w.field OR starts_with(e.field, w.field || '.') OR starts_with(w.field, e.field || '.')))""",
)
def step_problems(spark, sf):
    rows = table(spark, sf, "lineitem")
    none = F.array().cast("array<string>")
    return layers.step_problems(rows.select(F.col("l_orderkey").alias("chain"), F.col("l_linenumber").alias("step"), F.expr(_FIELD).alias("field"), F.when(F.col("l_linestatus") == "O", F.array(F.lit("metadata"))).otherwise(none).alias("overrides")))


def _layer(spark, sf):
    """Patches of the documents, of which most break a rule."""
    case = F.pmod("doc_id", F.lit(8))
    changes = F.create_map(F.lit("metadata.a"), F.lit("1"))
    for n, pairs in {
        1: ("metadata.a", "1", "metadata.a-b", "2", "metadata.a.b", "3"),
        2: ("metadata.a", "1", "metadata.a-b", "2"),
        3: ("other", "1"),
        4: ("language", '"xx"'),
        5: ("language.x", "1"),
        6: ("$membership", "1"),
        7: ("metadata..a", "1"),
    }.items():
        changes = F.when(case == n, F.create_map(*map(F.lit, pairs))).otherwise(changes)
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), changes.alias("changes"), F.when(F.col("doc_id") % 11 == 0, "delete").otherwise("keep").alias("status"))


def _parent(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.to_json(F.struct(F.col("lang").alias("language"))).alias("record_json"), (F.col("doc_id") % 13 != 0).alias("retained"))


@query(
    "L02_patch_rules",
    """SELECT doc_id AS id, doc_id % 13 <> 0 AS retained,
 CASE doc_id % 8 WHEN 0 THEN '{"language":"' || lang || '","metadata":{"a":1}}' WHEN 2 THEN '{"language":"' || lang || '","metadata":{"a":1,"a-b":2}}' ELSE '{"language":"' || lang || '"}' END AS record_json,
 CASE WHEN doc_id % 13 = 0 THEN 'patch of a deleted record' WHEN doc_id % 11 = 0 THEN 'delete isn''t declared' WHEN doc_id % 8 = 1 THEN 'paths of one patch meet' WHEN doc_id % 8 = 3 THEN 'other isn''t declared'
  WHEN doc_id % 8 = 4 THEN 'language: would override a value' WHEN doc_id % 8 = 5 THEN 'language.x: language is no object' WHEN doc_id % 8 = 6 THEN '$membership isn''t declared' WHEN doc_id % 8 = 7 THEN 'metadata..a: an empty name' END AS error FROM documents""",
)
def patch_rules(spark, sf):
    return layers.replay(_parent(spark, sf), _layer(spark, sf), layers.Step("rules", ("metadata", "language"))).select("id", "retained", "record_json", "error")


_PATCH = """SELECT doc_id AS id, status, sha256('{"changes":{"labels.q":' || q || ',"metadata.toxic":' || toxic || '},"id":"' || doc_id || '","parent_version":7,"status":"' || status || '"}') AS patch_hash
FROM (SELECT doc_id, toxic, quality AS q, CASE WHEN quality = 0 THEN 'delete' ELSE 'keep' END AS status FROM labels)"""


def _patches(spark, sf):
    changes = F.create_map(F.lit("metadata.toxic"), F.col("toxic").cast("string"), F.lit("labels.q"), F.col("quality").cast("string"))
    return table(spark, sf, "labels").select(F.col("doc_id").alias("id"), changes.alias("changes"), F.when(F.col("quality") == 0, "delete").otherwise("keep").alias("status"))


@query("L03_layer_rows", _PATCH)
def layer_rows(spark, sf):
    return layers.layer_rows(_patches(spark, sf), 7).select("id", "status", "patch_hash")


@query("L03_layer_counts", f"WITH r AS ({_PATCH}) SELECT count(*) AS input_count, count(*) FILTER (WHERE status = 'keep') AS output_count, (SELECT count(*) FROM documents WHERE lang <> 'de') AS parent_record_count, (SELECT count(*) FROM documents WHERE lang <> 'de') - count(*) FILTER (WHERE status <> 'keep') AS result_record_count, CAST(sum(CAST('0x' || substr(sha256(patch_hash), 1, 8) AS BIGINT)) AS DOUBLE) AS w0 FROM r")
def layer_counts(spark, sf):
    parent = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), (F.col("lang") != "de").alias("retained"))
    found = layers.layer_counts(layers.layer_rows(_patches(spark, sf), 7), parent)
    return found.select("input_count", "output_count", "parent_record_count", "result_record_count", F.col("w0").cast("double").alias("w0"))


@query(
    "K03_record_index",
    """WITH l AS (SELECT l_orderkey AS id, l_partkey AS cut, l_returnflag AS f, l_quantity AS start, l_discount AS duration, p_size * 1000 AS rate FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 49) ON l_partkey = p_partkey),
c AS (SELECT id, count(*) AS k, count(*) FILTER (WHERE f = 'A') AS a, count(*) FILTER (WHERE f = 'R') AS r, count(*) FILTER (WHERE rate IS NULL) AS lost FROM l GROUP BY 1),
m AS (SELECT l.* FROM l JOIN c USING (id) WHERE k = 1 OR (a = 1 AND f = 'A') OR (a <> 1 AND r = 1 AND f = 'R'))
SELECT c.id, k AS n_slots, coalesce(cut, -1) AS cut_id, coalesce(CAST(round_even(start * rate, 0) AS BIGINT), -1) AS start_frame, coalesce(CAST(round_even(duration * rate, 0) AS BIGINT), -1) AS num_frames, CASE WHEN lost > 0 THEN 'cut isn''t indexed' WHEN m.id IS NULL THEN 'no main slot' END AS problem FROM c LEFT JOIN m ON c.id = m.id""",
)
def build_index(spark, sf):
    purpose = F.when(F.col("l_returnflag") == "A", "primary").when(F.col("l_returnflag") == "R", "mixture").otherwise("other")
    slot = F.struct(F.lit("s").alias("name"), purpose.alias("purpose"), F.col("l_partkey").alias("cut_id"), F.col("l_quantity").alias("start"), F.col("l_discount").alias("duration"))
    records = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(slot).alias("slots"))
    cuts = table(spark, sf, "part").filter("p_size < 49").select(F.col("p_partkey").alias("cut_id"), (F.col("p_size") * 1000).alias("rate"), F.lit(0).cast("long").alias("frames"))
    known = [F.coalesce(c, F.lit(-1)).alias(c) for c in ("cut_id", "start_frame", "num_frames")]
    return record_index.record_index(records, cuts).select("id", F.size("slots").cast("long").alias("n_slots"), *known, "problem")


def _index(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.array("source", F.lit("all")).alias("splits"), "lang", "n_chars")


@query("S05_index_table", "SELECT doc_id AS id, n_chars FROM documents WHERE source = 'src1' AND lang = 'en' AND n_chars > 500")
def index_table(spark, sf):
    return record_index.index_table(_index(spark, sf), "src1", "lang = 'en' and n_chars > 500", ("id", "n_chars"))


@query("G06_index_counts", "SELECT source AS split, count(*) AS n FROM documents GROUP BY 1 UNION ALL SELECT 'all', count(*) FROM documents")
def index_counts(spark, sf):
    return record_index.split_counts(_index(spark, sf))


@query(
    "G06_index_differences",
    """WITH b AS (SELECT coalesce(a.doc_id, b.doc_id) AS id, a.doc_id IS NULL AS missing, b.doc_id IS NULL AS stray, a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL AS shared, a.lang IS DISTINCT FROM b.lang AS l, a.n_chars IS DISTINCT FROM b.n_chars AS c
 FROM (SELECT * FROM documents WHERE doc_id % 9 <> 0) a FULL JOIN (SELECT doc_id, CASE WHEN n_chars > 900 THEN upper(lang) ELSE lang END AS lang, n_chars + CASE WHEN source = 'src2' THEN 1 ELSE 0 END AS n_chars FROM documents WHERE doc_id % 10 <> 0) b ON a.doc_id = b.doc_id ORDER BY sha256('1:' || coalesce(a.doc_id, b.doc_id)) LIMIT 150)
SELECT unnest(['missing', 'stray', 'lang', 'n_chars']) AS name, unnest([count(*) FILTER (WHERE missing), count(*) FILTER (WHERE stray), count(*) FILTER (WHERE shared AND l), count(*) FILTER (WHERE shared AND c)]) AS n FROM b""",
)
def index_differences(spark, sf):
    docs = table(spark, sf, "documents").withColumnRenamed("doc_id", "id")
    changed = docs.filter("id % 10 <> 0").withColumn("lang", F.when(F.col("n_chars") > 900, F.upper("lang")).otherwise(F.col("lang"))).withColumn("n_chars", F.col("n_chars") + F.when(F.col("source") == "src2", 1).otherwise(0))
    return record_index.index_differences(docs.filter("id % 9 <> 0"), changed, ["lang", "n_chars"], sample=150)


@query(
    "P08_channel",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 6 IN (1, 2) THEN l_linenumber END AS channel, l_linenumber % 6 IN (3, 4, 5) AS wrong FROM lineitem",
)
def channels(spark, sf):
    n = F.col("l_linenumber").cast("string")
    case = F.col("l_linenumber") % 6
    document = F.when(case == 1, n).when(case == 2, F.concat(F.lit("["), n, F.lit("]"))).when(case == 3, F.concat(F.lit("["), n, F.lit(", 0]"))).when(case == 4, F.concat(F.lit('"'), n, F.lit('"'))).when(case == 5, F.lit("[]"))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", record_index.channel(document).alias("c"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.col("c.value").alias("channel"), F.col("c.wrong").alias("wrong"))


@query(
    "P10_typed_facts",
    """SELECT event_id, CASE WHEN event_id % 6 = 0 THEN value WHEN event_id % 6 = 1 THEN 7.0 END AS snr, event_id % 6 IN (2, 3) AS snr_wrong, CASE WHEN event_id % 6 = 2 THEN true END AS present, event_id % 6 IN (0, 1, 3) AS present_wrong,
 CASE WHEN event_id % 2 = 0 THEN event_type END AS kind FROM events""",
)
def typed_facts(spark, sf):
    case = F.col("event_id") % 6
    value = F.when(case == 0, F.col("value").cast("string")).when(case == 1, "7").when(case == 2, "true").when(case == 3, '"7"').otherwise("null")
    kind = F.when(F.col("event_id") % 2 == 0, F.col("event_type")).otherwise("")
    document = F.concat(F.lit('{"m": {"snr": '), value, F.lit('}, "kind": "'), kind, F.when(case == 5, F.lit('", "x": 1}')).otherwise('"}'))
    rows = table(spark, sf, "events").select("event_id", record_index.typed(document, "$.m.snr", "double").alias("s"), record_index.typed(document, "$.m.snr", "boolean").alias("p"), record_index.typed(document, "$.kind", "string", empty_to_null=True).alias("k"))
    return rows.select("event_id", F.col("s.value").alias("snr"), F.col("s.wrong").alias("snr_wrong"), F.col("p.value").alias("present"), F.col("p.wrong").alias("present_wrong"), F.col("k.value").alias("kind"))


@query("P05_record_facts", "SELECT l_orderkey AS id, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS splits, count(*) AS n_slots, bool_or(l_linestatus = 'O') AS open FROM lineitem GROUP BY 1")
def record_facts(spark, sf):
    slot = F.struct(F.struct(F.col("l_returnflag").alias("split")).alias("ref"), F.col("l_linestatus").alias("status"))
    records = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(slot).alias("audio_slots"))
    splits = F.array_sort(F.array_distinct(F.transform("audio_slots", lambda s: s["ref"]["split"])))
    return records.select("id", F.array_join(splits, ",").alias("splits"), F.size("audio_slots").cast("long").alias("n_slots"), F.exists("audio_slots", lambda s: s["status"] == "O").alias("open"))


@query(
    "G08_source_keys",
    """WITH k AS (SELECT page_id, list_concat(['page:' || page_id], list_transform(regexp_extract_all(url, '[0-9]+'), lambda x: 'num:' || x)) AS keys, len(regexp_extract_all(url, '[0-9]+')) = 0 AS none FROM pages)
SELECT page_id, array_to_string(list_sort(list_distinct(keys)), ',') AS keys, CASE WHEN none THEN 'num' ELSE '' END AS missing FROM k""",
)
def source_keys(spark, sf):
    document = F.to_json(F.struct(F.col("page_id").cast("string").alias("id"), F.struct("url").alias("metadata")))
    keys, missing = record_index.source_keys(document, [("page", ["id"], None), ("num", ["metadata.url"], "[0-9]+")])
    return table(spark, sf, "pages").select("page_id", F.array_join(keys, ",").alias("keys"), F.array_join(missing, ",").alias("missing"))


@query("G09_holdout_keys", "WITH t AS (SELECT unnest(string_split_regex(trim(o_orderpriority || ' ' || o_orderkey || chr(9) || o_custkey), '\\s+')) AS token FROM orders) SELECT DISTINCT regexp_extract(token, '[0-9]{3}') AS key FROM t WHERE regexp_extract(token, '[0-9]{3}') <> ''")
def holdout_keys(spark, sf):
    lines = table(spark, sf, "orders").select(F.concat("o_orderpriority", F.lit(" "), F.col("o_orderkey").cast("string"), F.lit("\t"), F.col("o_custkey").cast("string")).alias("value"))
    return record_index.holdout_keys(lines, "[0-9]{3}")[0]
