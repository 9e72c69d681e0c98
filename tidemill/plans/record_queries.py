"""Record predicates, projections, joins and set operations over the corpus tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import order, text
from tidemill.operators import joins, picks, records
from tidemill.plans.registry import query, table


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as records: id, task, language, splits, clean_pass, retained."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = docs.join(labels, "doc_id", "left")
    return rows.select(F.col("doc_id").alias("id"), F.col("source").alias("task"), F.col("lang").alias("language"), F.array(F.when(F.col("doc_id") % 10 == 0, "dev").otherwise("train")).alias("splits"), (F.col("toxic") == 0).alias("clean_pass"), F.coalesce(F.col("quality") != 0, F.lit(True)).alias("retained"), "n_chars")


_REC = """SELECT d.doc_id AS id, source AS task, lang AS language, CASE WHEN d.doc_id % 10 = 0 THEN 'dev' ELSE 'train' END AS split,
 toxic = 0 AS clean_pass, coalesce(quality <> 0, true) AS retained, n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


@query("P01_record_predicate", f"SELECT id, task, n_chars FROM ({_REC}) WHERE retained AND language = 'en' AND split = 'dev' AND clean_pass")
def predicate(spark, sf):
    return records.RecordQuery(language="en", split="dev", clean_pass=True).apply(_records(spark, sf)).select("id", "task", "n_chars")


@query("P01_no_ids", f"SELECT id FROM ({_REC}) WHERE false")
def no_ids(spark, sf):
    return records.RecordQuery(ids=()).apply(_records(spark, sf)).select("id")


@query("P02_quoted_literal", "SELECT doc_id FROM documents WHERE lang = 'e''n'' OR 1=1'")
def quoted(spark, sf):
    return spark.sql("SELECT doc_id FROM {docs} WHERE lang = :lang", args={"lang": "e'n' OR 1=1"}, docs=table(spark, sf, "documents"))


@query("P02_quoted_value", "SELECT doc_id FROM documents WHERE lang || chr(39) || '; --' = 'en' || chr(39) || '; --'")
def quoted_value(spark, sf):
    return spark.sql("SELECT doc_id FROM {docs} WHERE concat(lang, :tail) = :value", args={"tail": "'; --", "value": "en'; --"}, docs=table(spark, sf, "documents"))


@query("P03_free_predicate", "SELECT doc_id, n_chars FROM documents WHERE n_chars <= 300 AND lang <> 'en'")
def free_predicate(spark, sf):
    return table(spark, sf, "documents").filter(F.expr("n_chars <= 300 AND lang <> 'en'")).select("doc_id", "n_chars")


@query("P05_json_boolean", "SELECT event_id, json_type(props, '$.k') = 'BOOLEAN' AS is_flag FROM events WHERE props IS NOT NULL")
def json_boolean(spark, sf):
    rows = table(spark, sf, "events").filter("props is not null")
    return rows.select("event_id", F.coalesce(records.json_flag(F.col("props"), "$.k").isNotNull(), F.lit(False)).alias("is_flag"))


@query(
    "P06_primary_slot",
    """WITH n AS (SELECT l_orderkey, count(*) c, count(*) FILTER (WHERE l_returnflag = 'R') p, count(*) FILTER (WHERE l_returnflag = 'A') m,
 min(l_linenumber) only_one, min(l_linenumber) FILTER (WHERE l_returnflag = 'R') pl, min(l_linenumber) FILTER (WHERE l_returnflag = 'A') ml FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN c = 1 THEN only_one WHEN p = 1 THEN pl WHEN m = 1 THEN ml END AS line FROM n""",
)
def primary(spark, sf):
    purpose = F.when(F.col("l_returnflag") == "R", "primary").when(F.col("l_returnflag") == "A", "mixture").otherwise("other")
    slots = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("line"), F.lit("slot").alias("name"), purpose.alias("purpose"))).alias("slots"))
    return slots.select("l_orderkey", records.primary_slot(F.col("slots"))["line"].alias("line"))


@query("P07_frame_span", "SELECT event_id, CASE WHEN value IS NULL THEN 0 ELSE CAST(round_even(value * 50, 0) AS BIGINT) END AS first, CASE WHEN value IS NULL THEN 800 ELSE CAST(round_even(value * 25, 0) AS BIGINT) END AS length FROM events")
def frames(spark, sf):
    first, length = records.frame_span(F.col("value"), F.col("value") / 2, F.lit(50), F.lit(800))
    return table(spark, sf, "events").select("event_id", first.alias("first"), length.alias("length"))


@query("P09_vocabulary", "SELECT lang, CASE lang WHEN 'en' THEN 'english' WHEN 'de' THEN 'german' WHEN 'fr' THEN 'french' WHEN 'es' THEN 'spanish' END AS name, count(*) AS n FROM documents GROUP BY 1")
def vocabulary(spark, sf):
    docs = table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    return docs.select("lang", records.mapped(F.col("lang"), {"en": "english", "de": "german", "fr": "french", "es": "spanish"}).alias("name"), "n")


@query("P11_violations", "SELECT doc_id, list_filter([CASE WHEN length(trim(text)) > 0 THEN NULL ELSE 'text' END, CASE WHEN n_chars <= 5000 THEN NULL ELSE 'length' END, CASE WHEN lang IN ('en', 'de') THEN NULL ELSE 'language' END], lambda x: x IS NOT NULL)::VARCHAR AS broken FROM documents")
def violations(spark, sf):
    v = records.violations({"text": F.length(F.trim("text")) > 0, "length": F.col("n_chars") <= 5000, "language": F.col("lang").isin("en", "de")})
    return table(spark, sf, "documents").select("doc_id", F.concat(F.lit("["), F.array_join(v, ", "), F.lit("]")).alias("broken"))


@query("P12_clean_pass", f"SELECT task, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM ({_REC}) WHERE clean_pass AND retained GROUP BY 1")
def clean_pass(spark, sf):
    return records.RecordQuery(clean_pass=True).apply(_records(spark, sf)).groupBy("task").agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"))


@query(
    "P14_exclusion_cascade",
    """SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM (SELECT CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'quality'
 WHEN n_chars < 200 THEN 'short' WHEN n_chars > 20000 THEN 'long' END AS reason FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) GROUP BY 1""",
)
def exclusions(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    reason = text.first_reason([("toxic", F.col("toxic") == 1), ("quality", F.col("quality") == 0), ("short", F.col("n_chars") < 200), ("long", F.col("n_chars") > 20000)])
    return rows.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query("P19_bins", "SELECT CASE WHEN n_chars > 0 AND n_chars <= 500 THEN 0 WHEN n_chars > 500 AND n_chars <= 2000 THEN 1 WHEN n_chars > 2000 AND n_chars <= 10000 THEN 2 ELSE -1 END AS bin, count(*) AS n FROM documents GROUP BY 1")
def bins(spark, sf):
    return table(spark, sf, "documents").groupBy(records.bin_of(F.col("n_chars"), [0, 500, 2000, 10000]).alias("bin")).agg(F.count("*").alias("n"))


@query("J01_located_slots", "SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(38,2))) AS DOUBLE) AS qty FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def located(spark, sf):
    found, _ = joins.located(table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "k"), table(spark, sf, "orders").withColumnRenamed("o_orderkey", "k"), "k")
    return found.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("decimal(38,2)")).cast("double").alias("qty"))


@query("J02_missing_places", "SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0) GROUP BY 1")
def missing(spark, sf):
    _, lost = joins.located(table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "k"), table(spark, sf, "orders").filter("o_orderkey % 3 <> 0").withColumnRenamed("o_orderkey", "k"), "k")
    return lost.groupBy("k").agg(F.count("*").alias("n"))


@query("J03_merge", "SELECT d.doc_id, coalesce(CASE WHEN quality = 1 THEN 'good' END, lang) AS lang, coalesce(quality <> 0, true) AS retained FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def merge(spark, sf):
    patches = table(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 0, "delete").otherwise("keep").alias("status"), F.when(F.col("quality") == 1, "good").alias("lang"))
    return joins.merged(table(spark, sf, "documents"), patches, "doc_id", ["lang"]).select("doc_id", "lang", "retained")


@query("J05_leftover_patches", "SELECT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def leftover(spark, sf):
    return joins.leftovers(table(spark, sf, "labels"), table(spark, sf, "documents").filter("lang = 'en'"), "doc_id").select("doc_id")


@query(
    "J06_differences",
    """SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.doc_id IS NULL THEN 'added' WHEN b.doc_id IS NULL THEN 'removed' ELSE 'changed' END AS kind
FROM (SELECT * FROM documents WHERE doc_id % 7 <> 0) a FULL JOIN (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'xx' ELSE lang END AS lang FROM documents WHERE doc_id % 11 <> 0) b ON a.doc_id = b.doc_id
WHERE a.doc_id IS NULL OR b.doc_id IS NULL OR a.lang <> b.lang""",
)
def differences(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    changed = docs.filter("doc_id % 11 <> 0").withColumn("lang", F.when(F.col("doc_id") % 5 == 0, "xx").otherwise(F.col("lang")))
    return joins.differences(docs.filter("doc_id % 7 <> 0"), changed, "doc_id", ["lang", "n_chars"])


@query("J07_key_overlap", "SELECT l_orderkey, count(DISTINCT l_partkey) AS n_keys FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_partkey % 10 = 0) GROUP BY 1")
def overlap(spark, sf):
    held = table(spark, sf, "part").filter("p_partkey % 10 = 0").select(F.col("p_partkey").alias("key"))
    return joins.key_overlap(table(spark, sf, "lineitem"), held, "l_orderkey", F.array("l_partkey"), "key")


@query(
    "J30_anti_cascade",
    """SELECT coalesce(CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 'id' WHEN source IN ('src1', 'src2') THEN 'source'
 WHEN lower(regexp_replace(text, '[^a-zA-Z0-9]+', '', 'g')) IN (SELECT lower(regexp_replace(text, '[^a-zA-Z0-9]+', '', 'g')) FROM benchmark) THEN 'text' END, 'kept') AS reason, count(*) AS n FROM documents GROUP BY 1""",
)
def anti_cascade(spark, sf):
    docs = table(spark, sf, "documents").withColumn("key", text.compact(F.col("text")))
    held = table(spark, sf, "benchmark").select(text.compact(F.col("text")).alias("key"))
    sources = docs.filter(F.col("source").isin("src1", "src2")).select("source").distinct()
    rows = joins.cascade(docs, [("id", "doc_id", table(spark, sf, "labels").filter("toxic = 1")), ("source", "source", sources), ("text", "key", held)])
    return rows.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query("J09_override", "SELECT c.conv_id, c.turn, coalesce(u.text, c.text) AS text FROM conversations c JOIN (SELECT doc_id, CASE WHEN n_chars < 500 THEN text END AS text FROM documents) u ON c.conv_id = u.doc_id")
def override(spark, sf):
    own = table(spark, sf, "documents").select(F.col("doc_id").alias("conv_id"), F.when(F.col("n_chars") < 500, F.col("text")).alias("other"))
    return table(spark, sf, "conversations").join(own, "conv_id").select("conv_id", "turn", F.coalesce("other", "text").alias("text"))


@query("J11_listings", "SELECT coalesce(a.k, b.k) AS k, a.k IS NOT NULL AS here, b.k IS NOT NULL AS there FROM (SELECT doc_id k FROM documents WHERE doc_id % 2 = 0) a FULL JOIN (SELECT doc_id k FROM documents WHERE doc_id % 3 = 0) b ON a.k = b.k")
def listings(spark, sf):
    docs = table(spark, sf, "documents")
    a, b = (docs.filter(f"doc_id % {n} = 0").select(F.col("doc_id").alias("k"), F.lit(True).alias(c)) for n, c in ((2, "here"), (3, "there")))
    return a.join(b, "k", "full_outer").select("k", F.coalesce("here", F.lit(False)).alias("here"), F.coalesce("there", F.lit(False)).alias("there"))


@query("J21_near_words", """WITH w AS (SELECT DISTINCT p_brand AS word FROM part), p AS (SELECT a.word AS query, b.word AS word, levenshtein(a.word, b.word) AS distance FROM w a, w b WHERE a.word <> b.word AND levenshtein(a.word, b.word) <= 1)
SELECT query, word, CAST(distance AS INTEGER) AS distance, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, word) AS rank FROM p) WHERE rank <= 8""")
def near_words(spark, sf):
    return joins.near_words(table(spark, sf, "part").select(F.col("p_brand").alias("word")), 1, 8)


@query("J24_paired_runs", "SELECT a.lang, CAST(sum(b.n_chars - a.n_chars) AS DOUBLE) / greatest(CAST(sum(a.n_chars) AS DOUBLE), 1) AS delta FROM documents a JOIN (SELECT doc_id - 1 AS doc_id, n_chars FROM documents) b ON a.doc_id = b.doc_id GROUP BY 1")
def paired_runs(spark, sf):
    docs = table(spark, sf, "documents")
    other = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("n_chars").alias("other"))
    return docs.join(other, "doc_id").groupBy("lang").agg((F.sum(F.col("other") - F.col("n_chars")).cast("double") / F.greatest(F.sum("n_chars").cast("double"), F.lit(1.0))).alias("delta"))


@query("J29_prefix_range", "SELECT page_id FROM pages WHERE url >= 'https://www.' AND url < 'https://www/'")
def prefix_range(spark, sf):
    return table(spark, sf, "pages").filter("url >= 'https://www.' and url < 'https://www/'").select("page_id")


@query("O08_order_key", "SELECT doc_id, sha256('7:' || doc_id || ':' || lang) AS k FROM documents")
def order_key(spark, sf):
    return table(spark, sf, "documents").select("doc_id", order.order_key(7, "doc_id", "lang").alias("k"))


@query("W13_capped_sample", "SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY sha256('3:' || doc_id)) r FROM documents) WHERE r <= 5")
def capped(spark, sf):
    return picks.capped(table(spark, sf, "documents"), ["source"], [order.order_key(3, "doc_id")], 5).select("doc_id", "source")


@query("W17_round_robin", "SELECT doc_id, CAST((row_number() OVER (PARTITION BY lang ORDER BY sha256('4:' || doc_id)) - 1) % greatest(1, CAST(round_even(count(*) OVER (PARTITION BY lang) / 50.0, 0) AS INTEGER)) AS INTEGER) AS hand FROM documents")
def round_robin(spark, sf):
    return picks.dealt(table(spark, sf, "documents").select("doc_id", "lang"), ["lang"], order.order_key(4, "doc_id"), 50).select("doc_id", "hand")


@query("W18_winner", "SELECT user_id, arg_max(event_id, (CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) * 1000000000 + event_id) AS event_id FROM events GROUP BY 1")
def winner(spark, sf):
    return picks.winners(table(spark, sf, "events"), ["user_id"], F.col("event_type") == "purchase", "event_id", ["event_id"])


@query("W20_first_by_text", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY sha256('5:' || doc_id)) r FROM documents) WHERE r = 1")
def first_by_text(spark, sf):
    return picks.firsts(table(spark, sf, "documents"), ["text"], [order.order_key(5, "doc_id")]).select("doc_id")


@query("W21_duplicates", "SELECT min(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY text")
def duplicates(spark, sf):
    return table(spark, sf, "documents").groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")).select("doc_id", "n")


@query("W16_matched", "WITH r AS (SELECT doc_id, source, lang, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) r FROM documents), k AS (SELECT source, lang, count(*) c FROM documents GROUP BY 1, 2), q AS (SELECT source, min(c) n FROM k GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT lang) FROM documents)) SELECT doc_id FROM r JOIN q USING (source) WHERE r <= n")
def matched(spark, sf):
    return picks.matched(table(spark, sf, "documents"), ["source"], "lang", ["doc_id"]).select("doc_id")


@query("W23_pairs", "WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('6:' || doc_id)) r FROM documents) SELECT a.lang, CAST(ceil(a.r / 2.0) AS BIGINT) AS pair, a.doc_id AS first, b.doc_id AS second FROM r a JOIN r b ON a.lang = b.lang AND b.r = a.r + 1 WHERE a.r % 2 = 1")
def pairs(spark, sf):
    return picks.paired(table(spark, sf, "documents").select("doc_id", "lang"), ["lang"], order.order_key(6, "doc_id"), "doc_id").withColumn("pair", F.col("pair").cast("long"))


@query("F42_bucket", "SELECT doc_id, list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(sha256(CAST(doc_id AS VARCHAR)), ''), lambda c: CAST('0x' || c AS BIGINT))), lambda a, d: (a * 16 + d) % 97) AS bucket FROM documents")
def bucket(spark, sf):
    return table(spark, sf, "documents").select("doc_id", order.bucket(F.col("doc_id"), 97).alias("bucket"))


@query("F43_stable_int", "SELECT doc_id, CAST(('0x' || substr(sha1(lang || doc_id), 1, 8)) AS BIGINT) AS k FROM documents")
def stable(spark, sf):
    return table(spark, sf, "documents").select("doc_id", order.stable_int(F.concat("lang", F.col("doc_id").cast("string"))).alias("k"))


@query("U03_shared_keys", "SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 45 INTERSECT SELECT l_partkey FROM lineitem WHERE l_discount > 0.09")
def shared(spark, sf):
    items = table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "k")
    return items.filter("l_quantity > 45").select("k").intersect(items.filter("l_discount > 0.09").select("k"))


@query("U04_difference", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def difference(spark, sf):
    return table(spark, sf, "documents").select("doc_id").subtract(table(spark, sf, "labels").select("doc_id"))


@query("U08_split_leaks", "SELECT source, count(DISTINCT doc_id % 3) AS n FROM documents GROUP BY 1 HAVING count(DISTINCT doc_id % 3) > 1")
def split_leaks(spark, sf):
    return table(spark, sf, "documents").groupBy("source").agg(F.count_distinct(F.col("doc_id") % 3).alias("n")).filter("n > 1")


def _same_texts(docs, items):
    """doc_id and the least item_id of the items with the same compact text. A key that can't be null is made once: the join asks no more of it."""
    key = F.coalesce(F.sha2(text.compact(F.col("text")), 256), F.lit("")).alias("k")
    docs, items = (df.filter("text is not null") for df in (docs, items))
    return docs.select("doc_id", key).join(items.groupBy(key).agg(F.min("item_id").alias("item_id")), "k").select("doc_id", "item_id")


@query("J25_planted_texts", "WITH d AS (SELECT doc_id, text FROM documents UNION ALL SELECT -1 - item_id, replace(text, ' ', ', ') FROM benchmark WHERE item_id % 3 = 0) SELECT d.doc_id, min(b.item_id) AS item_id FROM d JOIN benchmark b ON lower(regexp_replace(d.text, '[^a-zA-Z0-9]+', '', 'g')) = lower(regexp_replace(b.text, '[^a-zA-Z0-9]+', '', 'g')) GROUP BY 1")
def planted_texts(spark, sf):
    held = table(spark, sf, "benchmark")
    planted = held.filter("item_id % 3 = 0").select((-1 - F.col("item_id")).alias("doc_id"), F.replace("text", F.lit(" "), F.lit(", ")).alias("text"))
    return _same_texts(table(spark, sf, "documents").select("doc_id", "text").unionByName(planted), held)


@query("J25_text_contamination", "SELECT d.doc_id, min(b.item_id) AS item_id FROM documents d JOIN benchmark b ON lower(regexp_replace(d.text, '[^a-zA-Z0-9]+', '', 'g')) = lower(regexp_replace(b.text, '[^a-zA-Z0-9]+', '', 'g')) GROUP BY 1")
def text_contamination(spark, sf):
    return _same_texts(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
