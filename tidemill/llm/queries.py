"""Queries and SQL of the training-data operators, over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm import toxicity

    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.teach(docs, _table(spark, sf_dir, "labels")))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.licenses import scan

    return scan(_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.decontam import contamination, digest_columns

    return digest_columns(contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidemill.llm.packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.secrets import digest_columns, scan

    return digest_columns(scan(_table(spark, sf_dir, "documents")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm import quality
    from tidemill.llm.common import held_out, written

    stats = written(_table(spark, sf_dir, "documents").select("doc_id", quality.text_statistics("text").alias("stats")), "stats")
    model = quality.teach(stats, _table(spark, sf_dir, "labels"))
    rows = stats.select("doc_id", held_out("doc_id").alias("held_out"), quality.score(model, F.col("stats")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= quality.KEEP_AT).cast("int"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.urlfilter import judge

    return judge(_table(spark, sf_dir, "pages"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.neardup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.warc import archive_round_trip

    return archive_round_trip(_table(spark, sf_dir, "pages")).withColumnRenamed("capture_id", "page_id")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.topk import top_k

    rows = _table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.filter("vec_id % 20 = 0"), k=20)


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents"))


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.infill import digest_columns, fill_in_middle

    return digest_columns(fill_in_middle(_table(spark, sf_dir, "documents")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm import prefix_trie as trie
    from tidemill.llm.common import written

    steps, convs = trie.with_shared_heads(written(trie.step_rows(_table(spark, sf_dir, "conversations")), "turns"))
    return trie.prefix_trie(written(steps, "rebuilt"), convs).drop("end_conv_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_licenses": op2_licenses,
    "op3_decontamination": op3_decontamination,
    "op4_packing": op4_packing,
    "op5_secrets": op5_secrets,
    "op6_quality": op6_quality,
    "op7_url_filter": op7_url_filter,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_warc": op9_warc,
    "op10_topk": op10_topk,
    "op11_mixing": op11_mixing,
    "op12_infill": op12_infill,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL = {
    "op9_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS first FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
  CASE WHEN g.first IS NOT NULL AND g.first <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN g.first <> d.page_id THEN g.first END AS refers_to
FROM d LEFT JOIN g ON d.payload_digest = g.payload_digest AND d.payload_bytes >= 1000""",
    "op10_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20""",
    "op11_mixing": r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w, sum(source_size) OVER () AS total FROM s),
f AS (SELECT *, CAST(coalesce(sum(2 * source_size) OVER b, 0) AS BIGINT) AS full_size, CAST(coalesce(sum(w) OVER b, 0) AS BIGINT) AS full_w, CAST(sum(w) OVER () AS BIGINT) AS all_w
  FROM w WINDOW b AS (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e AS (SELECT 1.5::DOUBLE * total - full_size AS rest, all_w - full_w AS rest_w FROM f WHERE (1.5::DOUBLE * total - full_size) / (all_w - full_w) < 2 * source_size / w
  ORDER BY 2 * source_size / w, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, CAST(least(CASE WHEN (SELECT count(*) FROM e) = 0 THEN 2 * source_size ELSE w * (SELECT rest FROM e) / (SELECT rest_w FROM e) END, 2 * source_size) AS DOUBLE) AS target FROM f),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN CAST(floor(t.target) AS BIGINT) // t.source_size ELSE 0 END AS epochs,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, floor(target) - epochs * source_size - begin)) AS BIGINT) AS taken FROM p""",
    "op12_infill": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (SELECT doc_id, t, string_split(t, chr(10)) AS lines, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, chr(10))) - CASE WHEN t LIKE '%' || chr(10) THEN 1 ELSE 0 END END AS n,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
r AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM g),
c AS (SELECT *, CAST(CASE WHEN low = n THEN length(t) ELSE coalesce(list_sum(list_transform(lines[1:low], lambda x: length(x) + 1)), 0) END AS BIGINT) AS a,
    CAST(CASE WHEN high = n THEN length(t) ELSE coalesce(list_sum(list_transform(lines[1:high], lambda x: length(x) + 1)), 0) END AS BIGINT) AS b FROM r),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
    ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END AS output FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(output) AS output_sha256, sha256(t) AS restored_sha256 FROM o""",
    "op13_prefix_trie": """
WITH t AS (SELECT conv_id, turn, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS s FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(s ORDER BY turn NULLS FIRST, s) AS l FROM t GROUP BY conv_id),
hs AS (SELECT conv_id, l, xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 6 AS h FROM own),
c AS (SELECT hs.conv_id, list_concat(coalesce(b.l[1:h], []), hs.l[h + 1:]) AS l FROM hs LEFT JOIN own b ON b.conv_id = hs.conv_id - hs.conv_id % 100),
m AS (SELECT conv_id, len(l) AS len, unnest(range(len(l) + 1)) AS depth, l FROM c),
n AS (SELECT depth, l[1:depth] AS p, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len = depth), '') AS ends FROM m GROUP BY 1, 2),
k AS (SELECT n.*, u.conv_id AS parent_conv_id, (SELECT count(*) FROM n x WHERE x.depth = n.depth + 1 AND x.p[1:n.depth] = n.p) AS n_children FROM n LEFT JOIN n u ON u.depth = n.depth - 1 AND u.p = n.p[1:n.depth - 1]),
a AS (SELECT n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * length(p[depth].t) ELSE 0 END AS own, p, unnest(range(depth + 1)) AS up FROM k),
s AS (SELECT up AS depth, p[1:up] AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(own) AS saved FROM a GROUP BY 1, 2)
SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, k.parent_conv_id, k.n_convs, k.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(k.ends) AS ends_sha256
FROM k JOIN s ON s.depth = k.depth AND s.p = k.p""",
}
