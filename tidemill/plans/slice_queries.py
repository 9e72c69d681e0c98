"""The flagship: documents as records, labels as a layer, visible rows by language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.plans.registry import query, table


@query(
    "slice_visible_by_lang",
    """SELECT d.lang AS lang, count(*) AS n, CAST(sum(d.n_chars) AS BIGINT) AS n_chars
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE coalesce(l.quality, 1) <> 0 GROUP BY d.lang""",
)
def visible_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    layered = docs.join(labels.select("doc_id", "quality"), "doc_id", "left").withColumn("retained", F.coalesce("quality", F.lit(1)) != 0)
    return layered.filter("retained").groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"))
