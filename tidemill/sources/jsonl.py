"""JSON-lines records: reading with located errors, validated import, sorted export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.operators.measures import combine_digest, multiset_digest
from tidemill.operators.records import RecordQuery


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no (from 1) and value of every line. Lines are counted by split of a file and the counts of the splits
    before are added: nothing is sorted or read by one task."""
    split = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.text(path).select(*split, F.monotonically_increasing_id().alias("at"), "value")
    # One split is read by one task, in order, so that its lines' running numbers follow each other.
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = blocks.select("file", "block", (before - F.col("first") + 1).alias("shift"))
    return lines.join(places, ["file", "block"]).select("file", (F.col("at") + F.col("shift")).alias("line_no"), "value")


def read_lines(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Records of JSON lines (plain or gzip) with their file, and the lines that aren't records with file and line number.

    Blank lines are skipped. A declared schema is never inferred; compressed files can't be split, so that their rows should
    be dealt anew before heavy work. Lines are numbered only where the second table is read."""
    full = StructType([*schema.fields]).add("_corrupt", "string")
    parse = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value").filter(F.length(F.trim("value")) > 0)
    good = lines.withColumn("r", parse).filter("r is not null and r._corrupt is null").select("file", *[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])
    wrong = numbered_lines(spark, path).filter(F.length(F.trim("value")) > 0).withColumn("r", parse)
    return good, wrong.filter("r is null or r._corrupt is not null").select("file", "line_no", F.col("value").alias("line"))


def read_records(spark: SparkSession, source: str, schema: StructType, query: RecordQuery | None = None) -> DataFrame:
    """Records that a query asks for, from JSON lines (.jsonl, .jsonl.gz or a folder of them) or from a Parquet table: the same
    columns and the same rule of visible rows either way. A record without `retained` is visible."""
    lines = ".jsonl" in source.rsplit("/", 1)[-1]
    rows = read_lines(spark, source, schema)[0].drop("file") if lines else spark.read.parquet(source)
    rows = rows.withColumn("retained", F.coalesce("retained", F.lit(True)) if "retained" in rows.columns else F.lit(True))
    return (query or RecordQuery()).apply(rows).select(*schema.fieldNames())


def duplicated(df: DataFrame, key: str) -> DataFrame:
    """Keys that more than one record has."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def write_lines(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """One JSON object per line, with its fields in order of name."""
    df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")).write.option("compression", compression).text(path)


def export_verified(df: DataFrame, path: str, key: str = "id") -> dict:
    """Write sorted-key JSON lines to a new folder, read them back and compare count and order-free digest with the table's."""
    write_lines(df, path)
    text = lambda rows: rows.agg(F.count("*").alias("n"), *multiset_digest(F.col("value"))).first()
    want = text(df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")))
    got = text(df.sparkSession.read.text(path))
    if want != got:
        raise ValueError(f"{path}: {got['n']} lines of {want['n']}, or other contents")
    return {"count": got["n"], "digest": combine_digest([got[f"w{i}"] for i in range(8)])}
