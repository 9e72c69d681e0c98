"""Files as tables: protocols, Markdown tables, digests of files and folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_protocol(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """A CSV file with a header, all columns as text. A column that is asked for and missing is an error."""
    rows = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise ValueError(f"{path}: no column {missing[0]}")
    return rows.select(*columns)


def markdown_cells(line: Column) -> Column:
    """The cells of a line of a Markdown table, trimmed; null for other lines and for the rule below the header."""
    inner = F.regexp_extract(F.trim(line), r"^\|(.*)\|$", 1)
    cells = F.transform(F.split(inner, r"(?<!\\)\|"), lambda c: F.trim(F.replace(c, F.lit("\\|"), F.lit("|"))))
    return F.when((inner != "") & ~inner.rlike(r"^[\s:|-]+$"), cells)


def file_facts(spark: SparkSession, folder: str) -> DataFrame:
    """path (below the folder), n_bytes and sha256 of every file below a folder; each file is read whole by one task.

    Spark gives no row for an empty file."""
    root = folder.rstrip("/").removeprefix("file://")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    relative = F.substring_index("path", f"{root}/", -1)
    return files.select(relative.alias("path"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def tree_digest(facts: DataFrame) -> DataFrame:
    """One row: files, bytes and a digest of a folder's listing: sha256 of the files' lines (path, size, sha256), added modulo
    2**256 by parts, so that it doesn't depend on an order."""
    from tidemill.operators.measures import multiset_digest

    line = F.concat_ws("\0", "path", F.col("n_bytes").cast("string"), "sha256")
    return facts.agg(F.count("*").alias("n_files"), F.sum("n_bytes").alias("n_bytes"), *multiset_digest(line))


def wrong_files(facts: DataFrame, declared: DataFrame) -> DataFrame:
    """path and problem of files that a declaration (path, n_bytes, sha256) doesn't fit: missing (unless declared empty), stray, size or digest."""
    there = facts.select("path", F.col("n_bytes").alias("b"), F.col("sha256").alias("s"))
    both = declared.withColumn("d", F.lit(True)).join(there, "path", "full")
    problem = F.when(F.col("b").isNull() & (F.col("n_bytes") > 0), "missing").when(F.col("d").isNull(), "stray").when(F.col("b") != F.col("n_bytes"), "size").when(F.col("s") != F.col("sha256"), "digest")
    return both.select("path", problem.alias("problem")).filter("problem is not null")


def sampled_rows(rows: DataFrame, split: str, key: Column, n: int) -> DataFrame:
    """The n rows of each split with the least hash, to be read back by a check."""
    place = F.row_number().over(Window.partitionBy(split).orderBy("__k"))
    salted = rows.withColumn("__k", key).withColumn("__part", F.substring("__k", 1, 2))
    few = salted.withColumn("__r", F.row_number().over(Window.partitionBy(split, "__part").orderBy("__k"))).filter(F.col("__r") <= n)
    return few.withColumn("__r", place).filter(F.col("__r") <= n).drop("__r", "__k", "__part")


def audio_samples(spark: SparkSession, path: str, columns: tuple[str, ...], audio: str = "audio", with_bytes: bool = False) -> DataFrame:
    """Samples of a Parquet dataset that holds its audio (a struct of bytes and path): the columns and the audio's path,
    with its size and bytes only where they are asked for, so that a scan without them doesn't read them."""
    rows = spark.read.parquet(path)
    extra = [F.col(f"{audio}.path").alias("audio_path")]
    if with_bytes:
        extra += [F.octet_length(f"{audio}.bytes").alias("n_bytes"), F.col(f"{audio}.bytes").alias("audio_bytes")]
    return rows.select(*columns, *extra)
