"""Tables clustered by a key: files of disjoint, ascending key ranges, each with a Bloom filter, and point lookups that open few of them.

    root/rows/    Parquet files, sorted by key        root/files/    one row a file: file, least, most, n

A lookup finds by the table of ranges which files can hold a key and reads those alone; in them Parquet's row-group statistics and Bloom filters
leave out what can't hold it. The table of ranges is small: one row for each file.

Defined cases: null keys and keys given twice are refused when a table is written. A key that isn't there is reported, not an error. Looking
up nothing gives no rows. Repeated keys of a lookup count once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: So many keys go into a Parquet filter, which its Bloom filters and row groups are tested with; more are joined.
FILTERED_KEYS = 256
#: More keys than these are better met by a join with the whole table.
LOOKUP_KEYS = 1_000_000


def write_clustered(df: DataFrame, root: str, key: str, files: int | None = None, rows_per_group: int = 100_000) -> DataFrame:
    """Write rows in total order of their key over files and give the ranges (file, least, most, n); ValueError where keys
    are null or given twice. Nothing but ranges of sampled keys is agreed between tasks: each sorts its own."""
    spark = df.sparkSession
    dealt = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    bloom = {f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.expected.ndv#{key}": str(rows_per_group)}
    dealt.sortWithinPartitions(key).write.options(**bloom).parquet(f"{root}/rows")
    # A key given twice stands in one file, beside itself: ranges are disjoint, so distinct keys are counted file by file.
    file = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    rows = spark.read.schema(df.schema).parquet(f"{root}/rows").select(file.alias("file"), F.col(key).alias("k"))
    keys = rows.groupBy("file", "k").agg(F.count("*").alias("c"))
    found = keys.groupBy("file").agg(F.min("k").alias("least"), F.max("k").alias("most"), F.sum("c").alias("n"), F.count_if((F.col("c") > 1) | F.col("k").isNull()).alias("wrong"))
    found.write.parquet(f"{root}/files")
    ranges = spark.read.parquet(f"{root}/files")
    if wrong := (ranges.filter("wrong > 0").limit(1).collect() or range_problems(ranges).limit(1).collect()):
        raise ValueError(f"keys are null, given twice or out of order in {wrong[0]['file']}")
    return ranges.drop("wrong")


def file_ranges(rows: DataFrame, key: str) -> DataFrame:
    """file, least, most, n of the files that a table is read from."""
    file = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return rows.select(file.alias("file"), F.col(key).alias("k")).groupBy("file").agg(F.min("k").alias("least"), F.max("k").alias("most"), F.count("*").alias("n"))


def range_problems(ranges: DataFrame) -> DataFrame:
    """Files that begin before another that starts earlier has ended (file, least, before): none where the files, by
    least key, are in total order. One row a file meets in one task."""
    before = F.max("most").over(Window.orderBy("least", "file").rowsBetween(Window.unboundedPreceding, -1))
    return ranges.withColumn("before", before).filter(F.col("before") >= F.col("least")).select("file", "least", "before")


def holding_files(ranges: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """key, file: the one file whose range holds each distinct key; keys that lie in no range are left out.

    Keys and ranges are merged in order (each key follows the range that began last), not compared in pairs."""
    asked = keys.select(F.col(key).alias("k")).filter("k is not null").distinct()
    marks = asked.select("k", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("file"), F.lit(None).cast(asked.schema["k"].dataType).alias("most"))
    marks = marks.unionByName(ranges.select(F.col("least").cast(asked.schema["k"].dataType).alias("k"), F.lit(0).alias("kind"), "file", F.col("most").cast(asked.schema["k"].dataType).alias("most")))
    order = Window.orderBy("k", "kind")
    last = lambda c: F.last(c, ignorenulls=True).over(order)
    met = marks.select("k", "kind", last("file").alias("file"), last("most").alias("most"))
    return met.filter((F.col("kind") == 1) & (F.col("k") <= F.col("most"))).select(F.col("k").alias(key), "file")


def lookup(spark: SparkSession, root: str, keys: DataFrame | Iterable, key: str, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """The rows of some keys, the keys that aren't there, and the names of the files that are opened for them."""
    ranges = spark.read.parquet(f"{root}/files")
    kind = ranges.schema["least"].dataType
    listed = None
    if not isinstance(keys, DataFrame):
        listed = sorted({k for k in keys if k is not None})
        keys = spark.createDataFrame([(k,) for k in listed], f"{key} {kind.simpleString()}")
    asked = keys.select(F.col(key).cast(kind).alias(key)).filter(F.col(key).isNotNull()).distinct()
    table = spark.read.parquet(f"{root}/rows")
    table = table.select(*dict.fromkeys([key, *columns])) if columns else table
    if (len(listed) if listed is not None else asked.limit(LOOKUP_KEYS + 1).count()) > LOOKUP_KEYS:
        return table.join(asked, key, "left_semi"), asked.join(table.select(key), key, "left_anti"), []
    files = [r["file"] for r in holding_files(ranges, asked, key).select("file").distinct().collect()]  # at most LOOKUP_KEYS short names
    if not files:
        return table.limit(0), asked, []
    rows = spark.read.schema(table.schema).parquet(*[f"{root}/rows/{f}" for f in sorted(files)]).select(*table.columns)
    found = rows.filter(_among(F.col(key), listed)) if listed and len(listed) <= FILTERED_KEYS else rows.join(asked, key, "left_semi")
    return found, asked.join(found.select(key), key, "left_anti"), sorted(files)


def _among(column: Column, keys: list) -> Column:
    """One equality after the other, which Parquet's filters see as they are."""
    met = column == F.lit(keys[0])
    for k in keys[1:]:
        met = met | (column == F.lit(k))
    return met
