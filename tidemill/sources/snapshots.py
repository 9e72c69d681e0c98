"""Versioned Parquet snapshots: data is written first, and a version exists once its manifest does.

    root/data/v3-<run>/   Parquet files        root/manifests/v3/   one JSON row, written in one piece

A manifest pins row count, content digest, schema and parent. Readers open a version through its manifest; data of a
broken run has none and is never seen. Two writers of the same version: the second fails, as the folder exists.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.operators.measures import combine_digest, multiset_digest


@dataclass(frozen=True)
class Manifest:
    version: int
    parent: int | None
    data: str
    count: int
    digest: str
    schema: str
    note: str = ""


def content_digest(df: DataFrame) -> tuple[int, str]:
    """Row count and an order-free digest of all rows."""
    text = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    row = df.agg(F.count("*").alias("n"), *multiset_digest(text)).first()
    return row["n"], combine_digest([row[f"w{i}"] for i in range(8)])


def publish(df: DataFrame, root: str, version: int, parent: int | None = None, note: str = "") -> Manifest:
    """Write a version and make it visible."""
    spark, data = df.sparkSession, f"data/v{version}-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{data}")
    count, digest = content_digest(spark.read.schema(df.schema).parquet(f"{root}/{data}"))
    manifest = Manifest(version, parent, data, count, digest, df.schema.json(), note)
    spark.createDataFrame([(json.dumps(asdict(manifest)),)], "value string").coalesce(1).write.mode("errorifexists").text(f"{root}/manifests/v{version}")
    return manifest


def manifest(spark: SparkSession, root: str, version: int) -> Manifest:
    return Manifest(**json.loads(spark.read.text(f"{root}/manifests/v{version}").first()["value"]))


def published(spark: SparkSession, root: str) -> list[Manifest]:
    """All visible versions in order."""
    rows = spark.read.option("recursiveFileLookup", "true").text(f"{root}/manifests").collect()  # one short row per version
    return sorted((Manifest(**json.loads(r["value"])) for r in rows), key=lambda m: m.version)


def open_version(spark: SparkSession, root: str, version: int, pinned: Manifest | None = None) -> DataFrame:
    """The rows of a version; with a pinned manifest, any difference to it is an error."""
    found = manifest(spark, root, version)
    if pinned is not None and pinned != found:
        raise ValueError(f"version {version} isn't what was pinned")
    return spark.read.schema(StructType.fromJson(json.loads(found.schema))).parquet(f"{root}/{found.data}")


def compact(spark: SparkSession, root: str, version: int, new_version: int, files: int) -> Manifest:
    """Rewrite a version into fewer files as a new one; its content must be the same."""
    old = manifest(spark, root, version)
    new = publish(open_version(spark, root, version).repartition(files), root, new_version, version, "compacted")
    if (new.count, new.digest) != (old.count, old.digest):
        raise ValueError("content changed while compacting")
    return new


def verify(spark: SparkSession, root: str, version: int) -> bool:
    """Whether a version's rows still have the count and digest of its manifest."""
    found = manifest(spark, root, version)
    return content_digest(open_version(spark, root, version)) == (found.count, found.digest)
