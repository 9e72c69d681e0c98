"""Tables of records over versioned snapshots: import from JSON lines, materialise layers, rebuild, inspect, clean up.

Every change is a new immutable version whose manifest appears last. A broken run leaves data that no manifest names;
running it again writes the version anew. A version that is there already with the same note is taken as done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.operators import layers
from tidemill.session import kept
from tidemill.sources import jsonl, snapshots
from tidemill.sources.snapshots import Manifest


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the visible versions; none where the table doesn't exist."""
    return [m.version for m in snapshots.published(spark, root)] if _exists(spark, f"{root}/manifests") else []


def import_lines(spark: SparkSession, path: str, schema: StructType, root: str, key: str = "id") -> Manifest:
    """JSON lines as version 0. Lines that aren't records and keys given twice are errors; nothing is published then."""
    rows, bad = jsonl.read_lines(spark, path, schema)
    first = bad.limit(1).collect()
    if first:
        raise ValueError(f"not a record: {first[0].asDict()}")
    rows = rows.select(*schema.fieldNames())
    twice = jsonl.duplicated(rows, key).limit(1).collect()
    if twice:
        raise ValueError(f"key given twice: {twice[0][key]}")
    return snapshots.publish(rows, root, 0, None, "imported")


def materialise(spark: SparkSession, root: str, parent: int, layer: DataFrame, step: layers.Step, key: str = "id", document: str = "record_json") -> Manifest:
    """The next version: the parent's rows with a layer (id, changes, status) applied.

    Raises where the parent isn't the latest version, a patch has no visible row, or a rule is broken."""
    note = f"layer {step.name} on v{parent}"
    there = versions(spark, root)
    if parent + 1 in there and snapshots.manifest(spark, root, parent + 1).note == note:
        return snapshots.manifest(spark, root, parent + 1)
    if not there or parent != there[-1]:
        raise ValueError(f"v{parent} isn't the latest version")
    rows = snapshots.open_version(spark, root, parent)
    new = applied(rows, layer, step, key, document)
    made = snapshots.publish(new, root, parent + 1, parent, note)
    if made.count != snapshots.manifest(spark, root, parent).count:
        raise ValueError("a layer may not change the number of rows")
    return made


def applied(rows: DataFrame, layer: DataFrame, step: layers.Step, key: str = "id", document: str = "record_json") -> DataFrame:
    """Rows with a layer applied, or ValueError with its first problem."""
    wrong = layers.check_step(step, [])
    if wrong:
        raise ValueError(wrong[0])
    problem = layers.layer_problems(layer, rows, key).limit(1).collect()
    if problem:
        raise ValueError(f"{problem[0]['id']}: {problem[0]['problem']}")
    new = kept(layers.replay(rows, layer, step, key, document), "replayed")  # once, for the check and for the table
    broken = new.filter("error is not null").limit(1).collect()
    if broken:
        raise ValueError(f"{broken[0][key]}: {broken[0]['error']}")
    others = rows.drop(document, "retained")
    return others.join(new.drop("error"), key).select(*rows.columns)


def rebuilt(source: DataFrame, steps: list[tuple[DataFrame, layers.Step]], key: str = "id", document: str = "record_json") -> DataFrame:
    """The rows that a source and its layers give, without any table of theirs."""
    for i, (layer, step) in enumerate(steps):
        wrong = layers.check_step(step, [s for _, s in steps[:i]])
        if wrong:
            raise ValueError(wrong[0])
        source = applied(source, layer, step, key, document)
    return source


def equivalent(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables hold the same rows, as often, in any order."""
    same = sorted(left.columns) == sorted(right.columns)
    return same and snapshots.content_digest(left) == snapshots.content_digest(right)


def inspect(spark: SparkSession, root: str) -> dict[str, list]:
    """The visible versions, and folders of data that none of them names."""
    named = {m.data for m in snapshots.published(spark, root)} if _exists(spark, f"{root}/manifests") else set()
    return {"versions": versions(spark, root), "unpublished": sorted(d for d in _children(spark, f"{root}/data") if f"data/{d}" not in named)}


def clean_up(spark: SparkSession, root: str, protected: set[int], dry_run: bool = True) -> list[int]:
    """Versions that are neither protected nor the latest; without dry_run their manifests go first, then their data."""
    found = snapshots.published(spark, root)
    old = [m for m in found[:-1] if m.version not in protected]
    if not dry_run:
        fs, path = _fs(spark, root)
        for m in old:
            fs.delete(path(f"{root}/manifests/v{m.version}"), True)
            if not any(m.data == other.data for other in found if other not in old):
                fs.delete(path(f"{root}/{m.data}"), True)
    return [m.version for m in old]


def shard(spark: SparkSession, root: str, version: int, seed: int, epoch: int, shards: int, number: int) -> DataFrame:
    """The rows of one shard of a version: whole files, dealt anew for every epoch; all shards give every row once."""
    rows = snapshots.open_version(spark, root, version).withColumn("__file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    return rows.filter(F.pmod(F.xxhash64(F.lit(seed), F.lit(epoch), "__file"), F.lit(shards)) == number).drop("__file")


def _fs(spark: SparkSession, root: str):
    """The file system of a path as Spark reads it, and a function that makes its paths."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _exists(spark: SparkSession, folder: str) -> bool:
    fs, path = _fs(spark, folder)
    return fs.exists(path(folder))


def _children(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _fs(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path(folder))] if fs.exists(path(folder)) else []
