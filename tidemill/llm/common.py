"""Helpers of the training-data operators: shared scratch tables, folds, word splitting and hashing."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = (1 << 64) - 1
SALTS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir as the cluster names it.

    Only in local sessions, as in tests, a temporary folder stands in for it; on a cluster it has to be set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='tidemill-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_dir(spark)}/tidemill/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables that this application's operators wrote, once their results have been read or saved."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: cuts lineage, survives lost executors, has known size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_keys(counts: DataFrame, key: str, n: str, share: int = 1000) -> list:
    """The keys that hold more than 1/share of all rows, from their counts: fewer than `share`, whatever the size."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return [r[0] for r in counts.filter(F.col(key).isNotNull() & (F.col(n) * share > total) & (F.col(n) > 1)).select(key).collect()]


def spread_join(rows: DataFrame, table: DataFrame, key: str, hot: list, how: str = "left", also: tuple[str, ...] = ()) -> DataFrame:
    """`rows` joined with `table`, which has few entries a key (and `also`, more columns that have to be equal). Rows of
    hot keys are dealt over the shuffle partitions (SALTS at most) and meet a copy of their entries in each, so that no key
    makes a large task and the copies stay few."""
    if not hot:
        return rows.join(table, [key, *also], how)
    salts, salt = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), SALTS), "__tm_salt"
    is_hot = F.col(key).isin(hot)
    rows = rows.withColumn(salt, F.when(is_hot, F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    table = table.withColumn(salt, F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return rows.join(table, [key, *also, salt], how).drop(salt)


def held_out(doc_id: Column | str) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0, and for null ids: such rows never teach a model."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def order_hash(*columns: Column | str, seed: str) -> Column:
    """A pseudo-random but reproducible long for ordering and bounded samples."""
    return F.xxhash64(F.lit(seed), *columns)


#: A-Z become a-z; every other ASCII byte that is no digit or letter becomes a blank.
_WORD_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_LOWER_TABLE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def alnum_words(text: str | None) -> list[bytes]:
    """Words [0-9a-z and all beyond ASCII]+ after lower-casing A-Z, as UTF-8."""
    return text.encode("utf-8", "replace").translate(_WORD_TABLE).split() if text else []


def blank_words(text: str | None) -> list[bytes]:
    """Runs without blank, tab, newline, vertical tab, form feed or return, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "replace").translate(_LOWER_TABLE).split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words (xor-shift and multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every run of k words, from the words' hashes; one for each start."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, 0x9E3779B97F4A7C15 * k & MASK, np.uint64)
    for j in range(k):
        out = mix(out + h[j : j + n])
    return out
