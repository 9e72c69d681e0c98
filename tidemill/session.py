"""Session defaults shared by tests, the benchmark and applications."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "tidemill", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults. On a cluster leave `master` unset: the launcher's settings hold."""
    builder = SparkSession.builder.appName(app).config(map={**DEFAULTS, **conf})
    if master:
        builder = builder.master(master).config("spark.driver.host", "127.0.0.1")
        builder = builder.config("spark.driver.memory", os.environ.get("TIDEMILL_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def ensure_checkpoints(spark: SparkSession) -> None:
    """See to it that checkpoint() has a folder: the cluster's (spark.checkpoint.dir) or, in local sessions alone, a temporary one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or f"file://{tempfile.mkdtemp(prefix='tidemill-')}")


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application below spark.checkpoint.dir (in local sessions alone a temporary one)."""
    ensure_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tidemill"


def kept(df: DataFrame, name: str) -> DataFrame:
    """A table written into the shared folder and read back: computed once, its lineage cut, safe from lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
