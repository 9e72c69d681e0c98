"""Streams: gap sessions with a watermark, and an idempotent sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gap_sessions(stream: DataFrame, key: str, at: str, gap: str, late: str) -> DataFrame:
    """Sessions of a key (ended by a gap), of a batch table or a stream; rows later than the watermark are ignored."""
    rows = stream.withWatermark(at, late) if stream.isStreaming else stream
    out = rows.groupBy(key, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "n")


def upsert_batches(stream: DataFrame, root: str, checkpoint: str):
    """Write each micro-batch under its own number: a batch that is run again replaces itself."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch={number}")

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
