"""Streaming meters (L7): the batch meter aggregate over an unbounded update stream.

Updates ``(step, ts, tag, val, n)`` arrive as files; meters reset on tumbling
event-time windows.  A watermark bounds the state: a window's state is dropped
once the watermark passes its end, and later updates for it are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boxframe.operators.meters import meter_aggs

UPDATE_SCHEMA = "step bigint, ts timestamp, tag string, val double, n int"


def meter_stream(updates: DataFrame, duration: str = "1 day", watermark: str = "1 day",
                 time_col: str = "ts") -> DataFrame:
    """Streaming (or batch) meters per (window, tag); ``window_start`` in epoch seconds."""
    g = (updates.withWatermark(time_col, watermark)
                .groupBy(F.window(time_col, duration).alias("__w"), "tag")
                .agg(*meter_aggs("val", "n", "step")))
    return g.select(F.unix_timestamp(F.col("__w.start")).alias("window_start"), "tag", "sum", "count",
                    "average", "last")


def start_meter_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, *,
                       duration: str = "1 day", watermark: str = "1 day", available_now: bool = True,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Read update files from ``source_dir`` and keep the meter table in ``sink_dir``.

    Each micro-batch's updated windows are merged into the sink by window and tag
    (``update`` mode + ``foreachBatch``); the checkpoint makes restarts exactly-once."""
    reader = spark.readStream.schema(UPDATE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = meter_stream(reader.parquet(source_dir), duration, watermark)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        # one file set per epoch: a retried epoch overwrites its own output
        batch.withColumn("epoch_id", F.lit(epoch_id)).write.mode("overwrite").parquet(
            f"{sink_dir.rstrip('/')}/epoch_id={epoch_id}")

    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint_dir).foreachBatch(upsert)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def read_meter_table(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Latest value of every (window, tag) in the sink (the last epoch that updated it)."""
    t = spark.read.parquet(sink_dir)
    latest = t.groupBy("window_start", "tag").agg(F.max("epoch_id").alias("epoch_id"))
    return t.join(latest, ["window_start", "tag", "epoch_id"]).drop("epoch_id")
