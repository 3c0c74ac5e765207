"""Incremental NMS over a stream of detection files (L8), in two forms.

:func:`start_session_nms`: an image's detections may come over any number of micro-batches, in any order.  They carry
an event time; state holds them by image and class until the watermark has passed the image's session (no detection
of it for ``gap``), then they are suppressed and appended once.  All of it is Spark's own stateful aggregation.

:func:`start_nms_stream`, for sources without event time.  Contract: all detections of an image arrive in the same file (micro-batch).
Each micro-batch is suppressed with the batch :func:`nms` and written to
``out_dir/epoch_id=N`` (overwrite: a retried epoch replaces itself).  Images
already emitted by an earlier epoch are not re-suppressed; their rows go to a
``late`` side table instead.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boxframe.functions.boxes import COORDS
from boxframe.operators.nms import nms, nms_fold, score_filter

DET_SCHEMA = "img_id bigint, label int, pred_id bigint, score double, x_min double, y_min double, x_max double, y_max double"


SEEN_BUCKETS = 64


def _bucket(img_id):
    return F.pmod(F.xxhash64(img_id), F.lit(SEEN_BUCKETS)).cast("int")


def _seen_images(spark: SparkSession, seen_dir: str, before_epoch: int, buckets: list[int]) -> DataFrame | None:
    """Images of earlier epochs, whether they gave detections or not; only the folders of
    the batch's hash buckets are read."""
    try:
        done = spark.read.schema("img_id bigint, epoch_id bigint, bucket int").parquet(seen_dir)
    except AnalysisException:  # nothing written yet
        return None
    return done.filter((F.col("epoch_id") < before_epoch) & F.col("bucket").isin(buckets)).select("img_id").distinct()


def start_nms_stream(spark: SparkSession, source_dir: str, out_dir: str, late_dir: str, checkpoint_dir: str, *,
                     iou_threshold: float = 0.5, score_threshold: float = 0.5, topk: int = 50,
                     variant: str = "tf", available_now: bool = True,
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = spark.readStream.schema(DET_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    seen_dir = f"{out_dir.rstrip('/')}_seen"

    def process(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        images = batch.select("img_id", _bucket("img_id").alias("bucket")).distinct()
        buckets = [r.bucket for r in images.select("bucket").distinct().collect()]  # SEEN_BUCKETS at most
        seen = _seen_images(spark, seen_dir, epoch_id, buckets)
        fresh, late = batch, None
        if seen is not None:
            fresh = batch.join(seen, "img_id", "left_anti")
            late = batch.join(seen, "img_id", "left_semi")
            images = images.join(seen, "img_id", "left_anti")
        kept = nms(fresh, iou_threshold, score_threshold, topk, variant)
        kept.withColumn("epoch_id", F.lit(epoch_id)).write.mode("overwrite").parquet(f"{out_dir}/epoch_id={epoch_id}")
        if late is not None:
            late.withColumn("epoch_id", F.lit(epoch_id)).write.mode("overwrite").parquet(f"{late_dir}/epoch_id={epoch_id}")
        (images.write.mode("overwrite").partitionBy("bucket").parquet(f"{seen_dir}/epoch_id={epoch_id}"))

    writer = stream.writeStream.option("checkpointLocation", checkpoint_dir).foreachBatch(process)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def start_session_nms(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str, *, gap: str = "1 minute",
                      delay: str = "10 minutes", iou_threshold: float = 0.5, score_threshold: float = 0.5, topk: int = 50,
                      variant: str = "tf", available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Detections with a column ``ts`` (timestamp); final detections are appended with their ``session_window``.

    ``gap``: event time without a detection after which an image is complete; ``delay``: how much later than the
    newest event time a detection may arrive.  Rows later than that are dropped by the watermark (Spark counts them
    in the query's progress), boxes with a null or NaN score or corner as in the batch operator.  State is bounded
    by the detections of the images within gap and delay."""
    reader = spark.readStream.schema(f"{DET_SCHEMA}, ts timestamp")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    cand = score_filter(reader.parquet(source_dir).withWatermark("ts", delay), score_threshold)
    for c in ("score", *COORDS):
        cand = cand.filter(F.col(c).isNotNull() & ~F.isnan(c))
    kept = nms_fold(cand, iou_threshold, topk, variant, ["img_id", "label"], "pred_id", "score", F.session_window("ts", gap))
    writer = kept.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir).option("path", out_dir).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
