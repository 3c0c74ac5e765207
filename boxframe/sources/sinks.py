"""Sinks and profiles: metrics table, detection files, dataset counts."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def metrics_long(wide: DataFrame, step_col: str, value_cols: Sequence[str]) -> DataFrame:
    """Wide per-step scalars -> ``(step, tag, value)`` rows (``unpivot``)."""
    w = wide.select(F.col(step_col).alias("step"), *[F.col(c).cast("double").alias(c) for c in value_cols])
    return w.unpivot(["step"], list(value_cols), "tag", "value")


def write_metrics(wide: DataFrame, path: str, step_col: str, value_cols: Sequence[str]) -> None:
    """Append the long metrics table (one writer, partitioned by tag)."""
    metrics_long(wide, step_col, value_cols).write.mode("append").partitionBy("tag").parquet(path)


def write_detections(det: DataFrame, path: str, mode: str = "append") -> None:
    """Detection rows ``img_id, x_min..y_max, score, label``, partitioned by class."""
    (det.select("img_id", "pred_id", "x_min", "y_min", "x_max", "y_max", "score", "label")
        .write.mode(mode).partitionBy("label").parquet(path))


def write_epoch(det: DataFrame, path: str, epoch: int) -> None:
    """S8, idempotent: the detections of an epoch replace what the epoch's folder held, other epochs stay.

    Rows are sorted by class within the files, so a reader of some classes skips row groups.  An epoch without any
    detection leaves its folder as it was."""
    (det.select("img_id", "pred_id", "label", "score", "x_min", "y_min", "x_max", "y_max", F.lit(epoch).alias("epoch"))
        .sortWithinPartitions("label", "img_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("epoch").parquet(path))


def read_detections(spark: SparkSession, path: str, epoch: int | None = None, labels: Sequence[int] | None = None) -> DataFrame:
    """Detections of :func:`write_epoch`: only the epoch's folder is listed, the classes are pushed to the scan."""
    df = spark.read.parquet(path)
    df = df if epoch is None else df.filter(F.col("epoch") == epoch)
    return df if labels is None else df.filter(F.col("label").isin(list(labels)))


def dataset_profile(boxes: DataFrame) -> DataFrame:
    """Boxes and images per class, and a total row (``label`` NULL)."""
    return (boxes.rollup("label")
                 .agg(F.count(F.lit(1)).alias("n_boxes"), F.count_distinct("img_id").alias("n_images")))
