"""Image files (S3, S4, J7) through Spark's ``image`` source (BGR, HWC bytes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_images(spark: SparkSession, path: str, drop_invalid: bool = False) -> DataFrame:
    """S3: decoded images; unreadable files stay as rows with height -1 unless dropped on request."""
    df = spark.read.format("image").option("dropInvalid", drop_invalid).load(path)
    return df.select(F.col("image.origin").alias("origin"),
                     F.struct(F.col("image.height").alias("height"), F.col("image.width").alias("width"),
                              F.col("image.nChannels").alias("n_channels"), F.col("image.data").alias("data"))
                     .alias("image"))


def image_dims(images: DataFrame) -> DataFrame:
    """Original (width, height) per file."""
    return images.select("origin", F.col("image.width").alias("width"), F.col("image.height").alias("height"))


def attach_images(annotations: DataFrame, images: DataFrame, path_col: str = "path", root: str = "",
                  missing: str = "keep") -> DataFrame:
    """Annotations joined to decoded images by their full path.

    Relative annotation paths are below ``root``; both sides lose their URI scheme.  An
    annotation without an image stays with a null ``image`` (``missing="keep"``) or is left
    out on request (``missing="drop"``)."""
    bare = lambda c: F.regexp_replace(c, r"^[a-zA-Z][\w+.-]*:(//[^/]*)?(?=/)", "")
    path = bare(F.col(path_col))
    below = F.concat(bare(F.lit(root.rstrip("/") + "/")), path)
    a = annotations.withColumn("__path", F.when(path.startswith("/"), path).otherwise(below))
    i = images.withColumn("__file", F.regexp_replace(bare(F.col("origin")), "^/+", "/"))
    return a.join(i, F.col("__path") == F.col("__file"), "left" if missing == "keep" else "inner").drop("__path", "__file")
