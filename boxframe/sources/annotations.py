"""Text sources: annotation lines, class names, anchors.

Annotation line: ``img_id path (label x_min y_min x_max y_max)*`` separated by
single spaces.  A trailing partial group is ignored, as in the studied parser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.functions.boxes import COORDS

BOX_FIELDS = ("box_id", "label", *COORDS, "weight")


def _caster(mode: str):
    if mode == "FAILFAST":
        return lambda c, t: c.cast(t)
    if mode == "PERMISSIVE":
        return lambda c, t: c.try_cast(t)
    raise ValueError("mode must be FAILFAST or PERMISSIVE")


def parse_tokens(tokens: Column, mode: str = "FAILFAST") -> Column:
    """struct(img_id, path, boxes array<struct(box_id, label, x_min.., weight)>) from a
    line already split into tokens (a column reference, so the split runs once per line).

    FAILFAST: a bad number raises (ANSI cast).  PERMISSIVE: bad numbers become NULL."""
    cast = _caster(mode)
    n = F.floor(F.greatest(F.size(tokens) - 2, F.lit(0)) / 5).cast("int")

    def box(i: Column) -> Column:
        at = lambda j: F.try_element_at(tokens, i * 5 + j + 3)  # noqa: E731  (always in range for real boxes)
        return F.struct((i + 1).cast("int").alias("box_id"), cast(at(0), "int").alias("label"),
                        cast(at(1), "double").alias("x_min"), cast(at(2), "double").alias("y_min"),
                        cast(at(3), "double").alias("x_max"), cast(at(4), "double").alias("y_max"),
                        F.lit(1.0).alias("weight"))

    boxes = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), box)).otherwise(
        F.filter(F.array(box(F.lit(0))), lambda _: F.lit(False)))
    return F.struct(cast(F.element_at(tokens, 1), "bigint").alias("img_id"), F.element_at(tokens, 2).alias("path"),
                    boxes.alias("boxes"))


def scan_annotations(source, mode: str = "FAILFAST", spark: SparkSession | None = None,
                     value_col: str = "value") -> DataFrame:
    """Annotation text (path, or a DataFrame with a ``value`` column) -> one row per image.

    Each line is split once into a token column; the box structs then index
    that column (Spark does not share sub-expressions inside lambdas)."""
    if isinstance(source, DataFrame):
        df = source
    else:
        df = (spark or SparkSession.getActiveSession()).read.text(source)
    toks = df.select(F.split(F.trim(F.col(value_col)), " ").alias("__t")).filter(F.element_at("__t", 1) != "")
    return toks.select(parse_tokens(F.col("__t"), mode).alias("__a")).select("__a.*")


def explode_boxes(images: DataFrame, keep: tuple[str, ...] = ("img_id",)) -> DataFrame:
    """Nested form -> one row per box."""
    return images.select(*keep, F.explode("boxes").alias("__b")).select(*keep, *[f"__b.{f}" for f in BOX_FIELDS])


def format_annotation(img_id: Column, path: Column, boxes: Column) -> Column:
    """Inverse of :func:`parse_annotation` (integer coordinates)."""
    parts = F.transform(boxes, lambda b: F.concat_ws(
        " ", b["label"].cast("string"), *[b[c].cast("int").cast("string") for c in COORDS]))
    return F.concat_ws(" ", img_id.cast("string"), path, F.array_join(parts, " "))


def truth_table(annotations: DataFrame, dims: DataFrame, resize_w: int = 416, resize_h: int = 416,
                missing: str = "error") -> DataFrame:
    """Annotations joined to original image sizes, boxes rescaled to the input size.

    ``dims``: ``img_id, width, height`` (original sizes).  One row per box.  A box whose
    image has no size is an error (``missing="error"``), or is left out on request
    (``missing="drop"``)."""
    if missing not in ("error", "drop"):
        raise ValueError(missing)
    boxes = explode_boxes(annotations)
    size = dims.select("img_id", "width", "height")
    j = boxes.join(size, "img_id", "inner" if missing == "drop" else "left")
    if missing == "error":
        told = F.raise_error(F.concat(F.lit("no size for image "), F.col("img_id").cast("string"))).cast("int")
        j = j.withColumn("width", F.when(F.col("width").isNull(), told).otherwise(F.col("width")))
    return j.select("img_id", "box_id", "label",
                    (F.col("x_min") * resize_w / F.col("width")).alias("x_min"),
                    (F.col("y_min") * resize_h / F.col("height")).alias("y_min"),
                    (F.col("x_max") * resize_w / F.col("width")).alias("x_max"),
                    (F.col("y_max") * resize_h / F.col("height")).alias("y_max"))


def scan_class_names(path: str, spark: SparkSession | None = None) -> DataFrame:
    """One name per line, id = line number (0-based); trailing newline only is stripped."""
    whole = (spark or SparkSession.getActiveSession()).read.text(path, wholetext=True)
    lines = F.split(F.regexp_replace(F.col("value"), "\n$", ""), "\n")
    return whole.select(F.posexplode(lines).alias("label", "name")).select(F.col("label").cast("int"), "name")


def scan_anchors(path: str, spark: SparkSession | None = None) -> DataFrame:
    """Comma-separated ``w,h, w,h, ...`` -> ``(a_idx, aw, ah)``."""
    whole = (spark or SparkSession.getActiveSession()).read.text(path, wholetext=True)
    vals = F.transform(F.split(F.col("value"), ","), lambda v: F.trim(v).cast("double"))
    ex = whole.select(F.posexplode(vals).alias("pos", "v"))
    return (ex.groupBy((F.floor(F.col("pos") / 2)).cast("int").alias("a_idx"))
              .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("v"))).alias("aw"),
                   F.max(F.when(F.col("pos") % 2 == 1, F.col("v"))).alias("ah"))
              .orderBy("a_idx"))


def with_class_names(df: DataFrame, names: DataFrame) -> DataFrame:
    """Attach class names (a class-name table is tiny; AQE broadcasts it)."""
    return df.join(names, "label", "left")
