"""Prediction <-> truth matching and per-class counting.

Detection table: ``img_id, pred_id, label, score, x_min..y_max`` with
``(img_id, label, pred_id)`` unique: one box kept under two classes is two detections.  Truth table: ``img_id, box_id, label, x_min..y_max``
with ``(img_id, box_id)`` unique.  Only overlapping pairs are ever formed
(:func:`overlap_join`), so a crowded image costs its real overlaps, not |P|x|T|.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.functions.boxes import COORDS, iou
from boxframe.operators.spatial import CELL, PAD_FOR_VARIANT, overlap_join
from boxframe.session import computed_once

DET_KEY = ("img_id", "label", "pred_id")


def best_truth(det: DataFrame, truth: DataFrame, *, by_label: bool, variant: str = "eps",
               cell: float = CELL, min_iou: float | None = None) -> DataFrame:
    """Add ``best_box_id``, ``best_iou`` and ``best_label`` to every detection.

    The best truth has the highest IoU among the image's truths (of the same
    class when ``by_label``), the lowest ``box_id`` on ties.  A detection that
    overlaps no truth gets NULLs (it can never be a true positive for a threshold >= 0).

    ``min_iou``: only report a best truth whose IoU exceeds it.  Matching only
    asks whether the best IoU is > t, and if it is, the best pair survives the
    filter (ties included), so the decision is unchanged while the per-detection
    aggregation sees only real matches.
    """
    best = _best(det, truth, by_label, variant, cell, min_iou).drop("score")
    return det.join(best, list(DET_KEY), "left")


def _best(det: DataFrame, truth: DataFrame, by_label: bool, variant: str, cell: float, min_iou: float | None) -> DataFrame:
    """Best truth of every detection that overlaps one (above ``min_iou``), with its score."""
    keys = ["img_id", "label"] if by_label else ["img_id"]
    a = det.select(*DET_KEY, F.col("score").alias("__score"), *[F.col(c).alias(f"a_{c}") for c in COORDS])
    extra = [] if by_label else [F.col("label").alias("b_label")]
    b = truth.select(*keys, F.col("box_id").alias("b_box_id"), *extra, *[F.col(c).alias(f"b_{c}") for c in COORDS])
    pairs = overlap_join(a, b, keys, pad=PAD_FOR_VARIANT[variant], cell=cell, normalise=(variant == "tf"))
    abox = F.struct(*[F.col(f"a_{c}").alias(c) for c in COORDS])
    bbox = F.struct(*[F.col(f"b_{c}").alias(c) for c in COORDS])
    blabel = F.col("b_label") if not by_label else F.col("label")
    scored = pairs.select(*DET_KEY, iou(abox, bbox, variant).alias("__ov"), "b_box_id",
                          blabel.alias("b_label"), "__score")
    if min_iou is not None:
        scored = computed_once(scored, list(DET_KEY))
        scored = scored.filter(F.col("__ov") > F.lit(float(min_iou)))
    return (scored.groupBy(*DET_KEY)
                  .agg(F.max(F.struct(F.col("__ov"), F.negative(F.col("b_box_id")).alias("__nb"),
                                      F.col("b_label"), F.col("__score"))).alias("__m"))
                  .select(*DET_KEY, F.col("__m.__ov").alias("best_iou"), F.negative(F.col("__m.__nb")).alias("best_box_id"),
                          F.col("__m.b_label").alias("best_label"), F.col("__m.__score").alias("score")))


def flag_matches(det: DataFrame, truth: DataFrame, iou_threshold: float, *, by_label: bool, variant: str = "eps",
                 cell: float = CELL) -> DataFrame:
    """Detections with ``tp`` = 1 on the one that claims each truth (:func:`best_truth` and
    :func:`match_winners` in one).  Scores travel with the overlapping pairs, so the
    detections themselves are joined once."""
    claim = _best(det, truth, by_label, variant, cell, iou_threshold)
    if not by_label:
        claim = claim.filter(F.col("best_label") == F.col("label"))
    return (det.join(_winners(claim).drop("score"), list(DET_KEY), "left").withColumn("tp", F.coalesce(F.col("tp"), F.lit(0))))


def _winners(claim: DataFrame) -> DataFrame:
    """Of the claimants of each truth, the one with the highest score, lowest ``pred_id`` on ties."""
    return (claim.groupBy("img_id", "label", "best_box_id")
                 .agg(F.min(F.struct(F.negative(F.col("score")).alias("__s"), F.col("pred_id"))).alias("__w"))
                 .select("img_id", "label", F.col("__w.pred_id").alias("pred_id"), F.lit(1).alias("tp"),
                         F.negative(F.col("__w.__s")).alias("score")))


def true_positives(det: DataFrame, truth: DataFrame, iou_threshold: float, *, variant: str = "voc",
                   cell: float = CELL) -> DataFrame:
    """``img_id, label, pred_id, score`` of the detections that claim a truth of their class; the others are not
    joined back."""
    return _winners(_best(det, truth, True, variant, cell, iou_threshold)).drop("tp")


def match_winners(matched: DataFrame, iou_threshold: float, *, same_label: bool = True) -> DataFrame:
    """Flag ``tp`` = 1 on the single detection that claims each truth.

    A detection claims its best truth if ``best_iou > t`` (and, for the
    cross-class match, the truth has the same label).  Among the claimants of a
    truth the highest score wins, lowest ``pred_id`` on ties (a min-aggregate,
    combined map-side, so a much-claimed truth is no hot group)."""
    claim = matched.filter(F.col("best_iou") > F.lit(float(iou_threshold)))
    if not same_label:
        claim = claim.filter(F.col("best_label") == F.col("label"))
    return (matched.join(_winners(claim).drop("score"), list(DET_KEY), "left")
                   .withColumn("tp", F.coalesce(F.col("tp"), F.lit(0))))


def class_counts(df: DataFrame, label_col: str = "label", name: str = "n") -> DataFrame:
    """Rows per class."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias(name))


def evaluate_matches(det: DataFrame, truth: DataFrame, iou_threshold: float = 0.5,
                     per_class: bool = True, group_cols: Sequence[str] = ()) -> DataFrame:
    """Batch recall/precision counts.

    Best truth over *all* classes of the image (eps IoU); TP = distinct truths
    claimed with IoU > t and equal label.  Per class: ``n_true, n_pred, n_tp``;
    with ``per_class=False`` one row with recall = TP/(truth+1e-6),
    precision = TP/(pred+1e-6).  ``group_cols`` (present on both tables, e.g. a
    step bucket derived from the image) evaluate several batches at once."""
    g = list(group_cols)
    flagged = flag_matches(det, truth, iou_threshold, by_label=False, variant="eps")
    tp = flagged.groupBy(*g, "label").agg(F.sum("tp").cast("bigint").alias("n_tp"),
                                          F.count(F.lit(1)).alias("n_pred"))
    nt = truth.groupBy(*g, "label").agg(F.count(F.lit(1)).alias("n_true"))
    out = (nt.join(tp, [*g, "label"], "full")
             .select(*g, "label", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                                    for c in ("n_true", "n_pred", "n_tp")]))
    if per_class:
        return out
    tot = out.groupBy(*g).agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n_true", "n_pred", "n_tp")])
    return tot.select("*",
                      (F.col("n_tp") / (F.col("n_true") + F.lit(1e-6))).alias("recall"),
                      (F.col("n_tp") / (F.col("n_pred") + F.lit(1e-6))).alias("precision"))


def merge_counts(dfs: Sequence[DataFrame], keys: Sequence[str] = ("label",)) -> DataFrame:
    """Add up partial count tables (union + sum; Spark combines map-side)."""
    u = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), dfs)
    vals = [c for c in u.columns if c not in keys]
    return u.groupBy(*keys).agg(*[F.sum(F.coalesce(F.col(c), F.lit(0))).cast("bigint").alias(c) for c in vals])


def unknown_images(det: DataFrame, truth: DataFrame) -> DataFrame:
    """Detections on images that have no truth entry (the studied code raises)."""
    return det.join(truth.select("img_id").distinct(), "img_id", "left_anti")
