"""PASCAL-VOC evaluation for all classes in one plan.

Per class: detections ranked by score desc (then img_id, pred_id); a
detection is TP if its best same-class truth (VOC IoU, +1 on extents) has
IoU > t and it is the highest-ranked detection with that best truth.
precision(rank) = cumTP/rank; AP = sum over TP rows of max precision at this or
a later rank, divided by npos (the all-point area under the envelope);
11-point AP averages the max precision at recall >= 0, 0.1, .. 1.

With "two_pass" a class never has to fit in one task.  ``pr_curve`` takes ranks and running sums of all
detections from :func:`global_rank`.  ``voc_eval`` needs less: precision is highest, and recall grows, at true
positives only, so detections and true positives are laid out as one stream of events, scanned once in segments of
(class, score), and only the true positives and one summary row a segment are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxframe.operators.match import class_counts, flag_matches, true_positives
from boxframe.operators.match import unknown_images as images_without_truth
from boxframe.operators.ranking import SEGMENT, _before, global_rank, sort_cols, suffix_max, with_segments
from boxframe.session import cut_lineage

RANK_ORDER = [("score", False), ("img_id", True), ("pred_id", True)]
# Recall levels of the 11-point metric, as NumPy's arange(0, 1.1, 0.1) yields them.
ELEVEN_POINTS = [i * 0.1 for i in range(11)]
ROUND = 9


def pr_curve(det: DataFrame, truth: DataFrame, iou_threshold: float = 0.5, *,
             rank_strategy: str = "two_pass", npos: DataFrame | None = None) -> DataFrame:
    """One row per detection with ``rank, tp, cum_tp, precision, recall, envelope``."""
    flagged = flag_matches(det, truth, iou_threshold, by_label=True, variant="voc").select("img_id", "pred_id", "label", "score", "tp")
    ranked = global_rank(flagged, ["label"], RANK_ORDER, {"cum_tp": F.col("tp")}, strategy=rank_strategy)
    npos = npos if npos is not None else class_counts(truth, name="npos")
    npos = npos.select(F.col("label").alias("__nl"), F.col("npos").alias("npos"))  # fresh ids: joined twice
    ranked = (ranked.join(npos, ranked["label"] == npos["__nl"], "left")  # AQE broadcasts it after sizing it
                    .drop("__nl"))
    ranked = (ranked.withColumn("precision", F.col("cum_tp") / F.col("rank"))
                    .withColumn("recall", F.try_divide(F.col("cum_tp").cast("double"), F.col("npos"))))
    return suffix_max(ranked, ["label"], RANK_ORDER, F.col("precision"), "envelope", strategy=rank_strategy)


def true_positive_curve(det: DataFrame, truth: DataFrame, iou_threshold: float, npos: DataFrame, *,
                        segments: int | None = None) -> tuple[DataFrame, DataFrame]:
    """W1-W4 at the true positives: ``label, rank, cum_tp, precision, recall, envelope``; and ``label, nd, tp``.

    A true positive is an event of its own right after its detection, so no join brings the two together; an event
    counts the detections and true positives up to itself.  One exchange by (class, segment), one checkpoint."""
    key = ["label", "score", "img_id", "pred_id"]
    plain = det.select(*key)
    events = plain.withColumn("tp", F.lit(0)).unionByName(true_positives(det, truth, iou_threshold).select(*key, F.lit(1).alias("tp")))
    events = with_segments(events, ["label"], RANK_ORDER, segments, sample_from=plain)
    part = Window.partitionBy("label", SEGMENT)
    run = part.orderBy(*sort_cols(RANK_ORDER), F.col("tp")).rowsBetween(Window.unboundedPreceding, 0)
    one = F.lit(1) - F.col("tp")
    seen = events.select("label", SEGMENT, "tp", F.row_number().over(part.orderBy(*sort_cols(RANK_ORDER), F.col("tp"))).alias("rn"),
                         F.sum(one).over(run).alias("n"), F.sum("tp").over(run).alias("c"),
                         F.sum(one).over(part).alias("seg_n"), F.sum("tp").over(part).alias("seg_c"))
    kept = cut_lineage(seen.filter((F.col("tp") == 1) | (F.col("rn") == 1)))
    per = kept.filter("rn = 1").select("label", SEGMENT, "seg_n", "seg_c")
    offsets = _before(per, ["label"], ["seg_n", "seg_c"])
    hits = (kept.filter("tp = 1").join(offsets, ["label", SEGMENT])
            .select("label", SEGMENT, (F.col("__off_seg_n") + F.col("n")).alias("rank"), (F.col("__off_seg_c") + F.col("c")).alias("cum_tp"))
            .join(npos.select("label", "npos"), "label", "left"))
    hits = hits.select("label", SEGMENT, "rank", "cum_tp", (F.col("cum_tp") / F.col("rank")).alias("precision"),
                       F.try_divide(F.col("cum_tp").cast("double"), F.col("npos")).alias("recall"))
    curve = suffix_max(hits, ["label"], [("rank", True)], F.col("precision"), "envelope", strategy="two_pass")
    totals = per.groupBy("label").agg(F.sum("seg_n").alias("nd"), F.sum("seg_c").alias("tp"))
    return curve.drop(SEGMENT), totals


def voc_eval(det: DataFrame, truth: DataFrame, iou_threshold: float = 0.5, use_07_metric: bool = False, *,
             rank_strategy: str = "two_pass", parity: bool = False,
             unknown_images: str = "fp") -> DataFrame:
    """Per class: ``label, npos, nd, tp, recall, precision, ap``.

    Classes present in the truth or the detections.  No detections: nd = 0,
    recall = precision = ap = 0 (``parity=True`` also reports npos = nd = 1e-6
    as the studied code does).  No truth: recall and ap are NULL.  Detections on images
    without any truth are false positives (``unknown_images="fp"``) or an error
    (``"error"``, as in the studied code)."""
    if unknown_images not in ("fp", "error"):
        raise ValueError(unknown_images)
    if unknown_images == "error":
        stray = images_without_truth(det, truth).select("img_id").first()
        if stray is not None:
            raise KeyError(f"image {stray.img_id} has detections but no truth")
    npos = class_counts(truth, name="npos")
    if rank_strategy == "two_pass":
        curve, totals = true_positive_curve(det, truth, iou_threshold, npos)
    else:
        every = pr_curve(det, truth, iou_threshold, rank_strategy=rank_strategy, npos=npos)
        curve, totals = every.filter("tp = 1"), every.groupBy("label").agg(F.count(F.lit(1)).alias("nd"), F.sum("tp").alias("tp"))
    aggs = [F.sum("envelope").alias("env_sum")]
    if use_07_metric:
        aggs += [F.max(F.when(F.col("recall") >= F.lit(t), F.col("precision"))).alias(f"p{i}")
                 for i, t in enumerate(ELEVEN_POINTS)]
    per = totals.join(curve.groupBy("label").agg(*aggs), "label", "left")
    j = npos.join(per, "label", "full")
    n_pos = F.coalesce(F.col("npos"), F.lit(0)).cast("bigint")
    n_d = F.coalesce(F.col("nd"), F.lit(0)).cast("bigint")
    n_tp = F.coalesce(F.col("tp"), F.lit(0)).cast("bigint")
    has_pos = F.coalesce(F.col("npos"), F.lit(0)) > 0
    recall = F.when(has_pos, n_tp / n_pos)
    precision = F.when(n_d > 0, n_tp / n_d).otherwise(F.lit(0.0))
    if use_07_metric:
        ap = F.lit(0.0)
        for i in range(len(ELEVEN_POINTS)):
            ap = ap + F.coalesce(F.col(f"p{i}"), F.lit(0.0)) / F.lit(11.0)
        ap = F.when(has_pos, F.when(n_d > 0, ap).otherwise(F.lit(0.0)))
    else:
        ap = F.when(has_pos, F.when(n_d > 0, F.coalesce(F.col("env_sum"), F.lit(0.0)) / n_pos)
                    .otherwise(F.lit(0.0)))
    out = j.select("label", n_pos.alias("npos"), n_d.alias("nd"), n_tp.alias("tp"),
                   recall.alias("recall"), precision.alias("precision"),
                   F.round(ap, ROUND).alias("ap"))
    if parity:
        none = F.col("nd") == 0
        out = out.select("label",
                         F.when(none, F.lit(1e-6)).otherwise(F.col("npos").cast("double")).alias("npos"),
                         F.when(none, F.lit(1e-6)).otherwise(F.col("nd").cast("double")).alias("nd"),
                         "tp", "recall", "precision", "ap")
    return out


def voc_ap_11pt(det: DataFrame, truth: DataFrame, iou_threshold: float = 0.5, **kw) -> DataFrame:
    """The VOC2007 11-point AP per class."""
    return voc_eval(det, truth, iou_threshold, use_07_metric=True, **kw)


def voc_summary(per_class: DataFrame, *, include_truthless: bool = False) -> DataFrame:
    """mAP (plain mean of AP), recall pooled by npos, precision pooled by nd."""
    pc = per_class if include_truthless else per_class.filter(F.col("ap").isNotNull())
    return pc.agg(
        F.round(F.avg(F.coalesce(F.col("ap"), F.lit(0.0))), ROUND).alias("map"),
        F.round(F.try_divide(F.sum(F.col("recall") * F.col("npos")), F.sum(F.col("npos")).cast("double")),
                ROUND).alias("recall"),
        F.round(F.try_divide(F.sum(F.col("precision") * F.col("nd")), F.sum(F.col("nd")).cast("double")),
                ROUND).alias("precision"),
        F.count(F.lit(1)).alias("n_classes"))
