"""Registered queries: box geometry, anchors, targets, decode, sources, matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxframe.config import DEFAULT_ANCHORS, parse_anchor_string
from boxframe.functions.boxes import (COORDS, box_area, crop_box, crop_keep, flip_box, iou, rescale_box, shift_box,
                                     to_center)
from boxframe.operators.assign import assign_anchors, class_mask, encode_targets
from boxframe.operators.decode import decode, predict_boxes, to_detections, with_argmax
from boxframe.operators.match import class_counts, evaluate_matches, merge_counts
from boxframe.operators.nms import nms
from boxframe.operators.spatial import overlap_self_join
from boxframe.plans import oracle_sql as osql
from boxframe.plans.catalog import register
from boxframe.session import computed_once, stored
from boxframe.sources.annotations import explode_boxes, format_annotation, scan_annotations, truth_table

ANCHORS = parse_anchor_string(DEFAULT_ANCHORS)
R = 9  # rounding of derived doubles in both engines


def _box(prefix=""):
    return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in COORDS])


# --- B1/B3/B4: IoU variants between a detection and the truth it was made from -------------

_IOU_SQL = osql.with_views("pred") + f"""
SELECT p.img_id, p.pred_id, t.box_id,
       {osql._iou_sql('p.', 't.', 'eps')} AS iou_eps,
       {osql._iou_sql('p.', 't.', 'plain')} AS iou_plain,
       {osql._iou_sql('p.', 't.', 'voc')} AS iou_voc,
       {osql._iou_sql('p.', 't.', 'py')} AS iou_py,
       {osql._iou_sql('p.', 't.', 'tf')} AS iou_tf,
       (p.x_max - p.x_min) * (p.y_max - p.y_min) AS area,
       (t.x_min + t.x_max) / 2 AS t_cx, (t.y_min + t.y_max) / 2 AS t_cy
FROM pred p JOIN gt t ON t.img_id = p.img_id AND t.box_id = p.pred_id // 10"""


@register("box_iou", _IOU_SQL)
def q_box_iou(t):
    """B1, B3, B4a-e: every IoU variant between each detection and its source truth."""
    p = t.pred.withColumn("box_id", F.floor(F.col("pred_id") / 10).cast("int"))
    g = t.gt.select("img_id", "box_id", *[F.col(c).alias(f"t_{c}") for c in COORDS])
    j = p.join(g, ["img_id", "box_id"])
    a, b = _box(), _box("t_")
    c = to_center(b)
    return j.select("img_id", "pred_id", "box_id",
                    *[iou(a, b, v).alias(f"iou_{v}") for v in ("eps", "plain", "voc", "py", "tf")],
                    box_area(a).alias("area"), c["cx"].alias("t_cx"), c["cy"].alias("t_cy"))


# --- J1 + B9: anchor assignment; G1: target fold ------------------------------------------

def _anchor_list_sql() -> str:
    return "[" + ", ".join(f"{{'aw': CAST({w} AS DOUBLE), 'ah': CAST({h} AS DOUBLE)}}" for w, h in ANCHORS) + "]"


_ASSIGN_CTE = f"""
asg_base AS (
  SELECT g.img_id, g.box_id, g.label, i.width, i.height,
         (g.x_min + g.x_max) / 2 AS cx, (g.y_min + g.y_max) / 2 AS cy,
         g.x_max - g.x_min AS w, g.y_max - g.y_min AS h
  FROM gt g JOIN img i ON i.img_id = g.img_id),
asg_iou AS (
  SELECT *, list_transform({_anchor_list_sql()}, lambda a:
             least(w, a.aw) * least(h, a.ah) / (w * h + a.aw * a.ah - least(w, a.aw) * least(h, a.ah) + CAST(1e-10 AS DOUBLE))) AS ious
  FROM asg_base),
asg AS (
  SELECT img_id, box_id, label, width, height, cx, cy, w, h,
         CAST(list_position(ious, list_max(ious)) - 1 AS INT) AS a_idx, list_max(ious) AS anchor_iou
  FROM asg_iou),
asg_cell AS (
  SELECT *, CAST(2 - a_idx // 3 AS INT) AS scale,
         CASE WHEN a_idx // 3 = 2 THEN 32 WHEN a_idx // 3 = 1 THEN 16 ELSE 8 END AS stride,
         CAST(a_idx % 3 AS INT) AS k
  FROM asg),
asg_out AS (
  SELECT *, CAST(least(greatest(floor(cx / stride), 0), floor(width / stride) - 1) AS INT) AS gx,
            CAST(least(greatest(floor(cy / stride), 0), floor(height / stride) - 1) AS INT) AS gy
  FROM asg_cell)"""


def _assigned(t):
    g = t.gt.join(t.img, "img_id")
    return assign_anchors(g, ANCHORS, img_w=F.col("width"), img_h=F.col("height"))


@register("assign_anchors", osql.with_views("gt", extra=_ASSIGN_CTE) +
          "SELECT img_id, box_id, a_idx, anchor_iou, scale, k, gx, gy FROM asg_out")
def q_assign_anchors(t):
    """J1 + B9: best anchor by size-only IoU (first on ties), its scale, slot and clamped cell."""
    return _assigned(t).select("img_id", "box_id", "a_idx", "anchor_iou",
                               "scale", "k", "gx", "gy")


@register("encode_targets", osql.with_views("gt", extra=_ASSIGN_CTE) + """
SELECT img_id, scale, gy, gx, k,
       arg_max(cx, box_id) AS cx, arg_max(cy, box_id) AS cy, arg_max(w, box_id) AS w, arg_max(h, box_id) AS h,
       CAST(1.0 AS DOUBLE) AS weight, CAST(sum(DISTINCT (1 << label)) AS BIGINT) AS class_mask,
       count(*) AS n_boxes
FROM asg_out GROUP BY img_id, scale, gy, gx, k""")
def q_encode_targets(t):
    """G1: sparse grid targets, last box wins the geometry, classes OR-ed (cell collisions)."""
    tg = encode_targets(_assigned(t))
    return tg.select("img_id", "scale", "gy", "gx", "k", "cx", "cy", "w", "h", "weight",
                     class_mask(F.col("classes")).alias("class_mask"), "n_boxes")


# --- B5-B8: box transforms on nested box arrays ---------------------------------------------

_TRANSFORM_SQL = osql.with_views("gt") + f"""
SELECT g.img_id, g.box_id, g.label,
       CASE WHEN g.img_id % 2 = 0 THEN i.width - g.x_max ELSE g.x_min END AS f_x_min,
       CASE WHEN g.img_id % 3 = 0 THEN i.height - g.y_max ELSE g.y_min END AS f_y_min,
       CASE WHEN g.img_id % 2 = 0 THEN i.width - g.x_min ELSE g.x_max END AS f_x_max,
       CASE WHEN g.img_id % 3 = 0 THEN i.height - g.y_min ELSE g.y_max END AS f_y_max,
       g.x_min + (g.img_id * 7) % i.width AS e_x_min, g.y_min + (g.img_id * 11) % i.height AS e_y_min,
       g.x_max + (g.img_id * 7) % i.width AS e_x_max, g.y_max + (g.img_id * 11) % i.height AS e_y_max,
       g.x_min / i.width * 416 AS r_x_min, g.y_min / i.height * 416 AS r_y_min,
       g.x_max / i.width * 416 AS r_x_max, g.y_max / i.height * 416 AS r_y_max
FROM gt g JOIN img i ON i.img_id = g.img_id"""


@register("box_transforms", _TRANSFORM_SQL)
def q_box_transforms(t):
    """B5 rescale to 416, B6 flip (h: even ids, v: ids divisible by 3), B7 expand offsets.

    Row form: each box joined to its image size (a hot image is just many rows)."""
    g = t.gt.join(t.img, "img_id")
    w, h = F.col("width"), F.col("height")
    b = _box()
    f = flip_box(b, w, h, F.col("img_id") % 2 == 0, F.col("img_id") % 3 == 0)
    e = shift_box(b, (F.col("img_id") * 7) % w, (F.col("img_id") * 11) % h)
    r = rescale_box(b, w, h, F.lit(416), F.lit(416))
    return g.select("img_id", "box_id", "label", *[f[c].alias(f"f_{c}") for c in COORDS],
                    *[e[c].alias(f"e_{c}") for c in COORDS], *[r[c].alias(f"r_{c}") for c in COORDS])


_CROP_SQL = osql.with_views("gt") + """
, win AS (SELECT img_id, CAST(width // 4 AS DOUBLE) AS l, CAST(height // 4 AS DOUBLE) AS t,
                 CAST(width // 4 + width // 2 AS DOUBLE) AS r, CAST(height // 4 + height // 2 AS DOUBLE) AS b FROM img),
c AS (
  SELECT g.img_id, g.box_id, g.label,
         greatest(g.x_min, w.l) - w.l AS x_min, greatest(g.y_min, w.t) - w.t AS y_min,
         least(g.x_max, w.r) - w.l AS x_max, least(g.y_max, w.b) - w.t AS y_max
  FROM gt g JOIN win w ON w.img_id = g.img_id
  WHERE w.l <= (g.x_min + g.x_max) / 2 AND (g.x_min + g.x_max) / 2 < w.r
    AND w.t <= (g.y_min + g.y_max) / 2 AND (g.y_min + g.y_max) / 2 < w.b)
SELECT * FROM c WHERE x_min < x_max AND y_min < y_max"""


@register("crop_boxes", _CROP_SQL)
def q_crop_boxes(t):
    """Crop to the centre half of each image, centre test on, empty boxes dropped (row form)."""
    g = t.gt.join(t.img, "img_id")
    win = (F.floor(F.col("width") / 4), F.floor(F.col("height") / 4),
           F.floor(F.col("width") / 2), F.floor(F.col("height") / 2))
    c = crop_box(_box(), *win)
    return (g.filter(crop_keep(_box(), *win, allow_outside_center=False))
             .select("img_id", "box_id", "label", *[c[x].alias(x) for x in COORDS]))


# --- B10-B14: decode a feature map (embedding, three times over = one 1x8 grid, 3 anchors, 5+3 channels) ------

_DECODE_SQL = osql.with_views("cellmap") + """
, slots AS (
  SELECT img_id, pos // 8 AS slot,
         max(CASE WHEN pos % 8 = 0 THEN logit END) AS tx, max(CASE WHEN pos % 8 = 1 THEN logit END) AS ty,
         max(CASE WHEN pos % 8 = 2 THEN logit END) AS tw, max(CASE WHEN pos % 8 = 3 THEN logit END) AS th,
         max(CASE WHEN pos % 8 = 4 THEN logit END) AS tc, max(CASE WHEN pos % 8 = 5 THEN logit END) AS t0,
         max(CASE WHEN pos % 8 = 6 THEN logit END) AS t1, max(CASE WHEN pos % 8 = 7 THEN logit END) AS t2
  FROM cellmap GROUP BY img_id, pos // 8),
geo AS (
  SELECT img_id, CAST(slot AS INT) AS slot, CAST((slot // 3) // 8 AS INT) AS gy, CAST((slot // 3) % 8 AS INT) AS gx,
         CAST(slot % 3 AS INT) AS k,
         (1.0 / (1.0 + exp(-tx)) + (slot // 3) % 8) * 256 / 8 AS cx,
         (1.0 / (1.0 + exp(-ty)) + (slot // 3) // 8) * 32 / 1 AS cy,
         exp(tw) * CASE slot % 3 WHEN 0 THEN 261.0 WHEN 1 THEN 350.0 ELSE 448.0 END AS w,
         exp(th) * CASE slot % 3 WHEN 0 THEN 239.0 WHEN 1 THEN 263.0 ELSE 385.0 END AS h,
         1.0 / (1.0 + exp(-tc)) AS conf,
         [1.0 / (1.0 + exp(-t0)), 1.0 / (1.0 + exp(-t1)), 1.0 / (1.0 + exp(-t2))] AS probs
  FROM slots)
SELECT img_id, slot, gy, gx, k, CAST(u.i - 1 AS INT) AS label,
       round(conf * probs[u.i], 6) AS score,
       round(cx - w / 2, 6) AS x_min, round(cy - h / 2, 6) AS y_min,
       round(cx + w / 2, 6) AS x_max, round(cy + h / 2, 6) AS y_max,
       CAST(list_position(probs, list_max(probs)) - 1 AS INT) AS best_label
FROM geo CROSS JOIN (SELECT unnest([1, 2, 3]) AS i) u"""


def _featmaps(t, vectors=None, key="vec_id"):
    """One 1x8 output map (scale 0) per vector, whose values come three times; logits scaled by 8, input 256x32."""
    return (t.embeddings if vectors is None else vectors).select(
        F.col(key).alias("img_id"), F.lit(0).alias("scale"), F.lit(1).alias("grid_h"), F.lit(8).alias("grid_w"),
        F.transform(F.concat("embedding", "embedding", "embedding"), lambda v: v.cast("double") * 8).alias("values"))


@register("decode", _DECODE_SQL)
def q_decode(t):
    """Slots -> centre/size -> corners, class scores conf*prob, argmax label."""
    slots = with_argmax(predict_boxes(decode(_featmaps(t), 3, ANCHORS, img_w=256, img_h=32)))
    det = (slots.select("img_id", "slot", "gy", "gx", "k", "best_label", *COORDS,
                        F.posexplode(F.transform("probs", lambda p: p * F.col("conf"))).alias("label", "score")))
    return det.select("img_id", "slot", "gy", "gx", "k", F.col("label").cast("int").alias("label"),
                      F.round("score", 6).alias("score"), *[F.round(c, 6).alias(c) for c in COORDS], "best_label")


# --- S1 / S10: annotation text ---------------------------------------------------------------

def _ann_lines(t):
    """Multi-box annotation lines built from the truth table (one line per image)."""
    n = t.gt.groupBy("img_id").agg(F.sort_array(F.collect_list(F.struct("box_id", "label", *COORDS))).alias("boxes"))
    return n.select(format_annotation(F.col("img_id"), F.concat(F.lit("img/"), F.col("img_id").cast("string"),
                                                                F.lit(".png")), F.col("boxes")).alias("value"))


@register("scan_annotations", osql.with_views("gt") + """
SELECT img_id, 'img/' || CAST(img_id AS VARCHAR) || '.png' AS path,
       CAST(row_number() OVER (PARTITION BY img_id ORDER BY box_id) AS INT) AS box_id, label,
       x_min, y_min, x_max, y_max, CAST(1.0 AS DOUBLE) AS weight
FROM gt""")
def q_scan_annotations(t):
    """Parse multi-box annotation lines (whole lines) into one row per box."""
    ann = scan_annotations(_ann_lines(t))
    return explode_boxes(ann, keep=("img_id", "path"))


@register("truth_table", osql.with_views("gt") + f"""
SELECT g.img_id, CAST(row_number() OVER (PARTITION BY g.img_id ORDER BY g.box_id) AS INT) AS box_id, g.label,
       CAST(g.x_min AS INT) * 416 / i.width AS x_min, CAST(g.y_min AS INT) * 416 / i.height AS y_min,
       CAST(g.x_max AS INT) * 416 / i.width AS x_max, CAST(g.y_max AS INT) * 416 / i.height AS y_max
FROM gt g JOIN img i ON i.img_id = g.img_id""")
def q_truth_table(t):
    """Annotation lines of all boxes joined to image sizes, rescaled to 416x416."""
    return truth_table(scan_annotations(_ann_lines(t)), t.img, 416, 416)


# --- G2 / G3 / G4 / J10 -------------------------------------------------------------------------

@register("class_counts", osql.with_views("gt") + "SELECT label, count(*) AS n FROM gt GROUP BY label")
def q_class_counts(t):
    """Truth boxes per class."""
    return class_counts(t.gt)


@register("merge_counts", osql.with_views("pred") + """
SELECT label, CAST(sum(n_true) AS BIGINT) AS n_true, CAST(sum(n_pred) AS BIGINT) AS n_pred FROM (
  SELECT label, count(*) AS n_true, 0 AS n_pred FROM gt GROUP BY label
  UNION ALL SELECT label, 0, count(*) FROM pred GROUP BY label) u GROUP BY label""")
def q_merge_counts(t):
    """Partial per-class count tables added up."""
    return merge_counts([class_counts(t.gt, name="n_true"), class_counts(t.pred, name="n_pred")])


_EVAL_TMPL = """,
ev_pairs AS (
  SELECT d.img_id, d.pred_id, d.label, d.score, t.box_id, t.label AS t_label, {ov} AS ov
  FROM nms_out d LEFT JOIN {truth} t ON t.img_id = d.img_id),
ev_best AS (
  SELECT * FROM ev_pairs QUALIFY row_number() OVER (PARTITION BY img_id, label, pred_id ORDER BY ov DESC NULLS LAST, box_id) = 1),
ev_claim AS (
  SELECT * FROM ev_best WHERE ov > 0.5 AND t_label = label
  QUALIFY row_number() OVER (PARTITION BY img_id, box_id ORDER BY score DESC, pred_id) = 1),
ev_tp AS (SELECT label, count(*) AS n_tp FROM ev_claim GROUP BY label),
ev_pred AS (SELECT label, count(*) AS n_pred FROM nms_out GROUP BY label),
ev_true AS (SELECT label, count(*) AS n_true FROM {truth} GROUP BY label),
ev AS (
  SELECT coalesce(t.label, p.label) AS label, CAST(coalesce(t.n_true, 0) AS BIGINT) AS n_true,
         CAST(coalesce(p.n_pred, 0) AS BIGINT) AS n_pred, CAST(coalesce(x.n_tp, 0) AS BIGINT) AS n_tp
  FROM ev_true t FULL OUTER JOIN ev_pred p ON p.label = t.label LEFT JOIN ev_tp x ON x.label = coalesce(t.label, p.label))
""".replace("{ov}", osql._iou_sql("d.", "t.", "eps"))


def _eval_cte(truth: str = "gt") -> str:
    return _EVAL_TMPL.replace("{truth}", truth)


_EVAL_CTE = osql.nms_sql("pred") + _eval_cte("gt")


@register("evaluate_matches", osql.with_views("pred", extra=_EVAL_CTE) + "SELECT * FROM ev")
def q_evaluate_matches(t):
    """G3 (per class): after NMS, best truth over all classes (eps IoU), distinct claimed truths."""
    return evaluate_matches(_kept(t), t.gt, 0.5, per_class=True)


@register("evaluate_batch", osql.with_views("pred", extra=_EVAL_CTE) + """
SELECT n_true, n_pred, n_tp, n_tp / (n_true + CAST(1e-6 AS DOUBLE)) AS recall,
       n_tp / (n_pred + CAST(1e-6 AS DOUBLE)) AS precision
FROM (SELECT CAST(sum(n_true) AS BIGINT) AS n_true, CAST(sum(n_pred) AS BIGINT) AS n_pred,
             CAST(sum(n_tp) AS BIGINT) AS n_tp FROM ev)""")
def q_evaluate_batch(t):
    """G3 (calc_now): pooled recall = TP/(truth+1e-6), precision = TP/(pred+1e-6)."""
    return evaluate_matches(_kept(t), t.gt, 0.5, per_class=False)


@register("overlap_pairs", osql.with_views("pred") + f"""
SELECT a.img_id, a.label, a.pred_id AS a_id, b.pred_id AS b_id, {osql._iou_sql('a.', 'b.', 'tf')} AS iou
FROM pred a JOIN pred b ON a.img_id = b.img_id AND a.label = b.label AND a.pred_id < b.pred_id
WHERE {osql._iou_sql('a.', 'b.', 'tf')} > 0.5""")
def q_overlap_pairs(t):
    """Pairs in one image and class with IoU > 0.5 (grid join, never all pairs)."""
    p = t.pred.select("img_id", "label", "pred_id", *COORDS)
    j = overlap_self_join(p, ["img_id", "label"], normalise=True, before="pred_id")
    j = j.select("img_id", "label", F.col("a_pred_id").alias("a_id"), F.col("b_pred_id").alias("b_id"),
                 iou(_box("a_"), _box("b_"), "tf").alias("iou"))
    return computed_once(j, ["img_id", "label", "a_id", "b_id"]).filter("iou > 0.5")


def _kept(t):
    return stored(nms(t.pred.select(*osql_det_cols()), 0.5, 0.5, 50))


def osql_det_cols():
    return ("img_id", "label", "pred_id", "score", *COORDS)


# --- Q8: evaluation against the truth read back from the target grid ---------------------------

from boxframe.operators.assign import grid_truth  # noqa: E402

_GRID_TRUTH_CTE = _ASSIGN_CTE + """,
gtg AS (
  SELECT img_id, CAST(((CAST(scale AS BIGINT) * 1000000 + gy) * 1000000 + gx) * 3 + k AS BIGINT) AS box_id,
         CAST(CASE WHEN mask & 1 <> 0 THEN 0 WHEN mask & 2 <> 0 THEN 1 ELSE 2 END AS INT) AS label,
         cx - w / 2 AS x_min, cy - h / 2 AS y_min, cx + w / 2 AS x_max, cy + h / 2 AS y_max
  FROM (SELECT img_id, scale, gy, gx, k, arg_max(cx, box_id) AS cx, arg_max(cy, box_id) AS cy,
               arg_max(w, box_id) AS w, arg_max(h, box_id) AS h, CAST(sum(DISTINCT (1 << label)) AS BIGINT) AS mask
        FROM asg_out GROUP BY img_id, scale, gy, gx, k) z)"""


@register("evaluate_grid_truth", osql.with_views("pred", extra=_GRID_TRUTH_CTE + "," + osql.nms_sql("pred")
                                                  + _eval_cte("gtg")) + "SELECT * FROM ev")
def q_evaluate_grid_truth(t):
    """G3 with truth="grid" (Q8): truth boxes rebuilt from the encoded targets, so collided boxes are lost."""
    truth = grid_truth(encode_targets(_assigned(t)))
    return evaluate_matches(_kept(t), truth, 0.5, per_class=True)


# --- E3: inference post-processing, decode -> class scores -> score mask -> NMS ---------------------

_DECODE_DET_CTE = _DECODE_SQL.split("SELECT img_id, slot, gy, gx, k, CAST(u.i - 1 AS INT) AS label,")[0].replace(
    osql.with_views("cellmap"), "").lstrip().lstrip(",") + """,
dec_det AS (
  SELECT img_id, CAST(u.i - 1 AS INT) AS label, CAST(slot AS INT) AS pred_id, round(conf * probs[u.i], 6) AS score,
         round(cx - w / 2, 6) AS x_min, round(cy - h / 2, 6) AS y_min,
         round(cx + w / 2, 6) AS x_max, round(cy + h / 2, 6) AS y_max
  FROM geo CROSS JOIN (SELECT unnest([1, 2, 3]) AS i) u)"""


@register("decode_nms", osql.with_views("cellmap", extra=_DECODE_DET_CTE + "," + osql.nms_sql("dec_det", score_t=0.3))
          + "SELECT * FROM nms_out")
def q_decode_nms(t):
    """B10-B14 + F1 + K2: feature maps to final detections (scores and corners rounded to 6 places)."""
    return _decoded(_featmaps(t))


def _decoded(maps):
    """Final detections of feature maps.  Rounded scores are masked before a slot's classes become rows; a map's
    slots bound a group, so no sizes are counted."""
    det = to_detections(predict_boxes(decode(maps, 3, ANCHORS, img_w=256, img_h=32)), 0.3, digits=6)
    det = det.select("img_id", "label", F.col("pred_id").cast("int").alias("pred_id"), "score", *[F.round(c, 6).alias(c) for c in COORDS])
    # out of a generator: the filters of the suppression read the rounded corners and do not decode and round a slot again
    return nms(computed_once(det, ["img_id", "label", "pred_id"]), 0.5, None, 50, "tf", strategy="fold")


# --- E4: feature maps to VOC -------------------------------------------------------------------

_DECODE_TRUTH_CTE = """,
dec_truth AS (
  SELECT g.img_id, g.box_id, g.label, g.x_min * 256 / i.width AS x_min, g.y_min * 32 / i.height AS y_min,
         g.x_max * 256 / i.width AS x_max, g.y_max * 32 / i.height AS y_max
  FROM gt g JOIN img i ON i.img_id = g.img_id)"""
_IMAGE_DET_CTE = """,
vec_det AS (SELECT img_id AS vec_id, label, pred_id, score, x_min, y_min, x_max, y_max FROM nms_out),
img_det AS (
  SELECT i.img_id, v.label, v.pred_id, v.score, v.x_min, v.y_min, v.x_max, v.y_max
  FROM img i JOIN vec_det v ON v.vec_id = i.img_id % (SELECT count(*) FROM embeddings))"""


@register("decode_voc", osql.with_views("cellmap", "gt", extra=_DECODE_DET_CTE + "," + osql.nms_sql("dec_det", score_t=0.3) + _IMAGE_DET_CTE
                                        + _DECODE_TRUTH_CTE + "," + osql.voc_sql("img_det", "dec_truth", 0.1)) + "SELECT * FROM voc_cls")
def q_decode_voc(t):
    """Feature maps of all images -> detections (a slot may stay under several classes) -> NMS -> VOC at IoU 0.1."""
    from boxframe.operators.voc import voc_eval
    g = t.gt.join(t.img, "img_id")
    truth = g.select("img_id", "box_id", "label", (F.col("x_min") * 256 / F.col("width")).alias("x_min"),
                     (F.col("y_min") * 32 / F.col("height")).alias("y_min"), (F.col("x_max") * 256 / F.col("width")).alias("x_max"),
                     (F.col("y_max") * 32 / F.col("height")).alias("y_max"))
    maps = _featmaps(t, t.img_vec, "img_id")
    return voc_eval(stored(_decoded(maps)), truth, 0.1)
