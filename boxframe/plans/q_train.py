"""Registered queries: loss, schedules, meters, feed."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from boxframe.config import DEFAULT_ANCHORS, parse_anchor_string
from boxframe.operators.assign import assign_anchors, class_mask, encode_targets
from boxframe.operators.loss import detection_loss, l2_penalty
from boxframe.plans import oracle_sql as osql
from boxframe.plans.catalog import register
from boxframe.session import ensure_checkpoint_dir, stored

ANCHORS = parse_anchor_string(DEFAULT_ANCHORS)
# The loss fixture feeds a 64x32 input (grids 1x2, 2x4, 4x8), so anchors are scaled by 1/8.
LOSS_ANCHORS = tuple((w / 8, h / 8) for w, h in ANCHORS)
GRIDS = ((0, 1, 2), (1, 2, 4), (2, 4, 8))  # (scale, grid_h, grid_w)


def featmaps3(t, vectors=None):
    """Three output maps per image: value i of scale s = embedding[(i + 17 s) mod 64] * 8 of its vector."""
    maps = []
    for s, gh, gw in GRIDS:
        n = gh * gw * 3 * 8
        turns = F.flatten(F.array_repeat("embedding", -(-(n + 17 * s) // 64)))
        maps.append(F.struct(F.lit(s).alias("scale"), F.lit(gh).alias("grid_h"), F.lit(gw).alias("grid_w"),
                             F.slice(turns, 17 * s + 1, n).alias("values")))
    vectors = t.img_vec if vectors is None else vectors
    keep = [c for c in vectors.columns if c not in ("embedding", "width", "height")]
    scaled = vectors.select(*keep, F.transform("embedding", lambda v: v.cast("double") * 8).alias("embedding"))
    return (scaled.select(*keep, F.explode(F.array(*maps)).alias("m"))
             .select(*keep, "m.scale", "m.grid_h", "m.grid_w", "m.values"))


def loss_targets(t):
    """Truth of all images rescaled into the 64x32 input, assigned and folded."""
    g = t.gt.join(t.img, "img_id")
    g = g.select("img_id", "box_id", "label",
                 (F.col("x_min") / F.col("width") * 64).alias("x_min"), (F.col("y_min") / F.col("height") * 32).alias("y_min"),
                 (F.col("x_max") / F.col("width") * 64).alias("x_max"), (F.col("y_max") / F.col("height") * 32).alias("y_max"))
    return encode_targets(assign_anchors(g, LOSS_ANCHORS, img_w=F.lit(64), img_h=F.lit(32)))


def _anchor_sql(dim: int) -> str:
    return "[" + ", ".join(f"CAST({a[dim]!r} AS DOUBLE)" for a in LOSS_ANCHORS) + "]"


_LOSS_CTE = f"""
fm AS (
  SELECT e.img_id, g.scale, g.gh, g.gw, e.embedding
  FROM img_vec e CROSS JOIN (VALUES (0, 1, 2), (1, 2, 4), (2, 4, 8)) g(scale, gh, gw)),
fm_slots AS (SELECT img_id, scale, gh, gw, embedding, unnest(range(gh * gw * 3)) AS slot FROM fm),
raw AS (
  SELECT img_id, CAST(scale AS INT) AS scale, gh, gw, CAST(slot // 3 // gw AS INT) AS gy,
         CAST((slot // 3) % gw AS INT) AS gx, CAST(slot % 3 AS INT) AS k,
         CAST(embedding[((slot * 8 + 0 + 17 * scale) % 64) + 1] AS DOUBLE) * 8 AS tx,
         CAST(embedding[((slot * 8 + 1 + 17 * scale) % 64) + 1] AS DOUBLE) * 8 AS ty,
         CAST(embedding[((slot * 8 + 2 + 17 * scale) % 64) + 1] AS DOUBLE) * 8 AS tw,
         CAST(embedding[((slot * 8 + 3 + 17 * scale) % 64) + 1] AS DOUBLE) * 8 AS th,
         CAST(embedding[((slot * 8 + 4 + 17 * scale) % 64) + 1] AS DOUBLE) * 8 AS tc,
         CAST(embedding[((slot * 8 + 5 + 17 * scale) % 64) + 1] AS DOUBLE) * 8 AS t0,
         CAST(embedding[((slot * 8 + 6 + 17 * scale) % 64) + 1] AS DOUBLE) * 8 AS t1,
         CAST(embedding[((slot * 8 + 7 + 17 * scale) % 64) + 1] AS DOUBLE) * 8 AS t2
  FROM fm_slots),
sl AS (
  SELECT *, {_anchor_sql(0)}[(2 - scale) * 3 + k + 1] AS aw, {_anchor_sql(1)}[(2 - scale) * 3 + k + 1] AS ah,
         (1.0 / (1.0 + exp(-tx)) + gx) * 64 / gw AS cx, (1.0 / (1.0 + exp(-ty)) + gy) * 32 / gh AS cy
  FROM raw),
sl2 AS (SELECT *, exp(tw) * aw AS w, exp(th) * ah AS h FROM sl),
src AS (
  SELECT g.img_id, g.box_id, g.label, g.x_min / i.width * 64 AS x_min, g.y_min / i.height * 32 AS y_min,
         g.x_max / i.width * 64 AS x_max, g.y_max / i.height * 32 AS y_max
  FROM gt g JOIN img i ON i.img_id = g.img_id),
src2 AS (
  SELECT *, (x_min + x_max) / 2 AS cx, (y_min + y_max) / 2 AS cy, x_max - x_min AS w, y_max - y_min AS h FROM src),
src3 AS (
  SELECT *, list_transform(list_zip({_anchor_sql(0)}, {_anchor_sql(1)}), lambda a:
             least(w, a[1]) * least(h, a[2]) / (w * h + a[1] * a[2] - least(w, a[1]) * least(h, a[2]) + CAST(1e-10 AS DOUBLE))) AS ious
  FROM src2),
src4 AS (SELECT *, CAST(list_position(ious, list_max(ious)) - 1 AS INT) AS a_idx FROM src3),
src5 AS (
  SELECT *, CAST(2 - a_idx // 3 AS INT) AS scale,
         CASE WHEN a_idx // 3 = 2 THEN 32 WHEN a_idx // 3 = 1 THEN 16 ELSE 8 END AS stride,
         CAST(a_idx % 3 AS INT) AS k FROM src4),
src6 AS (
  SELECT *, CAST(least(greatest(floor(cx / stride), 0), floor(64 / stride) - 1) AS INT) AS gx,
            CAST(least(greatest(floor(cy / stride), 0), floor(32 / stride) - 1) AS INT) AS gy FROM src5),
tg AS (
  SELECT img_id, scale, gy, gx, k, arg_max(cx, box_id) AS t_cx, arg_max(cy, box_id) AS t_cy,
         arg_max(w, box_id) AS t_w, arg_max(h, box_id) AS t_h, CAST(1.0 AS DOUBLE) AS t_weight,
         CAST(sum(DISTINCT (1 << label)) AS BIGINT) AS t_mask
  FROM src6 GROUP BY img_id, scale, gy, gx, k),
best AS (
  SELECT s.img_id, s.scale, s.gy, s.gx, s.k,
         coalesce(max(
           greatest(least(s.cx + s.w / 2, t.t_cx + t.t_w / 2) - greatest(s.cx - s.w / 2, t.t_cx - t.t_w / 2), 0.0) *
           greatest(least(s.cy + s.h / 2, t.t_cy + t.t_h / 2) - greatest(s.cy - s.h / 2, t.t_cy - t.t_h / 2), 0.0) /
           (s.w * s.h + t.t_w * t.t_h -
            greatest(least(s.cx + s.w / 2, t.t_cx + t.t_w / 2) - greatest(s.cx - s.w / 2, t.t_cx - t.t_w / 2), 0.0) *
            greatest(least(s.cy + s.h / 2, t.t_cy + t.t_h / 2) - greatest(s.cy - s.h / 2, t.t_cy - t.t_h / 2), 0.0)
            + CAST(1e-10 AS DOUBLE))), 0.0) AS best_iou
  FROM sl2 s LEFT JOIN tg t ON t.img_id = s.img_id AND t.scale = s.scale
  GROUP BY s.img_id, s.scale, s.gy, s.gx, s.k),
j AS (
  SELECT s.*, b.best_iou, t.t_cx, t.t_cy, t.t_w, t.t_h, t.t_weight, t.t_mask,
         CASE WHEN t.t_cx IS NOT NULL THEN 1.0 ELSE 0.0 END AS o
  FROM sl2 s JOIN best b USING (img_id, scale, gy, gx, k)
  LEFT JOIN tg t USING (img_id, scale, gy, gx, k)),
j2 AS (
  SELECT *, coalesce(t_weight, 1.0) AS m, coalesce(t_cx, 0.0) AS tcx, coalesce(t_cy, 0.0) AS tcy,
         coalesce(t_w, 0.0) AS ttw, coalesce(t_h, 0.0) AS tth, CAST(64 AS DOUBLE) / gw AS rx, CAST(32 AS DOUBLE) / gh AS ry
  FROM j),
j3 AS (
  SELECT *, 2.0 - (ttw / 64) * (tth / 32) AS sw,
         (tcx / rx - gx) - (cx / rx - gx) AS dx, (tcy / ry - gy) - (cy / ry - gy) AS dy,
         ln(least(greatest(CASE WHEN ttw / aw = 0 THEN 1.0 ELSE ttw / aw END, CAST(1e-9 AS DOUBLE)), CAST(1e9 AS DOUBLE)))
       - ln(least(greatest(CASE WHEN w / aw = 0 THEN 1.0 ELSE w / aw END, CAST(1e-9 AS DOUBLE)), CAST(1e9 AS DOUBLE))) AS dw,
         ln(least(greatest(CASE WHEN tth / ah = 0 THEN 1.0 ELSE tth / ah END, CAST(1e-9 AS DOUBLE)), CAST(1e9 AS DOUBLE)))
       - ln(least(greatest(CASE WHEN h / ah = 0 THEN 1.0 ELSE h / ah END, CAST(1e-9 AS DOUBLE)), CAST(1e9 AS DOUBLE))) AS dh
  FROM j2),
terms AS (
  SELECT scale, img_id,
         (dx * dx + dy * dy) * o * sw * m AS l_xy,
         (dw * dw + dh * dh) * o * sw * m AS l_wh,
         (o + (1.0 - o) * CASE WHEN best_iou < 0.5 THEN 1.0 ELSE 0.0 END)
           * (greatest(tc, 0.0) - tc * o + ln(1 + exp(-abs(tc)))) * m AS l_conf,
         0.0 + o * (greatest(t0, 0.0) - t0 * CASE WHEN coalesce(t_mask, 0) & 1 <> 0 THEN 1.0 ELSE 0.0 END + ln(1 + exp(-abs(t0)))) * m
             + o * (greatest(t1, 0.0) - t1 * CASE WHEN coalesce(t_mask, 0) & 2 <> 0 THEN 1.0 ELSE 0.0 END + ln(1 + exp(-abs(t1)))) * m
             + o * (greatest(t2, 0.0) - t2 * CASE WHEN coalesce(t_mask, 0) & 4 <> 0 THEN 1.0 ELSE 0.0 END + ln(1 + exp(-abs(t2)))) * m
           AS l_class
  FROM j3),
nimg AS (SELECT count(*) AS n FROM img),
per AS (
  SELECT scale, sum(l_xy) AS l_xy, sum(l_wh) AS l_wh, sum(l_conf) AS l_conf, sum(l_class) AS l_class
  FROM terms GROUP BY ROLLUP (scale))"""


_LOSS_SELECT = """
SELECT scale, round(l_xy / n, 6) AS loss_xy, round(l_wh / n, 6) AS loss_wh, round(l_conf / n, 6) AS loss_conf,
       round(l_class / n, 6) AS loss_class, round((l_xy + l_wh + l_conf + l_class) / n, 6) AS loss_total
FROM per CROSS JOIN nimg"""


def _loss(t, maps=None, targets=None, **kw):
    out = detection_loss(featmaps3(t) if maps is None else maps, loss_targets(t) if targets is None else targets, 3,
                         LOSS_ANCHORS, img_w=64, img_h=32, n_images=t.img.count(), **kw)
    return out.select("scale", *[F.round(c, 6).alias(c) for c in
                                 ("loss_xy", "loss_wh", "loss_conf", "loss_class", "loss_total")])


@register("detection_loss", osql.with_views("gt", "img_vec", extra=_LOSS_CTE) + _LOSS_SELECT)
def q_detection_loss(t):
    """G9 with J4 (ignore mask), J5 (slot-target join), B15-B19: per-scale losses and the total."""
    return _loss(t)


def _smooth_sql(sql: str) -> str:
    for bit in (1, 2, 4):
        y = f"CASE WHEN coalesce(t_mask, 0) & {bit} <> 0 THEN 1.0 ELSE 0.0 END"
        sql = sql.replace(y, f"(CAST(0.99 AS DOUBLE) * {y} + CAST(0.01 AS DOUBLE) / 3)")
    return sql


_FOCAL_CTE = _LOSS_CTE.replace("* (greatest(tc, 0.0) - tc * o + ln(1 + exp(-abs(tc)))) * m AS l_conf",
                               "* (greatest(tc, 0.0) - tc * o + ln(1 + exp(-abs(tc)))) * pow(abs(o - 1.0 / (1.0 + exp(-tc))), 2) * m AS l_conf")


@register("detection_loss_focal_smooth", osql.with_views("gt", "img_vec", extra=_smooth_sql(_FOCAL_CTE)) + _LOSS_SELECT)
def q_detection_loss_focal_smooth(t):
    """G9 with both switches on: focal weight on the object term (B19), smoothed class targets."""
    return _loss(t, use_focal_loss=True, use_label_smooth=True)


_BATCH_SCOPE_CTE = _LOSS_CTE.replace("FROM sl2 s LEFT JOIN tg t ON t.img_id = s.img_id AND t.scale = s.scale",
                                     "FROM sl2 s LEFT JOIN tg t ON t.img_id // 20 = s.img_id // 20 AND t.scale = s.scale")


@register("detection_loss_batch_scope", osql.with_views("gt", "img_vec", extra=_BATCH_SCOPE_CTE) + _LOSS_SELECT)
def q_detection_loss_batch_scope(t):
    """G9 with the ignore mask over all truths of a batch of 20 image ids."""
    batch = lambda df: df.withColumn("batch", F.floor(F.col("img_id") / 20).cast("bigint"))
    return _loss(t, featmaps3(t, t.vectors(batch(t.img), "batch")), batch(loss_targets(t)), scope="batch")


@register("l2_penalty", osql.with_views() + """
SELECT round(CAST(5e-4 AS DOUBLE) * sum(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) / 2, 9)
  AS loss_l2 FROM embeddings""")
def q_l2_penalty(t):
    """weight_decay * sum(w^2) / 2, the embeddings standing in for head weights."""
    return l2_penalty(t.embeddings, 5e-4, col="embedding").select(F.round("loss_l2", 9).alias("loss_l2"))


# --- B20/B21 learning-rate schedules ------------------------------------------------------------

from boxframe.config import DetectionConfig  # noqa: E402
from boxframe.functions.schedule import LR_TYPES, learning_rate  # noqa: E402
from boxframe.operators.feed import batch_sizes, epoch_batches, mixup_boxes, mixup_pairs  # noqa: E402
from boxframe.operators.match import evaluate_matches  # noqa: E402
from boxframe.operators.meters import meters_by_window, weighted_meter  # noqa: E402
from boxframe.operators.nms import nms  # noqa: E402
from boxframe.operators.loss import check_finite, observe_finite  # noqa: E402
from boxframe.sources.sinks import dataset_profile, metrics_long, read_detections, write_epoch  # noqa: E402

CFG = DetectionConfig()
LR_ROUND = 15


def _lr_sql(lr_type: str, u: str) -> str:
    c = CFG
    init, low, freq = repr(c.learning_rate_init), repr(c.lr_lower_bound), repr(float(c.lr_decay_freq))
    d = lambda v: f"CAST({v!r} AS DOUBLE)" if not isinstance(v, str) else f"CAST({v} AS DOUBLE)"
    if lr_type == "fixed":
        return d(c.learning_rate_init)
    if lr_type == "exponential":
        return f"greatest({d(c.learning_rate_init)} * pow({d(c.lr_decay_factor)}, floor({u} / {d(float(c.lr_decay_freq))})), {d(c.lr_lower_bound)})"
    if lr_type == "cosine_decay":
        return (f"{d(c.lr_lower_bound)} + 0.5 * ({d(c.learning_rate_init)} - {d(c.lr_lower_bound)}) * "
                f"(1.0 + cos({u} / {d(c.cosine_steps)} * pi()))")
    if lr_type == "cosine_decay_restart":
        x = f"({u} / {d(float(c.lr_decay_freq))})"
        i = f"floor(log2({x} + 1.0))"
        return f"{d(c.learning_rate_init)} * 0.5 * (1.0 + cos(pi() * (({x} - (pow(2.0, {i}) - 1.0)) / pow(2.0, {i}))))"
    if lr_type == "piecewise":
        b, v = c.pw_boundaries, c.pw_values
        return f"CASE WHEN {u} <= {d(b[0])} THEN {d(v[0])} WHEN {u} <= {d(b[1])} THEN {d(v[1])} ELSE {d(v[2])} END"
    raise ValueError(lr_type)


def _lr_with_warmup(lr_type: str) -> str:
    w = repr(float(CFG.warm_up_steps))
    return (f"CASE WHEN CAST(step AS DOUBLE) < CAST({w} AS DOUBLE) THEN CAST({CFG.learning_rate_init!r} AS DOUBLE) * "
            f"CAST(step AS DOUBLE) / CAST({w} AS DOUBLE) "
            f"ELSE {_lr_sql(lr_type, f'(CAST(step AS DOUBLE) - CAST({w} AS DOUBLE))')} END")


@register("lr_schedule", osql.with_views("meter_in") + "SELECT step, " + ", ".join(
    f"round({_lr_with_warmup(k)}, {LR_ROUND}) AS lr_{k}" for k in LR_TYPES) + " FROM meter_in")
def q_lr_schedule(t):
    """Every schedule with warm-up at each training step (steps from the event stream)."""
    s = t.meter_in.select("step")
    return s.select("step", *[F.round(learning_rate(F.col("step"), CFG, k), LR_ROUND).alias(f"lr_{k}") for k in LR_TYPES])


# --- G5 / L7 meters ---------------------------------------------------------------------------------

_METER_SQL = """sum(val * n) AS sum, CAST(sum(n) AS BIGINT) AS count, sum(val * n) / sum(n) AS average,
       arg_max(val, step) AS last"""


@register("meters", osql.with_views("meter_in") + f"""
SELECT tag, round(sum, 6) AS sum, count, round(average, 9) AS average, last FROM (
  SELECT tag, {_METER_SQL} FROM meter_in GROUP BY tag)""")
def q_meters(t):
    """Weighted running meter per tag: sum(v*n)/sum(n), last value by step."""
    m = weighted_meter(t.meter_in, ["tag"])
    return m.select("tag", F.round("sum", 6).alias("sum"), "count", F.round("average", 9).alias("average"), "last")


@register("meters_guarded", osql.with_views("meter_in") + f"""
SELECT tag, round(sum, 6) AS sum, count, round(average, 9) AS average, last FROM (
  SELECT tag, {_METER_SQL} FROM meter_in GROUP BY tag)""")
def q_meters_guarded(t):
    """Meters written once; whether an average is NaN is observed by that one action and checked after it."""
    guarded, seen = observe_finite(weighted_meter(t.meter_in, ["tag"]), "average")
    path = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/meters-{uuid.uuid4().hex}"
    guarded.write.parquet(path)
    check_finite(seen)
    m = t.spark.read.schema(guarded.schema).parquet(path)
    return m.select("tag", F.round("sum", 6).alias("sum"), "count", F.round("average", 9).alias("average"), "last")


@register("detections_sink", osql.with_views("pred") + """
SELECT CAST(1 AS INT) AS epoch, img_id, pred_id, label, score, x_min, y_min, x_max, y_max FROM pred WHERE score >= 0.5 AND label < 2""")
def q_detections_sink(t):
    """Two epochs of detections; the second is written twice, first with rows of a failed attempt, and read back."""
    path = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/detections-{uuid.uuid4().hex}"
    det = t.pred.select("img_id", "pred_id", "label", "score", "x_min", "y_min", "x_max", "y_max")
    write_epoch(det.filter("score >= 0.9"), path, 0)
    write_epoch(det.filter("score < 0.4"), path, 1)
    write_epoch(det.filter("score >= 0.5"), path, 1)
    return read_detections(t.spark, path, epoch=1, labels=[0, 1])


@register("meters_by_epoch", osql.with_views("meter_in") + f"""
SELECT epoch, tag, round(sum, 6) AS sum, count, round(average, 9) AS average, last FROM (
  SELECT step // 1000 AS epoch, tag, {_METER_SQL} FROM meter_in GROUP BY step // 1000, tag)""")
def q_meters_by_epoch(t):
    """L7 (batch): meters reset every epoch of 1000 steps."""
    m = weighted_meter(t.meter_in, [F.floor(F.col("step") / 1000).cast("bigint").alias("epoch"), "tag"])
    return m.select("epoch", "tag", F.round("sum", 6).alias("sum"), "count", F.round("average", 9).alias("average"), "last")


@register("meters_window", osql.with_views("meter_in") + f"""
SELECT window_start, tag, round(sum, 6) AS sum, count, round(average, 9) AS average, last FROM (
  SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS window_start, tag, {_METER_SQL}
  FROM meter_in GROUP BY 1, tag)""")
def q_meters_window(t):
    """L7 (batch twin of the stream): meters per tag on tumbling 1-day event-time windows."""
    m = meters_by_window(t.meter_in, "ts", "1 day", ["tag"])
    return m.select("window_start", "tag", F.round("sum", 6).alias("sum"), "count",
                    F.round("average", 9).alias("average"), "last")


# --- S7 metrics table -------------------------------------------------------------------------------

@register("metrics_long", osql.with_views("meter_in") + f"""
SELECT step, tag, value FROM (
  SELECT step, val AS total_loss, CAST(n AS DOUBLE) / 100 AS loss_l2,
         CAST(n AS DOUBLE) / 100 / nullif(val, 0) AS loss_ratio,
         round({_lr_with_warmup('exponential')}, {LR_ROUND}) AS learning_rate
  FROM meter_in) UNPIVOT (value FOR tag IN (total_loss, loss_l2, loss_ratio, learning_rate))""")
def q_metrics_long(t):
    """Per-step scalars (loss, L2 term, L2/total ratio, learning rate) as (step, tag, value)."""
    m = t.meter_in
    wide = m.select("step", F.col("val").alias("total_loss"), (F.col("n").cast("double") / 100).alias("loss_l2"),
                    F.try_divide(F.col("n").cast("double") / 100, F.col("val")).alias("loss_ratio"),
                    F.round(learning_rate(F.col("step"), CFG, "exponential"), LR_ROUND).alias("learning_rate"))
    return metrics_long(wide, "step", ["total_loss", "loss_l2", "loss_ratio", "learning_rate"]).filter(
        F.col("value").isNotNull())


# --- S9 dataset profile -----------------------------------------------------------------------------

@register("dataset_profile", osql.with_views("gt") + """
SELECT label, count(*) AS n_boxes, count(DISTINCT img_id) AS n_images FROM gt GROUP BY ROLLUP (label)""")
def q_dataset_profile(t):
    """Boxes and images per class plus the total."""
    return dataset_profile(t.gt)


# --- L1 / A9 / J6 feed ------------------------------------------------------------------------------

SEED = 7


def _u_sql(k: str, d: str, seed: int = SEED) -> str:
    text = f"'{seed}:' || CAST(CAST({d} AS BIGINT) AS VARCHAR) || ':' || CAST({k} AS VARCHAR)"
    return f"(CAST(CAST('0x' || substr(md5({text}), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0)"


_BATCH_CTE = f"""
eb_rows AS (SELECT img_id, e.epoch FROM img CROSS JOIN (SELECT unnest(range(2)) AS epoch) e),
eb_key AS (SELECT img_id, epoch, {_u_sql('img_id', 'epoch')} AS shuffle_key FROM eb_rows),
eb_rank AS (
  SELECT img_id, epoch, shuffle_key,
         row_number() OVER (PARTITION BY epoch ORDER BY shuffle_key, img_id) - 1 AS pos FROM eb_key),
eb AS (
  SELECT img_id, CAST(epoch AS INT) AS epoch, shuffle_key, CAST(pos AS BIGINT) AS pos,
         CAST(pos // 20 AS BIGINT) AS batch,
         CAST(epoch * ceil((SELECT count(*) FROM img) / 20.0) + pos // 20 AS BIGINT) AS step
  FROM eb_rank)"""


def _batches(t):
    return epoch_batches(t.img.select("img_id"), epochs=2, batch_size=20, seed=SEED)


@register("epoch_batches", osql.with_views("img", extra=_BATCH_CTE) + "SELECT * FROM eb")
def q_epoch_batches(t):
    """Two epochs, each in its own reproducible shuffled order, batches of 20."""
    return _batches(t).select("img_id", F.col("epoch").cast("int").alias("epoch"), "shuffle_key", "pos", "batch", "step")


@register("batch_sizes", osql.with_views("img", extra=_BATCH_CTE) + f"""
SELECT DISTINCT step, CAST([{', '.join(str(s) for s in range(320, 640, 32))}][
  CAST(floor({_u_sql('step // 10', '0')} * 10) AS INT) + 1] AS INT) AS img_size FROM eb""")
def q_batch_sizes(t):
    """Multi-scale input size per batch, redrawn every 10 steps."""
    return batch_sizes(_batches(t).select("step").distinct(), SEED, 10).select(
        "step", F.col("img_size").cast("int").alias("img_size"))


_MIXUP_CTE = f""",
mx_size AS (SELECT epoch, batch, count(*) AS bn, min(pos) AS b0 FROM eb GROUP BY epoch, batch),
mx AS (
  SELECT e.*, s.bn, e.pos - s.b0 AS slot,
         {_u_sql('e.img_id', '1 + e.epoch * 8')} < 0.5 AND s.bn > 1 AS mixed,
         {_u_sql('e.img_id', '2 + e.epoch * 8')} AS u2,
         0.5 + 0.5 * sqrt({_u_sql('e.img_id', '3 + e.epoch * 8')}) * cos(2 * pi() * {_u_sql('e.img_id', '4 + e.epoch * 8')}) AS lam
  FROM eb e JOIN mx_size s USING (epoch, batch)),
mx2 AS (SELECT *, CASE WHEN mixed THEN (slot + 1 + CAST(floor(u2 * (bn - 1)) AS BIGINT)) % bn END AS pslot FROM mx),
mx3 AS (
  SELECT a.img_id, a.epoch, a.batch, a.mixed, b.img_id AS partner_id,
         CASE WHEN a.mixed THEN b.img_id ELSE a.img_id END AS out_img_id, CASE WHEN a.mixed THEN a.lam ELSE 1.0 END AS lam
  FROM mx2 a LEFT JOIN mx2 b ON b.epoch = a.epoch AND b.batch = a.batch AND b.slot = a.pslot)"""


def _mixed(t):
    b = _batches(t).select("img_id", "epoch", "batch", "pos")
    return mixup_pairs(b, SEED, 20, t.img.count())


@register("mixup_pairs", osql.with_views("img", extra=_BATCH_CTE + _MIXUP_CTE) + """
SELECT img_id, epoch, batch, mixed, partner_id, out_img_id, round(lam, 9) AS lam FROM mx3""")
def q_mixup_pairs(t):
    """Mix-up partner for half the images, another member of the same batch, and the mix weight."""
    return _mixed(t).select("img_id", F.col("epoch").cast("int").alias("epoch"), "batch", "mixed",
                            "partner_id", "out_img_id", F.round("lam", 9).alias("lam"))


@register("mixup_boxes", osql.with_views("gt", extra=_BATCH_CTE + _MIXUP_CTE) + """
SELECT m.img_id, m.epoch, g.img_id AS from_id, g.box_id, g.label, g.x_min, g.y_min, g.x_max, g.y_max,
       round(CASE WHEN g.img_id = m.img_id THEN m.lam ELSE 1 - m.lam END, 9) AS weight
FROM mx3 m JOIN gt g ON g.img_id = m.img_id OR (m.mixed AND g.img_id = m.partner_id)""")
def q_mixup_boxes(t):
    """Truth boxes of every image after mix-up, own and partner's, with their weights."""
    return (mixup_boxes(_mixed(t), t.gt).withColumn("epoch", F.col("epoch").cast("int"))
            .withColumn("weight", F.round("weight", 9)))


# --- L6 evaluate every 100 steps --------------------------------------------------------------------

@register("evaluate_by_step", osql.with_views("pred", extra=osql.nms_sql("pred") + """,
ev_pairs AS (
  SELECT d.img_id, d.pred_id, d.label, d.score, t.box_id, t.label AS t_label, {ov} AS ov
  FROM nms_out d LEFT JOIN gt t ON t.img_id = d.img_id),
ev_best AS (
  SELECT * FROM ev_pairs QUALIFY row_number() OVER (PARTITION BY img_id, label, pred_id ORDER BY ov DESC NULLS LAST, box_id) = 1),
ev_claim AS (
  SELECT * FROM ev_best WHERE ov > 0.5 AND t_label = label
  QUALIFY row_number() OVER (PARTITION BY img_id, box_id ORDER BY score DESC, pred_id) = 1),
ev_tp AS (SELECT img_id // 2000 AS bucket, count(*) AS n_tp FROM ev_claim GROUP BY 1),
ev_pred AS (SELECT img_id // 2000 AS bucket, count(*) AS n_pred FROM nms_out GROUP BY 1),
ev_true AS (SELECT img_id // 2000 AS bucket, count(*) AS n_true FROM gt GROUP BY 1)""".replace(
    "{ov}", osql._iou_sql("d.", "t.", "eps"))) + """
SELECT CAST(coalesce(t.bucket, p.bucket) AS BIGINT) AS bucket, CAST(coalesce(t.n_true, 0) AS BIGINT) AS n_true,
       CAST(coalesce(p.n_pred, 0) AS BIGINT) AS n_pred, CAST(coalesce(x.n_tp, 0) AS BIGINT) AS n_tp,
       coalesce(x.n_tp, 0) / (coalesce(t.n_true, 0) + CAST(1e-6 AS DOUBLE)) AS recall,
       coalesce(x.n_tp, 0) / (coalesce(p.n_pred, 0) + CAST(1e-6 AS DOUBLE)) AS precision
FROM ev_true t FULL OUTER JOIN ev_pred p ON p.bucket = t.bucket LEFT JOIN ev_tp x ON x.bucket = coalesce(t.bucket, p.bucket)""")
def q_evaluate_by_step(t):
    """Batch evaluation every 100 steps of 20 images (bucket = img_id div 2000)."""
    det = stored(nms(t.pred.select("img_id", "label", "pred_id", "score", "x_min", "y_min", "x_max", "y_max"),
                     0.5, 0.5, 50))
    bucket = lambda df: df.withColumn("bucket", F.floor(F.col("img_id") / 2000).cast("bigint"))
    return evaluate_matches(bucket(det), bucket(t.gt), 0.5, per_class=False, group_cols=["bucket"])


# --- L2 / L3 head scoring ---------------------------------------------------------------------------

from boxframe.operators.infer import head_weights, score_head  # noqa: E402

HEAD_W, HEAD_B = head_weights(64, 24)


def _head_sql() -> str:
    return f"""
SELECT vec_id, CAST(j AS INT) AS j, round(list_reduce(list_transform(range(64), lambda i:
         f[i + 1] * (((i * 7 + j * 13) % 11 - 5) / 10.0)), lambda a, x: a + x, CAST(0.0 AS DOUBLE))
       + (j % 5 - 2) / 10.0, 9) AS logit
FROM (SELECT vec_id, f, unnest(range(24)) AS j FROM features)"""


@register("score_head", osql.with_views("features") + _head_sql())
def q_score_head(t):
    """L3: per-cell linear head (64 features -> 3 x (5 + 3) logits), JVM-side."""
    s = score_head(t.features, HEAD_W, HEAD_B, method="columns")
    return s.select("vec_id", F.posexplode("values").alias("j", "logit")).select(
        "vec_id", F.col("j").cast("int").alias("j"), F.round("logit", 9).alias("logit"))


@register("apply_model", osql.with_views("features") + _head_sql())
def q_apply_model(t):
    """L2: the same head as a user model on Arrow batches (mapInPandas, model built once per task)."""
    s = score_head(t.features.select("vec_id", "f"), HEAD_W, HEAD_B, method="arrow")
    return s.select("vec_id", F.posexplode("values").alias("j", "logit")).select(
        "vec_id", F.col("j").cast("int").alias("j"), F.round("logit", 9).alias("logit"))


# --- L4 fit the head ---------------------------------------------------------------------------------

from boxframe.config import ANCHOR_GROUPS  # noqa: E402
from boxframe.operators.assign import best_anchor  # noqa: E402
from boxframe.operators.train import fit_head  # noqa: E402

# Single-scale training fixture: one cell per image (grid 1x1), input 32x32, scale-0 anchors / 8.
HEAD_ANCHORS = tuple(LOSS_ANCHORS[i] for i in ANCHOR_GROUPS[0])
HEAD_BATCH = 5000


def head_cells(t):
    """``(step, f, tgt, truths)``: features of each image with its folded targets."""
    g = t.gt.join(t.img, "img_id")
    g = g.select("img_id", "box_id", "label",
                 ((F.col("x_min") + F.col("x_max")) / 2 / F.col("width") * 32).alias("cx"),
                 ((F.col("y_min") + F.col("y_max")) / 2 / F.col("height") * 32).alias("cy"),
                 ((F.col("x_max") - F.col("x_min")) / F.col("width") * 32).alias("w"),
                 ((F.col("y_max") - F.col("y_min")) / F.col("height") * 32).alias("h"))
    g = g.withColumn("k", best_anchor(F.col("w"), F.col("h"), HEAD_ANCHORS)["a_idx"])
    fold = g.groupBy("img_id", "k").agg(F.max_by(F.struct("cx", "cy", "w", "h"), "box_id").alias("geo"),
                                         F.collect_set("label").alias("cls"))
    per = fold.groupBy("img_id").agg(F.collect_list(F.struct("k", "geo", "cls")).alias("slots"))

    def slot_vec(k):
        hit = F.filter(F.col("slots"), lambda s: s["k"] == k)
        s0 = F.try_element_at(hit, F.lit(1))
        occupied = F.size(hit) > 0
        geo = [F.when(occupied, s0["geo"][c]).otherwise(F.lit(0.0)) for c in ("cx", "cy", "w", "h")]
        cls = [F.when(occupied & F.array_contains(s0["cls"], c), F.lit(1.0)).otherwise(F.lit(0.0)) for c in range(3)]
        return [*geo, F.when(occupied, F.lit(1.0)).otherwise(F.lit(0.0)), F.lit(1.0), *cls]

    per = per.select("img_id", F.array(*[v for k in range(3) for v in slot_vec(k)]).alias("tgt"),
                     F.transform("slots", lambda s: F.array(s["geo"]["cx"], s["geo"]["cy"], s["geo"]["w"],
                                                            s["geo"]["h"])).alias("truths"))
    feats = t.img_vec.select("img_id", F.col("embedding").alias("f"))  # as given, half the bytes of doubles: tasks compute in these
    cells = feats.join(per, "img_id", "left").select(
        "img_id", "f", F.coalesce("tgt", F.array(*([F.lit(0.0)] * 4 + [F.lit(0.0), F.lit(1.0)] + [F.lit(0.0)] * 3) * 3)).alias("tgt"),
        "truths")
    batches = epoch_batches(cells.select("img_id"), epochs=1, batch_size=HEAD_BATCH, seed=SEED)
    return cells.join(batches.select("img_id", "step"), "img_id")


@register("fit_head")
def q_fit_head(t):
    """One epoch of data-parallel head training (Adam, fixed rate); returns the loss per step.

    Iterative, so no SQL oracle; the gradient is checked numerically in the tests."""
    spark = t.spark
    cells = head_cells(t)
    n_steps = cells.agg(F.max("step")).collect()[0][0]
    w0, b0 = head_weights(64, 24)
    cfg = CFG.with_(lr_type="fixed", use_warm_up=False)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fit_head-{uuid.uuid4().hex}"
    _, _, log = fit_head(cells, w0 * 0.1, b0 * 0.1, HEAD_ANCHORS, img_w=32, img_h=32, class_num=3,
                         steps=int(n_steps or 0) + 1, table_path=path, cfg=cfg, optimizer="adam")
    schema = "step long, loss double, lr double"
    return spark.createDataFrame([(r["step"], r["loss"], r["lr"]) for r in log], schema)


# --- A10 dense targets ---------------------------------------------------------------------------------

from boxframe.operators.assign import dense_targets  # noqa: E402


@register("dense_targets", osql.with_views("gt", "img_vec", extra=_LOSS_CTE) + """
, dense AS (
  SELECT s.img_id, s.scale, s.gh, s.gw, (s.gy * s.gw + s.gx) * 3 + s.k AS slot,
         [coalesce(t_cx, 0.0), coalesce(t_cy, 0.0), coalesce(t_w, 0.0), coalesce(t_h, 0.0), CASE WHEN t_cx IS NULL THEN 0.0 ELSE 1.0 END,
          coalesce(t_mask, 0) & 1, (coalesce(t_mask, 0) >> 1) & 1, (coalesce(t_mask, 0) >> 2) & 1, coalesce(t_weight, 1.0)] AS ch
  FROM raw s LEFT JOIN tg t USING (img_id, scale, gy, gx, k))
SELECT img_id, scale, CAST(gh AS INT) AS grid_h, CAST(gw AS INT) AS grid_w, CAST(count(*) * 9 AS INT) AS n_values,
       round(sum(list_sum(list_transform(ch, lambda x, i: CAST(CAST(x AS FLOAT) AS DOUBLE) * (1 + (slot * 9 + i - 1) % 97)))), 3) AS value_sum
FROM dense GROUP BY img_id, scale, gh, gw""")
def q_dense_targets(t):
    """A10: dense grids of all images for the 64x32 loss fixture (3 scales per image); each value counts by its place."""
    imgs = t.img.select("img_id", F.lit(64).alias("img_w"), F.lit(32).alias("img_h"))
    d = dense_targets(loss_targets(t), imgs, 3)
    # a slot of nine values is one row for a moment, summed in generated code: a lambda would be interpreted
    d = d.select("img_id", "scale", "grid_h", "grid_w", "values", F.monotonically_increasing_id().alias("map"))
    d = d.select("*", F.explode_outer(F.when(F.size("values") > 0, F.sequence(F.lit(0), F.size("values") - 1, F.lit(9)))).alias("at"))
    placed = sum((F.col("values")[F.col("at") + c].cast("double") * (1 + (F.col("at") + c) % 97) for c in range(1, 9)),
                 F.col("values")[F.col("at")].cast("double") * (1 + F.col("at") % 97))
    s = d.select("img_id", "scale", "grid_h", "grid_w", "map", "at", F.size("values").alias("n_values"), placed.alias("placed"))
    s = s.groupBy("img_id", "scale", "grid_h", "grid_w", "map", "n_values").agg(
        F.sum("placed").alias("s"), F.count("placed").alias("known"), F.count("at").alias("slots"))
    total = F.when(F.col("known") == F.col("slots"), F.coalesce("s", F.lit(0.0)))
    return s.select("img_id", "scale", "grid_h", "grid_w", "n_values", F.round(total, 3).alias("value_sum"))
