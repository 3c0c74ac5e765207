"""Independent DuckDB SQL for the registered queries (the correctness oracle).

Written by hand against the same derived views (as CTEs); nothing here is
generated from the Spark plans.
"""

from __future__ import annotations

from boxframe.plans.fixtures import duck_cte


def _iou_sql(a: str, b: str, variant: str) -> str:
    """IoU of boxes with column prefixes ``a`` and ``b`` (e.g. 'k.' and 'c.')."""
    ax0, ay0, ax1, ay1 = (f"{a}x_min", f"{a}y_min", f"{a}x_max", f"{a}y_max")
    bx0, by0, bx1, by1 = (f"{b}x_min", f"{b}y_min", f"{b}x_max", f"{b}y_max")
    if variant == "tf":
        ax0, ax1 = f"least({a}x_min, {a}x_max)", f"greatest({a}x_min, {a}x_max)"
        ay0, ay1 = f"least({a}y_min, {a}y_max)", f"greatest({a}y_min, {a}y_max)"
        bx0, bx1 = f"least({b}x_min, {b}x_max)", f"greatest({b}x_min, {b}x_max)"
        by0, by1 = f"least({b}y_min, {b}y_max)", f"greatest({b}y_min, {b}y_max)"
    iw = f"(least({ax1}, {bx1}) - greatest({ax0}, {bx0}))"
    ih = f"(least({ay1}, {by1}) - greatest({ay0}, {by0}))"
    area_a = f"(({ax1}) - ({ax0})) * (({ay1}) - ({ay0}))"
    area_b = f"(({bx1}) - ({bx0})) * (({by1}) - ({by0}))"
    if variant == "eps":
        inter = f"(greatest({iw}, 0.0) * greatest({ih}, 0.0))"
        return f"({inter} / nullif({area_a} + {area_b} - {inter} + CAST(1e-10 AS DOUBLE), 0))"
    if variant == "tf":
        inter = f"(greatest({iw}, 0.0) * greatest({ih}, 0.0))"
        return (f"(CASE WHEN {area_a} <= 0 OR {area_b} <= 0 THEN CAST(0 AS DOUBLE) "
                f"ELSE {inter} / nullif({area_a} + {area_b} - {inter}, 0) END)")
    if variant == "voc":
        inter = f"(greatest({iw} + 1.0, 0.0) * greatest({ih} + 1.0, 0.0))"
        uni = f"(({ax1} - {ax0} + 1.0) * ({ay1} - {ay0} + 1.0) + ({bx1} - {bx0} + 1.0) * ({by1} - {by0} + 1.0) - {inter})"
        return f"({inter} / nullif({uni}, 0))"
    if variant == "py":
        inter = f"(greatest(0.0, {iw} + 1.0) * greatest(0.0, {ih} + 1.0))"
        return f"({inter} / nullif({area_a} + {area_b} - {inter}, 0))"
    if variant == "plain":
        strict = f"(greatest({ax0}, {bx0}) < least({ax1}, {bx1}) AND greatest({ay0}, {by0}) < least({ay1}, {by1}))"
        inter = f"(CASE WHEN {strict} THEN {iw} * {ih} ELSE CAST(0 AS DOUBLE) END)"
        return f"({inter} / nullif({area_a} + {area_b} - {inter}, 0))"
    raise ValueError(variant)


def nms_sql(source: str = "pred", iou_t: float = 0.5, score_t: float = 0.5, topk: int = 50,
            variant: str = "tf") -> str:
    """Greedy NMS as a recursive walk over each (image, class) in score order."""
    ov = _iou_sql("k.", "c.", variant)
    if variant == "py":
        sup = f"coalesce(NOT ({ov} <= {iou_t}), true)"
    else:
        sup = f"coalesce({ov} > {iou_t}, false)"
    item = ("struct_pack(pred_id := c.pred_id, score := c.score, x_min := c.x_min, y_min := c.y_min, "
            "x_max := c.x_max, y_max := c.y_max)")
    first = item.replace("c.", "")
    return f"""
nms_cand AS (
  SELECT img_id, label, pred_id, score, x_min, y_min, x_max, y_max,
         row_number() OVER (PARTITION BY img_id, label ORDER BY score DESC, pred_id) AS rn
  FROM {source} WHERE score >= {score_t}),
nms_walk AS (
  SELECT img_id, label, rn, [{first}] AS kept FROM nms_cand WHERE rn = 1
  UNION ALL
  SELECT w.img_id, w.label, c.rn,
         CASE WHEN len(w.kept) >= {topk} OR list_bool_or(list_transform(w.kept, lambda k: {sup}))
              THEN w.kept ELSE list_append(w.kept, {item}) END
  FROM nms_walk w JOIN nms_cand c ON c.img_id = w.img_id AND c.label = w.label AND c.rn = w.rn + 1),
nms_last AS (
  SELECT img_id, label, kept FROM nms_walk
  QUALIFY rn = max(rn) OVER (PARTITION BY img_id, label)),
nms_out AS (
  SELECT img_id, label, k.pred_id AS pred_id, k.score AS score, k.x_min AS x_min, k.y_min AS y_min,
         k.x_max AS x_max, k.y_max AS y_max
  FROM (SELECT img_id, label, unnest(kept) AS k FROM nms_last))"""


def with_views(*views: str, extra: str = "") -> str:
    """``WITH RECURSIVE`` prefix with the fixture views and extra CTEs."""
    if not views:
        return ("WITH RECURSIVE " + extra.lstrip().lstrip(",") + "\n") if extra else ""
    head = duck_cte(*views).replace("WITH ", "WITH RECURSIVE ", 1).rstrip()
    return head + ("," + extra if extra else "") + "\n"


def voc_sql(det: str, truth: str = "gt", iou_t: float = 0.5, use_07: bool = False) -> str:
    """CTEs ``voc_cls`` (per class) computing the VOC evaluation of ``det`` against ``truth``."""
    ov = _iou_sql("d.", "t.", "voc")
    eleven = [i * 0.1 for i in range(11)]
    pts = ",\n".join(
        f"max(CASE WHEN recall >= CAST('{t!r}' AS DOUBLE) THEN precision END) AS p{i}" for i, t in enumerate(eleven))
    ap11 = " + ".join(f"coalesce(p{i}, 0.0) / 11.0" for i in range(11))
    ap11 = "CAST(0.0 AS DOUBLE) + " + ap11
    return f"""
voc_pairs AS (
  SELECT d.img_id, d.pred_id, d.label, d.score, t.box_id, {ov} AS ov
  FROM {det} d LEFT JOIN {truth} t ON t.img_id = d.img_id AND t.label = d.label),
voc_best AS (
  SELECT * FROM voc_pairs
  QUALIFY row_number() OVER (PARTITION BY img_id, label, pred_id ORDER BY ov DESC NULLS LAST, box_id) = 1),
voc_tp AS (
  SELECT img_id, pred_id, label, score,
         CASE WHEN ov > {iou_t} AND row_number() OVER (
              PARTITION BY img_id, label, box_id, (ov > {iou_t}) ORDER BY score DESC, pred_id) = 1
              THEN 1 ELSE 0 END AS tp
  FROM voc_best),
voc_npos AS (SELECT label, count(*) AS npos FROM {truth} GROUP BY label),
voc_rank AS (
  SELECT t.*, n.npos,
         row_number() OVER (PARTITION BY t.label ORDER BY score DESC, img_id, pred_id) AS rk,
         sum(tp) OVER (PARTITION BY t.label ORDER BY score DESC, img_id, pred_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_tp
  FROM voc_tp t LEFT JOIN voc_npos n ON n.label = t.label),
voc_curve AS (
  SELECT *, CAST(cum_tp AS DOUBLE) / rk AS precision, CAST(cum_tp AS DOUBLE) / npos AS recall
  FROM voc_rank),
voc_env AS (
  SELECT *, max(precision) OVER (PARTITION BY label ORDER BY score ASC, img_id DESC, pred_id DESC
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS envelope
  FROM voc_curve),
voc_per AS (
  SELECT label, count(*) AS nd, sum(tp) AS tp, sum(CASE WHEN tp = 1 THEN envelope END) AS env_sum,
         {pts}
  FROM voc_env GROUP BY label),
voc_cls AS (
  SELECT CAST(coalesce(n.label, p.label) AS INT) AS label,
         CAST(coalesce(n.npos, 0) AS BIGINT) AS npos,
         CAST(coalesce(p.nd, 0) AS BIGINT) AS nd,
         CAST(coalesce(p.tp, 0) AS BIGINT) AS tp,
         CASE WHEN coalesce(n.npos, 0) > 0 THEN CAST(coalesce(p.tp, 0) AS DOUBLE) / n.npos END AS recall,
         CASE WHEN coalesce(p.nd, 0) > 0 THEN CAST(p.tp AS DOUBLE) / p.nd ELSE CAST(0.0 AS DOUBLE) END AS precision,
         round(CASE WHEN coalesce(n.npos, 0) > 0 THEN
                 CASE WHEN coalesce(p.nd, 0) > 0 THEN {('(' + ap11 + ')') if use_07 else 'coalesce(p.env_sum, 0.0) / n.npos'}
                      ELSE CAST(0.0 AS DOUBLE) END END, 9) AS ap
  FROM voc_npos n FULL OUTER JOIN voc_per p ON p.label = n.label)"""


VOC_SUMMARY_SELECT = """
SELECT round(avg(coalesce(ap, 0.0)), 9) AS map,
       round(sum(recall * npos) / CAST(sum(npos) AS DOUBLE), 9) AS recall,
       round(sum(precision * nd) / CAST(sum(nd) AS DOUBLE), 9) AS precision,
       count(*) AS n_classes
FROM voc_cls WHERE ap IS NOT NULL"""
