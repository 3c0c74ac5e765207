"""Box geometry as Spark Column expressions (JVM-side, whole-stage codegen).

A box is given either as a struct Column with fields ``x_min, y_min, x_max,
y_max`` or as a 4-tuple of Columns / column names.  Every division goes
through ``try_divide`` so ANSI mode never raises on degenerate boxes; a zero
denominator gives NULL, and callers treat NULL as "no overlap".
"""

from __future__ import annotations

from typing import Sequence, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

BoxLike = Union[Column, str, Sequence[Union[Column, str]]]
COORDS = ("x_min", "y_min", "x_max", "y_max")


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def xyxy(b: BoxLike) -> tuple[Column, Column, Column, Column]:
    """Normalise a box argument to its four corner Columns."""
    if isinstance(b, (list, tuple)):
        if len(b) != 4:
            raise ValueError("a box needs four coordinates")
        return tuple(_c(v) for v in b)  # type: ignore[return-value]
    col = _c(b)
    return tuple(col.getField(f) for f in COORDS)  # type: ignore[return-value]


def prefixed(prefix: str = "") -> tuple[Column, ...]:
    """Corner columns named ``{prefix}x_min`` ... (flat layout)."""
    return tuple(F.col(f"{prefix}{f}") for f in COORDS)


# --- B1 / B2 / B3 -----------------------------------------------------------

def to_center(b: BoxLike) -> Column:
    """Corners -> struct(cx, cy, w, h)."""
    x0, y0, x1, y1 = xyxy(b)
    return F.struct(((x0 + x1) / 2).alias("cx"), ((y0 + y1) / 2).alias("cy"),
                    (x1 - x0).alias("w"), (y1 - y0).alias("h"))


def to_corners(cx, cy, w, h) -> Column:
    """Centre/size -> struct(x_min, y_min, x_max, y_max)."""
    cx, cy, w, h = (_c(v) for v in (cx, cy, w, h))
    return F.struct((cx - w / 2).alias("x_min"), (cy - h / 2).alias("y_min"),
                    (cx + w / 2).alias("x_max"), (cy + h / 2).alias("y_max"))


def box_area(b: BoxLike, offset: float = 0.0) -> Column:
    x0, y0, x1, y1 = xyxy(b)
    return (x1 - x0 + offset) * (y1 - y0 + offset)


# --- B4 IoU variants --------------------------------------------------------

IOU_VARIANTS = ("eps", "plain", "voc", "py", "tf")


def iou(a: BoxLike, b: BoxLike, variant: str = "eps", offset: float = 0.0) -> Column:
    """IoU of two boxes.

    eps   : inter / (A + B - inter + 1e-10), intersection clipped at 0.
    plain : (offset-aware) intersection counted only if overlap is strict on both axes, no eps.
    voc   : +1 on every width and height (pixel-inclusive boxes).
    py    : +1 on the intersection extents only, areas without it.
    tf    : corners normalised by min/max; any non-positive area gives 0.
    """
    ax0, ay0, ax1, ay1 = xyxy(a)
    bx0, by0, bx1, by1 = xyxy(b)
    if variant == "tf":
        ax0, ax1 = F.least(ax0, ax1), F.greatest(ax0, ax1)
        ay0, ay1 = F.least(ay0, ay1), F.greatest(ay0, ay1)
        bx0, bx1 = F.least(bx0, bx1), F.greatest(bx0, bx1)
        by0, by1 = F.least(by0, by1), F.greatest(by0, by1)
    ix0, iy0 = F.greatest(ax0, bx0), F.greatest(ay0, by0)
    ix1, iy1 = F.least(ax1, bx1), F.least(ay1, by1)
    if variant == "eps":
        inter = F.greatest(ix1 - ix0, F.lit(0.0)) * F.greatest(iy1 - iy0, F.lit(0.0))
        area_a = (ax1 - ax0) * (ay1 - ay0)
        area_b = (bx1 - bx0) * (by1 - by0)
        return F.try_divide(inter, area_a + area_b - inter + F.lit(1e-10))
    if variant == "plain":
        strict = (ix0 < ix1) & (iy0 < iy1)
        inter = F.when(strict, (ix1 - ix0 + offset) * (iy1 - iy0 + offset)).otherwise(F.lit(0.0))
        area_a = (ax1 - ax0 + offset) * (ay1 - ay0 + offset)
        area_b = (bx1 - bx0 + offset) * (by1 - by0 + offset)
        return F.try_divide(inter, area_a + area_b - inter)
    if variant == "voc":
        inter = F.greatest(ix1 - ix0 + 1.0, F.lit(0.0)) * F.greatest(iy1 - iy0 + 1.0, F.lit(0.0))
        uni = (ax1 - ax0 + 1.0) * (ay1 - ay0 + 1.0) + (bx1 - bx0 + 1.0) * (by1 - by0 + 1.0) - inter
        return F.try_divide(inter, uni)
    if variant == "py":
        inter = F.greatest(F.lit(0.0), ix1 - ix0 + 1.0) * F.greatest(F.lit(0.0), iy1 - iy0 + 1.0)
        area_a = (ax1 - ax0) * (ay1 - ay0)
        area_b = (bx1 - bx0) * (by1 - by0)
        return F.try_divide(inter, area_a + area_b - inter)
    if variant == "tf":
        area_a = (ax1 - ax0) * (ay1 - ay0)
        area_b = (bx1 - bx0) * (by1 - by0)
        inter = F.greatest(ix1 - ix0, F.lit(0.0)) * F.greatest(iy1 - iy0, F.lit(0.0))
        return F.when((area_a <= 0) | (area_b <= 0), F.lit(0.0)).otherwise(
            F.try_divide(inter, area_a + area_b - inter))
    raise ValueError(f"unknown IoU variant {variant!r}; expected one of {IOU_VARIANTS}")


def iou_wh(w, h, aw, ah) -> Column:
    """Size-only IoU (both boxes centred at the origin), +1e-10 in the denominator."""
    w, h, aw, ah = (_c(v) for v in (w, h, aw, ah))
    inter = F.least(w, aw) * F.least(h, ah)
    return F.try_divide(inter, w * h + aw * ah - inter + F.lit(1e-10))


def iou_center(a_cxcywh: Sequence, b_cxcywh: Sequence) -> Column:
    """B4f: centre-format IoU with the eps denominator (ignore-mask IoU); areas are w*h."""
    acx, acy, aw, ah = (_c(v) for v in a_cxcywh)
    bcx, bcy, bw, bh = (_c(v) for v in b_cxcywh)
    iw = F.greatest(F.least(acx + aw / 2, bcx + bw / 2) - F.greatest(acx - aw / 2, bcx - bw / 2), F.lit(0.0))
    ih = F.greatest(F.least(acy + ah / 2, bcy + bh / 2) - F.greatest(acy - ah / 2, bcy - bh / 2), F.lit(0.0))
    inter = iw * ih
    return F.try_divide(inter, aw * ah + bw * bh - inter + F.lit(1e-10))


def suppresses(iou_col: Column, variant: str, threshold: float) -> Column:
    """True when a kept box with this IoU removes the candidate.

    tf : IoU > t.  py : not (IoU <= t), so a NaN/inf overlap (zero union) also removes.
    """
    if variant == "py":
        return F.coalesce(~(iou_col <= F.lit(threshold)), F.lit(True))
    return F.coalesce(iou_col > F.lit(threshold), F.lit(False))


# --- B5-B8 box transforms (work on one box; apply with F.transform on arrays) ---

def rescale_box(b: BoxLike, from_w, from_h, to_w, to_h) -> Column:
    x0, y0, x1, y1 = xyxy(b)
    fw, fh, tw, th = (_c(v) for v in (from_w, from_h, to_w, to_h))
    return F.struct((x0 / fw * tw).alias("x_min"), (y0 / fh * th).alias("y_min"),
                    (x1 / fw * tw).alias("x_max"), (y1 / fh * th).alias("y_max"))


def flip_box(b: BoxLike, width, height, horizontal, vertical) -> Column:
    """Mirror a box inside a (width, height) image; flags may be Columns."""
    x0, y0, x1, y1 = xyxy(b)
    w, h, hf, vf = _c(width), _c(height), _c(horizontal), _c(vertical)
    nx0 = F.when(hf, w - x1).otherwise(x0)
    nx1 = F.when(hf, w - x0).otherwise(x1)
    ny0 = F.when(vf, h - y1).otherwise(y0)
    ny1 = F.when(vf, h - y0).otherwise(y1)
    return F.struct(nx0.alias("x_min"), ny0.alias("y_min"), nx1.alias("x_max"), ny1.alias("y_max"))


def shift_box(b: BoxLike, dx, dy) -> Column:
    x0, y0, x1, y1 = xyxy(b)
    dx, dy = _c(dx), _c(dy)
    return F.struct((x0 + dx).alias("x_min"), (y0 + dy).alias("y_min"),
                    (x1 + dx).alias("x_max"), (y1 + dy).alias("y_max"))


def with_box(s: Column, box: Column) -> Column:
    """Replace the corner fields of struct ``s`` by those of ``box`` (other fields kept)."""
    out = s
    for f in COORDS:
        out = out.withField(f, box.getField(f))
    return out


def crop_boxes(boxes: Column, left, top, width=None, height=None, allow_outside_center: bool = True) -> Column:
    """Crop an array of box structs to a window (None/0 extent = unbounded).

    Corners are clipped to the window and translated to its origin; boxes left
    empty are dropped, and with ``allow_outside_center=False`` so are boxes
    whose centre is outside ``[left, right) x [top, bottom)``.  Other struct
    fields (label, weight, ...) travel with their box."""
    l = F.coalesce(_c(left), F.lit(0.0)).cast("double")
    t = F.coalesce(_c(top), F.lit(0.0)).cast("double")
    inf = F.lit(float("inf"))
    r = l + (F.when(F.coalesce(_c(width), F.lit(0)) != 0, _c(width).cast("double")).otherwise(inf)
             if width is not None else inf)
    b = t + (F.when(F.coalesce(_c(height), F.lit(0)) != 0, _c(height).cast("double")).otherwise(inf)
             if height is not None else inf)

    def inside(x):
        cx = (x["x_min"] + x["x_max"]) / 2
        cy = (x["y_min"] + x["y_max"]) / 2
        return (l <= cx) & (cx < r) & (t <= cy) & (cy < b)

    kept = boxes if allow_outside_center else F.filter(boxes, inside)
    moved = F.transform(kept, lambda x: with_box(x, F.struct(
        (F.greatest(x["x_min"], l) - l).alias("x_min"), (F.greatest(x["y_min"], t) - t).alias("y_min"),
        (F.least(x["x_max"], r) - l).alias("x_max"), (F.least(x["y_max"], b) - t).alias("y_max"))))
    return F.filter(moved, lambda x: (x["x_min"] < x["x_max"]) & (x["y_min"] < x["y_max"]))


def flip_boxes(boxes: Column, width, height, horizontal, vertical) -> Column:
    """B6 on an array of box structs."""
    return F.transform(boxes, lambda x: with_box(x, flip_box(x, width, height, horizontal, vertical)))


def expand_boxes(boxes: Column, off_x, off_y) -> Column:
    """B7 on an array: boxes move with the image pasted at (off_x, off_y) on a larger canvas."""
    return F.transform(boxes, lambda x: with_box(x, shift_box(x, off_x, off_y)))


def rescale_boxes(boxes: Column, from_w, from_h, to_w, to_h) -> Column:
    """B5 on an array."""
    return F.transform(boxes, lambda x: with_box(x, rescale_box(x, from_w, from_h, to_w, to_h)))


def crop_box(b: BoxLike, left, top, width, height) -> Column:
    """B8 for one box (row form): clipped, translated corners; use :func:`crop_keep` to filter."""
    x0, y0, x1, y1 = xyxy(b)
    l, t = _c(left).cast("double"), _c(top).cast("double")
    r, btm = l + _c(width).cast("double"), t + _c(height).cast("double")
    return F.struct((F.greatest(x0, l) - l).alias("x_min"), (F.greatest(y0, t) - t).alias("y_min"),
                    (F.least(x1, r) - l).alias("x_max"), (F.least(y1, btm) - t).alias("y_max"))


def crop_keep(b: BoxLike, left, top, width, height, allow_outside_center: bool = True) -> Column:
    """Whether a box survives the crop (non-empty after clipping; centre test optional)."""
    x0, y0, x1, y1 = xyxy(b)
    l, t = _c(left).cast("double"), _c(top).cast("double")
    r, btm = l + _c(width).cast("double"), t + _c(height).cast("double")
    keep = (F.greatest(x0, l) < F.least(x1, r)) & (F.greatest(y0, t) < F.least(y1, btm))
    if not allow_outside_center:
        cx, cy = (x0 + x1) / 2, (y0 + y1) / 2
        keep = keep & (l <= cx) & (cx < r) & (t <= cy) & (cy < btm)
    return keep
