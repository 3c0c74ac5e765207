"""Property tests: IoU bounds and symmetry, ignore-mask scope (Q6)."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boxframe.functions.boxes import iou
from boxframe.operators.loss import decode_with_targets

coord = st.integers(min_value=-50, max_value=250)


@st.composite
def box(draw):
    x0, y0 = draw(coord), draw(coord)
    return (float(x0), float(y0), float(x0 + draw(st.integers(1, 120))), float(y0 + draw(st.integers(1, 120))))


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(box(), box()), min_size=40, max_size=40))
def test_iou_bounded_and_symmetric(spark, pairs):
    rows = [a + b for a, b in pairs]
    df = spark.createDataFrame(rows, "ax0 double, ay0 double, ax1 double, ay1 double, "
                                     "bx0 double, by0 double, bx1 double, by1 double")
    a, b = ("ax0", "ay0", "ax1", "ay1"), ("bx0", "by0", "bx1", "by1")
    cols = []
    for v in ("eps", "plain", "voc", "tf"):
        cols += [iou(a, b, v).alias(f"{v}_ab"), iou(b, a, v).alias(f"{v}_ba")]
    for r in df.select(*cols).collect():
        for v in ("eps", "plain", "voc", "tf"):
            x, y = r[f"{v}_ab"], r[f"{v}_ba"]
            assert x == y and 0.0 <= x <= 1.0


def test_ignore_mask_scope_image_vs_batch(spark):
    # two images in one batch; image 2 has a truth exactly where image 1's first slot predicts
    maps = spark.createDataFrame([(1, 0, 1, 1, [0.0] * 24, 7)],
                                 "img_id long, scale int, grid_h int, grid_w int, values array<double>, batch int")
    targets = spark.createDataFrame([(2, 0, 0, 0, 0, 50.0, 50.0, 20.0, 20.0, 1.0, [0], 7)],
                                    "img_id long, scale int, gy int, gx int, k int, cx double, cy double, "
                                    "w double, h double, weight double, classes array<int>, batch int")
    best = {scope: decode_with_targets(maps, targets, 3, [(20.0, 20.0)] * 9, img_w=100, img_h=100, scope=scope)
            .filter("k = 0").first() for scope in ("image", "batch")}
    assert best["image"].best_iou == 0.0 and np.isclose(best["batch"].best_iou, 1.0)
    assert best["image"].tgt is None and best["batch"].tgt is None  # the slot's own target is of its own image
    own = decode_with_targets(maps, targets.withColumn("img_id", F.lit(1).cast("long")), 3, [(20.0, 20.0)] * 9, img_w=100, img_h=100)
    assert [r.tgt is not None for r in own.orderBy("k").collect()] == [True, False, False]
