"""Config, schedules, meters, class names, NaN guard, pixel mix-up."""

import math
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxframe.config import DetectionConfig, parse_anchor_string, DEFAULT_ANCHORS
from boxframe.functions.schedule import LR_TYPES, learning_rate
from boxframe.operators.loss import assert_finite
from boxframe.operators.meters import weighted_meter
from boxframe.operators.raster import blend, blend_pairs
from boxframe.sources.annotations import scan_class_names, with_class_names


def test_config_derived_values(spark):
    c = DetectionConfig()
    assert c.train_batch_num == 7 and c.lr_decay_freq == 35 and c.warm_up_steps == 21
    assert c.pw_boundaries == (420.0, 560.0)
    assert len(parse_anchor_string(DEFAULT_ANCHORS)) == 9
    d = c.derive(spark.range(41))
    assert d.train_img_cnt == 41 and d.train_batch_num == 3


def _lr_ref(step, c, kind):
    w = c.warm_up_steps
    if step < w:
        return c.learning_rate_init * step / w
    u = step - w
    if kind == "fixed":
        return c.learning_rate_init
    if kind == "exponential":
        return max(c.learning_rate_init * c.lr_decay_factor ** math.floor(u / c.lr_decay_freq), c.lr_lower_bound)
    if kind == "cosine_decay":
        T = (c.total_epochs - c.warm_up_epoch) * c.train_batch_num
        return c.lr_lower_bound + 0.5 * (c.learning_rate_init - c.lr_lower_bound) * (1 + math.cos(u / T * math.pi))
    if kind == "cosine_decay_restart":
        x = u / c.lr_decay_freq
        i = math.floor(math.log2(x + 1))
        y = (x - (2 ** i - 1)) / 2 ** i
        return c.learning_rate_init * 0.5 * (1 + math.cos(math.pi * y))
    if kind == "piecewise":
        b, v = c.pw_boundaries, c.pw_values
        return v[0] if u <= b[0] else (v[1] if u <= b[1] else v[2])


@pytest.mark.parametrize("kind", LR_TYPES)
def test_learning_rate_schedules(spark, kind):
    c = DetectionConfig()
    got = [r[0] for r in spark.range(0, 1500, 7).orderBy("id").select(learning_rate(F.col("id"), c, kind)).collect()]
    want = [_lr_ref(s, c, kind) for s in range(0, 1500, 7)]
    assert np.allclose(got, want, rtol=1e-12, atol=0)


def test_weighted_meter(spark):
    df = spark.createDataFrame([(1, "a", 2.0, 3), (2, "a", 4.0, 1), (3, "b", 1.0, 1)], "step long, tag string, val double, n int")
    m = {r.tag: r for r in weighted_meter(df).collect()}
    assert m["a"].average == pytest.approx((2 * 3 + 4) / 4) and m["a"].last == 4.0 and m["a"]["count"] == 4


def test_assert_finite(spark):
    ok = spark.createDataFrame([(1.0,)], "loss_total double")
    assert_finite(ok)
    with pytest.raises(ArithmeticError):
        assert_finite(spark.createDataFrame([(float("nan"),)], "loss_total double"))


def test_observed_nan_is_checked_after_the_one_action(spark):
    from boxframe.operators.loss import check_finite, observe_finite
    for value, ok in ((2.0, True), (float("nan"), False), (None, True)):
        df = spark.createDataFrame([(1.0,), (value,)], "loss_total double")
        guarded, seen = observe_finite(df)
        assert len(guarded.collect()) == 2
        if ok:
            assert check_finite(seen) == 2
        else:
            with pytest.raises(ArithmeticError):
                check_finite(seen)


def test_epoch_sink_replaces_its_epoch_only(spark):
    from boxframe.sources.sinks import read_detections, write_epoch
    path = tempfile.mkdtemp(prefix="bf-epoch-") + "/det"
    det = spark.range(20).selectExpr("id AS img_id", "1 AS pred_id", "CAST(id % 3 AS INT) AS label", "0.5D AS score", "0D AS x_min", "0D AS y_min",
                                     "1D AS x_max", "1D AS y_max")
    write_epoch(det, path, 0)
    write_epoch(det.filter("label = 2"), path, 1)
    for _ in range(2):
        write_epoch(det.filter("label < 2"), path, 1)
    assert read_detections(spark, path).count() == 34
    one = read_detections(spark, path, epoch=1, labels=[1])
    assert sorted(r.img_id for r in one.collect()) == [i for i in range(20) if i % 3 == 1]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(epoch" in plan and "EqualTo(label,1)" in plan.replace("In(label, [1])", "EqualTo(label,1)")


def test_class_names_join(spark):
    d = tempfile.mkdtemp(prefix="bf-names-")
    with open(f"{d}/c.names", "w") as f:
        f.write("a\nb\n")
    names = scan_class_names(f"{d}/c.names", spark)
    det = spark.createDataFrame([(1, 0), (2, 1), (3, 5)], "img_id long, label int")
    got = {r.img_id: r.name for r in with_class_names(det, names).collect()}
    assert got == {1: "a", 2: "b", 3: None}


def test_blend_pairs(spark):
    a = np.full((2, 3, 3), 100, np.uint8)
    b = np.full((3, 2, 3), 50, np.uint8)
    img = lambda x: {"height": x.shape[0], "width": x.shape[1], "n_channels": 3, "data": x.tobytes()}
    images = spark.createDataFrame([(1, img(a)), (2, img(b))],
                                   "img_id long, image struct<height:int,width:int,n_channels:int,data:binary>")
    pairs = spark.createDataFrame([(1, 2, 0.25)], "img_id long, partner_id long, lam double")
    r = blend_pairs(pairs, images).first()
    got = np.frombuffer(r.image.data, np.uint8).reshape(r.image.height, r.image.width, 3)
    assert np.array_equal(got, blend(a, b, 0.25)) and got.shape == (3, 3, 3)


def test_ship_package_once(spark):
    from boxframe.session import ship_package
    ship_package(spark)  # already shipped by local_session: a no-op
    assert getattr(spark.sparkContext, "_boxframe_shipped", False)
    # a worker can import a module that is not on the driver's start-up path
    got = spark.range(2).rdd.map(lambda _: __import__("boxframe.operators.augment", fromlist=["x"]).__name__).collect()
    assert got == ["boxframe.operators.augment"] * 2
