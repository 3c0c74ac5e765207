"""File sources and sinks, written into fresh temporary folders."""

import os
import struct
import tempfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxframe.sources.annotations import explode_boxes, scan_anchors, scan_annotations, scan_class_names
from boxframe.sources.images import attach_images, image_dims, scan_images
from boxframe.sources.sinks import metrics_long, write_detections, write_metrics
from boxframe.sources.tfrecord import build_example, scan_tfrecords, write_records


def _dir():
    return tempfile.mkdtemp(prefix="bf-test-")


def test_annotation_lines(spark):
    d = _dir()
    with open(f"{d}/train.txt", "w") as f:
        f.write("0 img/a.png 1 10 20 30 40 2 5 5 50 60\n")
        f.write("1 img/b.png\n")                       # no boxes
        f.write("2 img/c.png 0 1 2 3 4 9 9\n")          # trailing partial group ignored
    ann = scan_annotations(f"{d}/train.txt", spark=spark).orderBy("img_id").collect()
    assert [len(r.boxes) for r in ann] == [2, 0, 1]
    assert (ann[0].boxes[1].label, ann[0].boxes[1].x_max, ann[0].boxes[1].weight) == (2, 50.0, 1.0)
    rows = explode_boxes(scan_annotations(f"{d}/train.txt", spark=spark)).count()
    assert rows == 3


def test_annotation_modes(spark):
    d = _dir()
    with open(f"{d}/bad.txt", "w") as f:
        f.write("0 img/a.png 1 10 x 30 40\n")
    bad = scan_annotations(f"{d}/bad.txt", mode="PERMISSIVE", spark=spark).first()
    assert bad.boxes[0].y_min is None
    with pytest.raises(Exception):
        scan_annotations(f"{d}/bad.txt", mode="FAILFAST", spark=spark).collect()


def test_class_names_and_anchors(spark):
    d = _dir()
    with open(f"{d}/class.names", "w") as f:
        f.write("cat\ndog\nperson\n")
    names = [tuple(r) for r in scan_class_names(f"{d}/class.names", spark).orderBy("label").collect()]
    assert names == [(0, "cat"), (1, "dog"), (2, "person")]
    with open(f"{d}/anchors.txt", "w") as f:
        f.write("10,13, 16,30, 33,23")
    a = [tuple(r) for r in scan_anchors(f"{d}/anchors.txt", spark).collect()]
    assert a == [(0, 10.0, 13.0), (1, 16.0, 30.0), (2, 33.0, 23.0)]


def test_tfrecord_round_trip(spark):
    d = _dir()
    ex = [build_example({"index": [i], "shape": [2, 2, 3], "image": list(range(12)),
                         "boxes": [1, 2, 3, 4] * n, "labels": [i % 3] * n}) for i, n in ((0, 0), (1, 1), (2, 5))]
    write_records(f"{d}/a.tfrecord", ex)
    rows = {r.img_id: r for r in scan_tfrecords(spark, d).collect()}
    assert sorted(rows) == [0, 1, 2]
    assert [len(rows[i].boxes) for i in (0, 1, 2)] == [0, 1, 5]
    assert rows[2].boxes[4].label == 2 and rows[1].shape == [2, 2, 3] and len(rows[1].pixels) == 12
    with open(f"{d}/a.tfrecord", "ab") as fh:   # truncated record
        fh.write(struct.pack("<Q", 100) + b"\0\0\0\0" + b"xx")
    perm = scan_tfrecords(spark, d, mode="PERMISSIVE").collect()
    assert sum(r._corrupt is not None for r in perm) == 1
    with pytest.raises(Exception):
        scan_tfrecords(spark, d, mode="FAILFAST").collect()


def _png(path, arr):
    h, w, _ = arr.shape
    raw = b"".join(b"\0" + arr[y].tobytes() for y in range(h))

    def chunk(t, data):
        return struct.pack(">I", len(data)) + t + data + struct.pack(">I", zlib.crc32(t + data) & 0xFFFFFFFF)
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + \
        chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    with open(path, "wb") as f:
        f.write(png)


def test_images_dims_and_attach(spark):
    d = _dir()
    os.makedirs(f"{d}/img")
    rgb = np.zeros((4, 6, 3), np.uint8)
    rgb[..., 0] = 200  # red
    _png(f"{d}/img/a.png", rgb)
    with open(f"{d}/img/broken.png", "wb") as f:
        f.write(b"not an image")
    assert scan_images(spark, f"{d}/img").count() == 2  # the broken one stays, marked
    imgs = scan_images(spark, f"{d}/img", drop_invalid=True)
    assert imgs.count() == 1
    dims = image_dims(imgs).first()
    assert (dims.width, dims.height) == (6, 4)
    px = imgs.first().image
    assert px.data[0] == 0 and px.data[2] == 200   # BGR order
    ann = spark.createDataFrame([(0, "img/a.png"), (1, "mg/a.png"), (2, f"{d}/img/a.png"), (3, f"file://{d}/img/a.png")],
                                "img_id long, path string")
    got = {r.img_id: r.image is not None for r in attach_images(ann, imgs, root=d).collect()}
    assert got == {0: True, 1: False, 2: True, 3: True}
    assert attach_images(ann, imgs, root=d, missing="drop").count() == 3


def test_metrics_and_detection_sinks(spark):
    d = _dir()
    wide = spark.createDataFrame([(1, 2.0, 0.5), (2, 1.0, 0.25)], "step long, total_loss double, loss_l2 double")
    long = metrics_long(wide, "step", ["total_loss", "loss_l2"])
    assert long.count() == 4
    write_metrics(wide, f"{d}/metrics", "step", ["total_loss", "loss_l2"])
    back = spark.read.parquet(f"{d}/metrics")
    assert back.filter(F.col("tag") == "loss_l2").count() == 2
    det = spark.createDataFrame([(1, 0, 0.9, 0, 0.0, 0.0, 1.0, 1.0)],
                                "img_id long, pred_id long, score double, label int, x_min double, y_min double, x_max double, y_max double")
    write_detections(det, f"{d}/det")
    assert os.path.isdir(f"{d}/det/label=0")


def test_write_shuffled_lines(spark):
    from boxframe.operators.feed import write_shuffled_lines
    d = _dir()
    lines = spark.range(50).selectExpr("id AS img_id", "concat('line ', id) AS value")
    write_shuffled_lines(lines, f"{d}/a", seed=1)
    write_shuffled_lines(lines, f"{d}/b", seed=1)
    a = [r.value for r in spark.read.text(f"{d}/a").collect()]
    b = [r.value for r in spark.read.text(f"{d}/b").collect()]
    assert a == b and sorted(a) == sorted(r.value for r in lines.collect()) and a != sorted(a)
