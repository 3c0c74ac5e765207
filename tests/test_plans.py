"""Plan checks: no Cartesian products, no Python in Column-only
operators, score masks pushed into parquet scans."""

import tempfile

import pytest

from boxframe.operators.nms import nms
from boxframe.plans.catalog import queries
from tests.conftest import SF_SMALL

QUERIES = queries()
COLUMN_ONLY = ["nms", "nms_py", "voc_eval_raw", "voc_ap_11pt", "pr_curve", "box_iou", "assign_anchors",
               "encode_targets", "box_transforms", "crop_boxes", "decode", "decode_nms", "scan_annotations",
               "truth_table", "overlap_pairs", "detection_loss", "lr_schedule", "meters", "meters_window",
               "metrics_long", "epoch_batches", "mixup_pairs", "score_head", "augment_boxes", "augment_params", "augment_targets",
               "dense_targets", "detection_loss_batch_scope", "decode_voc", "nms_mosaic", "voc_eval"]
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", COLUMN_ONLY)
def test_no_cartesian_and_no_python(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not any(p in plan for p in PYTHON_NODES), name


def test_score_mask_and_columns_reach_the_scan(spark):
    d = tempfile.mkdtemp(prefix="bf-plan-")
    QUERIES["decode"]  # noqa: B018 - registry loaded
    from boxframe.plans.fixtures import Tables
    Tables(spark, SF_SMALL).pred.write.parquet(f"{d}/pred")
    det = spark.read.parquet(f"{d}/pred")
    plan = _plan(nms(det.select("img_id", "label", "pred_id", "score", "x_min", "y_min", "x_max", "y_max"),
                     strategy="fold"))
    assert "IsNotNull(score)" in plan and "GreaterThanOrEqual(score,0.5)" in plan.split("PushedFilters:")[1]
    from boxframe.operators.match import class_counts
    counts = _plan(class_counts(det))
    assert "ReadSchema: struct<label:int>" in counts
