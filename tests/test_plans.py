"""Plan-shape contract of the registered queries (the scale rules, checked on
the physical plans): no cross products or nested-loop joins, no row-wise Python UDF
operators and of the Arrow ones only the dense-vector kernel, filters reach the Parquet scan, and GAUC keeps a fixed number of
shuffles."""

import os
import re

import pytest

import __spark_entry__ as E

SF = os.environ.get("RANKFOLD_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas")
MODEL_BASED = {"pairwise_ranker_gauc", "trial_best", "linear_classifier_auc"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", sorted(set(E.queries()) - MODEL_BASED))
def test_no_cross_products_or_python(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"
    for called in re.findall(r"ArrowEvalPython \[(\w+)\(", plan):
        assert called == "dense", f"{name}: {called} in plan"


def test_slice_filters_reach_a_stored_scan(spark, tmp_dir):
    """On a stored impression table the F1/F3/F4 predicates are pushed into the
    Parquet scan and only the needed columns are read."""
    from conftest import make_impressions
    from rankfold.operators.metrics import eval_slice
    from rankfold.sources.extracts import slice_projection, training_extract
    path = os.path.join(tmp_dir, "imp")
    make_impressions(spark, [{"rid": "a"}, {"rid": "b", "platform": "ios"}]).write.parquet(path)
    df = spark.read.parquet(path)
    for q in (slice_projection(df), training_extract(df, limit=None),
              eval_slice(df, "video_for_you", ["android"], "f").select("rid")):
        text = _formatted(q)
        assert "EqualTo(navScreen,video_for_you)" in text and "platform" in text.split("PushedFilters")[1], text
    pruned = _formatted(eval_slice(df, "video_for_you", ["android"], "f").select("rid"))
    assert "features" not in pruned.split("ReadSchema")[1].splitlines()[0]


def test_gauc_shuffle_budget(spark):
    plan = _plan(E.queries()["gauc_group_details"](spark, SF))
    # source clustering (x2: main + hot-session count), hot-session count,
    # the (session, bucket) shuffle and the per-session shuffle
    n = len(re.findall(r"Exchange hashpartitioning", plan))
    assert n <= 5, plan
    assert "hashpartitioning(session_id" in plan


def test_metric_job_reads_its_source_once(spark, monkeypatch):
    """Details, counts and global AUC come from the kept table: no plan but the one that writes it holds a source table."""
    from rankfold.operators import metrics as M
    from rankfold.sources.testdata import impressions
    kept = []
    real = M.written
    monkeypatch.setattr(M, "written", lambda df: kept.append(df) or real(df))
    labeled, details = M.gauc(impressions(spark, SF), ["action_play", "first_frame"])
    assert sum("lineitem" in _plan(df) for df in kept) == 1
    assert "lineitem" not in _plan(details) and "lineitem" not in _plan(labeled)
