"""Trials together: one read of the rows for all scores, the same values as score by score."""

import math
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import make_impressions
from rankfold.config import DEFAULT_TARGETS
from rankfold.functions import vectors as V
from rankfold.operators import features as FT
from rankfold.operators import metrics as M
from rankfold.operators import ranker as RK
from rankfold.operators import tuning as TU
from rankfold.operators.sessions import whole_sessions

WC30 = {"w": DEFAULT_TARGETS["watch_coverage_30s"], "p": DEFAULT_TARGETS["action_play"]}


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_whole_sessions_at_any_batch_size(size):
    rng = random.Random(size)
    keys = [(s, b) for s in ("a", "b", "c", "d", "e") for b in range(rng.randint(1, 3)) for _ in range(rng.choice([1, 1, 2, 9]))]
    rows = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array(range(len(keys)))], ["s", "b", "i"])
    batches = [rows.slice(k, size) for k in range(0, len(keys), size)] + [rows.slice(0, 0)]
    seen, sessions = [], []
    for batch, starts in whole_sessions(iter(batches), 2):
        ends = [*starts[1:].tolist(), batch.num_rows]
        for a, b in zip(starts.tolist(), ends):
            sessions.append({(r["s"], r["b"]) for r in batch.slice(a, b - a).to_pylist()})
        seen += batch.column(2).to_pylist()
    assert seen == list(range(len(keys))) and all(len(s) == 1 for s in sessions)
    assert [next(iter(s)) for s in sessions] == list(dict.fromkeys(keys))


def scored(spark):
    rng = random.Random(4)
    rows = []
    for k in range(300):
        rid = None if k % 50 == 0 else "hot" if k % 4 == 0 else f"s{k % 40}"
        rows.append({"rid": rid, "score": rng.choice([0.0, -0.0, 0.5, 1.0, None, float("nan"), rng.random()]), "viewTimeSec": rng.choice([0, 40]),
                     "events": rng.choice([["watchCoverageRecord"], ["actionPlay", "watchCoverageRecord"], []])})
    return make_impressions(spark, rows).withColumns({"other": -F.col("score"), "flat": F.lit(1.0)}).repartition(3)


@pytest.mark.parametrize("session_rows", [2_000_000, 10])
def test_scores_together_equal_scores_alone(spark, session_rows):
    df, columns = scored(spark), ["score", "other", "flat"]
    together = M.gauc(df, WC30, score_col=columns, session_rows=session_rows)
    for column, (metrics, details) in zip(columns, together, strict=True):
        want, want_details = M.gauc(df, WC30, score_col=column)
        for a, b in ((metrics, want), (details, want_details)):
            assert a.columns == b.columns
            keys = [c for c in ("target", "session_id") if c in a.columns]
            a, b = ([r.asDict() for r in t.orderBy(*keys).collect()] for t in (a, b))
            assert len(a) == len(b) > 0
            for x, y in zip(a, b):
                assert all(x[c] == y[c] or math.isclose(x[c], y[c], rel_tol=1e-12, abs_tol=1e-12) for c in x)


def test_scores_together_read_the_rows_once(spark, monkeypatch):
    kept, real = [], M.written
    monkeypatch.setattr(M, "written", lambda df: kept.append(df) or real(df))
    df = scored(spark)
    found = M.gauc(df, WC30, score_col=["score", "other", "flat"], calculate_regular_auc=False, exact_median=False)
    source = [k for k in kept if "viewTimeSec" in k._jdf.queryExecution().analyzed().toString()]
    assert len(found) == 3 and len(source) == 1


def test_a_grid_is_measured_in_one_call(spark):
    df, calls = scored(spark), []

    def measure(data, weights, model_paths=None):
        calls.append(list(weights))
        return [(w[0], 0) for w in weights]

    grid = [(1.0, 2.0, 3.0), (5.0, 1.0, 0.5), (0.0, 1.0, 1.0)]
    trials = TU.search(spark, TU.SearchData(df, df, "w", WC30), timeout=None, grid=grid, objectives=measure)
    assert calls == [grid] and TU.best_trial(trials).first()["trial"] == 1
    TU.search(spark, TU.SearchData(df, df, "w", WC30), timeout=None, grid=grid, objectives=measure, together=2)
    assert calls[1:] == [grid[:2], grid[2:]] and not df.is_cached


def test_validation_is_kept_only_for_several_readings(spark, monkeypatch):
    df = make_impressions(spark, [{"rid": f"t{k // 4}", "events": ["watchCoverageRecord", "actionLike"][: 1 + k % 2], "viewTimeSec": 10 * (k % 5),
                                   "durationSeconds": 100, "features": [[1.0, float(k % 4)]]} for k in range(40)])
    kept = []
    monkeypatch.setattr(TU, "evaluate_together", lambda data, triples, **kw: kept.append(data.validation.is_cached) or [(0.0, 0)] * len(triples))
    data = TU.prepare_search(df, df, [1])
    TU.search(spark, data, n_trials=3, timeout=None)
    TU.search(spark, data, n_trials=3, timeout=None, together=2)
    assert kept == [False, True, True] and not data.validation.is_cached


def test_unrolled_score_equals_the_long_form(spark, monkeypatch):
    rows = [([1.0, float("nan"), -3.4e38],), ([0.1, 0.2, 0.3],), ([1.0, None, 2.0],), ([1.0],), ([1.0, 2.0, 3.0, 4.0],), (None,), ([],)]
    df = spark.createDataFrame(rows, "features array<float>")
    short = [r[0] for r in RK.score(df, [0.1, 0.7, -0.3]).select("model_score").collect()]
    monkeypatch.setattr(V, "UNROLLED", 0)
    assert short == [r[0] for r in RK.score(df, [0.1, 0.7, -0.3]).select("model_score").collect()]
    assert short[0] == pytest.approx(0.1) and short[2:6] == [None] * 4


def test_feature_table_keeps_the_informative_rows(spark):
    events = [["actionLike"], ["watchCoverageRecord", "actionDislike"], ["card_view"], ["actionLike", "actionDislike"], ["actionLike", "actionUnlike", "actionDislike"]]
    df = make_impressions(spark, [{"events": e, "viewTimeSec": v, "durationSeconds": d} for e in events for v in (0, 50, None) for d in (100, 0, None)])
    every = FT.feature_table(df, [1], 1.0, 1.0, 1.0, keep_informative_only=False)
    got = FT.feature_table(df, [1], 1.0, 1.0, 1.0)
    assert sorted(r["pos"] for r in got.collect()) == sorted(r["pos"] for r in FT.informative(every).collect())
    assert 0 < got.count() < every.count()
    assert "array_distinct" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_impressions_are_numbered_before_their_pairs_are_made(spark):
    from rankfold.sources.testdata import impressions

    sf = os.environ.get("RANKFOLD_TEST_SF", "/root/testdata/sf0.001")
    if not os.path.exists(sf):
        pytest.skip("test tables not present")
    plan = impressions(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
    assert plan.index("AS features") < plan.index("row_number()") < plan.index("AS events")
