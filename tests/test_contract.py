"""Remaining rows of the semantic contract and property tests."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import make_impressions
from rankfold.config import BIG_NEGATIVE, DEFAULT_TARGETS
from rankfold.functions.vectors import dense_vector
from rankfold.operators import features as FT
from rankfold.operators import metrics as M
from rankfold.operators import ranker as RK

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_nan_targets_count_as_one_value(spark):  # 2.13-13
    df = spark.createDataFrame([([("like", float("nan"), 1.0), ("dislike", float("nan"), 1.0),
                                  ("consumption_time", float("nan"), 1.0)],),
                                ([("like", 1.0, 1.0), ("dislike", float("nan"), 1.0),
                                  ("consumption_time", 1.0, 1.0)],)],
                               "targets array<struct<name:string,target:double,weight:double>>")
    assert FT.informative(df).count() == 1


def test_positions_from_tiebreak_or_row_hash(spark):  # 2.13-15
    df = spark.createDataFrame([("a", 3, 0.1), ("a", 1, 0.2), ("b", 2, 0.3)], "rid string, k int, score double")
    got = {(r["rid"], r["k"]): r["pos"] for r in FT.with_positions(df, tiebreak=["k"]).collect()}
    assert got == {("a", 1): 0, ("a", 3): 1, ("b", 2): 0}
    again = [sorted((r["k"], r["pos"]) for r in FT.with_positions(df.repartition(n)).collect()) for n in (1, 3)]
    assert again[0] == again[1]


def test_eight_digit_rounding_before_float(spark):  # 2.13-17
    df = spark.createDataFrame([([[1.0, 0.123456789123]],)], "features array<array<double>>")
    v = df.select(dense_vector("features", [1])).first()[0][0]
    assert v == pytest.approx(float(round(0.123456789123, 8)), rel=1e-7)


def test_seeded_noise_is_reproducible(spark):  # 2.13-22
    df = spark.createDataFrame([([float(i)],) for i in range(20)], "features array<float>").coalesce(2)
    a = [r[0] for r in RK.score(df, [1.0], noise=0.5, seed=7).select("model_score").collect()]
    b = [r[0] for r in RK.score(df, [1.0], noise=0.5, seed=7).select("model_score").collect()]
    assert a == b and any(abs(x - i) > 1e-9 for i, x in enumerate(a))


pairs_st = st.lists(st.tuples(st.integers(0, 6), st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False))),
                    max_size=12)


@SETTINGS
@given(rows=st.lists(pairs_st, min_size=1, max_size=6), vocab=st.lists(st.integers(0, 7), unique=True, max_size=5))
def test_dense_vector_matches_python_model(spark, rows, vocab):
    df = spark.createDataFrame([([[float(i), v] for i, v in r],) for r in rows], "features array<array<double>>")
    got = [r[0] for r in df.select(dense_vector("features", vocab)).collect()]
    for r, g in zip(rows, got):
        want = {fid: float(BIG_NEGATIVE) for fid in vocab}
        for i, v in r:
            if v is not None and i in want:
                want[i] = round(v, 8)
        assert g == pytest.approx([want[f] for f in vocab], rel=1e-6)


sess_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 4), st.booleans()),
                   min_size=1, max_size=25)


@SETTINGS
@given(rows=sess_st, hot=st.sampled_from([10**9, 1]))
def test_session_auc_matches_brute_force(spark, rows, hot):
    df = make_impressions(spark, [{"rid": r, "score": s / 4, "viewTimeSec": 40 if y else 0,
                                   "events": ["watchCoverageRecord"]} for r, s, y in rows])
    _, details = M.gauc(df, {"w": DEFAULT_TARGETS["watch_coverage_30s"]}, session_rows=hot)
    got = {r["session_id"]: r["auc"] for r in details.collect()}
    want = {}
    for rid in {r for r, _, _ in rows}:
        pos = [s for r, s, y in rows if r == rid and y]
        neg = [s for r, s, y in rows if r == rid and not y]
        if pos and neg:
            want[rid] = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-12)
    assert all(not math.isnan(v) for v in got.values())


def test_feature_map_dict_form(spark):  # X4: same defaults as the dense path
    from rankfold.functions.vectors import feature_map
    df = spark.createDataFrame([([[5.0, 1.0], [7.0, 2.123456789], [5.0, 3.0], [9.0]],)], "features array<array<double>>")
    m = df.select(feature_map("features")).first()[0]
    assert m == {5: 3.0, 7: pytest.approx(2.12345679)}
