"""Metric goldens (invented sessions),
edge cases of the semantic contract and AUC properties."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import make_impressions
from rankfold.config import DEFAULT_FORMULA_PATH, DEFAULT_TARGETS, METRIC_API_PLATFORMS, NAV_VIDEO_FOR_YOU, TargetConfig
from rankfold.operators import metrics as M

WC30 = {"watch_coverage_30s": DEFAULT_TARGETS["watch_coverage_30s"]}

# (score, viewTimeSec, has watchCoverageRecord) -> expected AUC
GOLDEN = [
    ([(0.2, 90, True), (0.6, 10, True)], 0.0),
    ([(0.1, 40, True), (0.3, 0, True), (0.9, 5, True)], 0.0),
    ([(0.7, 3, True), (0.2, 45, True), (0.4, 29, True)], 0.0),
    ([(0.1, 31, True), (0.15, 60, True), (0.5, 2, True), (0.8, 4, True), (0.5, 6, True)], 0.0),
    ([(0.05, 1, True), (0.25, 700, True), (0.45, 100, False)], 0.5),
    ([(0.95, 300, True), (0.35, 12, True)], 1.0),
    ([(0.65, 30, True), (0.15, 500, False)], 1.0),
]


def _session(spark, rows, rid="r1"):
    return make_impressions(spark, [
        {"rid": rid, "score": s, "viewTimeSec": v,
         "events": ["actionPlay", "firstFrame", "card_view"] + (["watchCoverageRecord"] if wc else [])}
        for s, v, wc in rows])


def _metrics(df, targets=WC30, **kw):
    m, d = M.gauc(df, targets, platforms=METRIC_API_PLATFORMS, nav_screen=NAV_VIDEO_FOR_YOU,
                  formula_path=DEFAULT_FORMULA_PATH, **kw)
    return {r["target"]: r.asDict() for r in m.collect()}, d


@pytest.mark.parametrize("rows,expected", GOLDEN)
def test_golden_single_session(spark, rows, expected):
    res, details = _metrics(_session(spark, rows))
    r = res["watch_coverage_30s"]
    assert r["total_samples"] == len(rows)
    assert r["AUC"] == pytest.approx(expected)
    for k in ("GAUCSimple", "GAUCWeighted", "min", "max", "median"):
        assert r[k] == pytest.approx(expected), k
    assert r["std"] == 0.0 and r["n_groups"] == 1
    assert r["AUC_valid"] and r["GAUC_valid"] and r["AUC_error"] is None
    d = details.collect()[0]
    assert d["size"] == len(rows) and d["positives"] + d["negatives"] == len(rows)


def test_consumption_labels_counts(spark):
    res, _ = _metrics(_session(spark, GOLDEN[3][0]))
    assert res["watch_coverage_30s"]["total_positives"] == 2
    assert res["watch_coverage_30s"]["positive_rate"] == pytest.approx(0.4)


def test_single_class_sessions_and_errors(spark):
    all_pos = _session(spark, [(0.1, 100, True), (0.2, 100, True)], "p")
    res, details = _metrics(all_pos)
    r = res["watch_coverage_30s"]
    assert r["AUC"] == 0.0 and not r["AUC_valid"] and r["AUC_error"].startswith("Insufficient classes")
    assert r["n_groups"] == 0 and not r["GAUC_valid"] and r["GAUCWeighted"] == 0.0
    assert details.count() == 0


def test_single_row_and_tie(spark):
    single = _session(spark, [(0.3, 100, True)], "one")
    tie = _session(spark, [(0.5, 100, True), (0.5, 0, True)], "tie")
    res, _ = _metrics(single.unionByName(tie))
    r = res["watch_coverage_30s"]
    assert r["n_groups"] == 1 and r["GAUCSimple"] == pytest.approx(0.5)


def test_null_and_nan_scores_count_as_zero(spark):
    rows = [(float("nan"), 100, True), (None, 0, True), (0.1, 0, True)]
    df = make_impressions(spark, [{"rid": "n", "score": s, "viewTimeSec": v, "events": ["watchCoverageRecord"]}
                                  for s, v, _ in rows])
    res, _ = _metrics(df)
    # positive at 0.0 (NaN), negatives at 0.0 (NULL) and 0.1 -> (0.5 + 0) / 2
    assert res["watch_coverage_30s"]["GAUCSimple"] == pytest.approx(0.25)
    assert res["watch_coverage_30s"]["AUC"] == pytest.approx(0.25)


def test_null_rid_counts_in_auc_not_in_gauc(spark):
    df = make_impressions(spark, [
        {"rid": None, "score": 0.9, "viewTimeSec": 100, "events": ["watchCoverageRecord"]},
        {"rid": None, "score": 0.1, "viewTimeSec": 0, "events": ["watchCoverageRecord"]},
        {"rid": "a", "score": 0.1, "viewTimeSec": 100, "events": ["watchCoverageRecord"]},
        {"rid": "a", "score": 0.9, "viewTimeSec": 0, "events": ["watchCoverageRecord"]},
    ])
    res, _ = _metrics(df)
    r = res["watch_coverage_30s"]
    assert r["total_samples"] == 4 and r["n_groups"] == 1
    assert r["GAUCSimple"] == 0.0 and r["AUC"] == pytest.approx(0.5)


def test_null_events_and_null_inside_events(spark):
    df = make_impressions(spark, [
        {"rid": "e", "score": 0.9, "viewTimeSec": 100, "events": None},
        {"rid": "e", "score": 0.5, "viewTimeSec": 100, "events": [None, "x"]},
        {"rid": "e", "score": 0.1, "viewTimeSec": 100, "events": [None, "watchCoverageRecord"]},
    ])
    res, _ = _metrics(df)
    r = res["watch_coverage_30s"]
    assert r["total_positives"] == 1 and r["GAUCSimple"] == 0.0


def test_empty_slice(spark):
    df = _session(spark, GOLDEN[0][0]).withColumn("platform", F.lit("ios"))
    res, _ = _metrics(df)
    r = res["watch_coverage_30s"]
    assert r["total_samples"] == 0 and r["positive_rate"] == 0.0
    assert not r["AUC_valid"] and not r["GAUC_valid"]


def test_target_resolution_errors():
    with pytest.raises(TypeError):
        M.resolve_targets(["action_play", DEFAULT_TARGETS["first_frame"]])
    with pytest.raises(TypeError):
        M.resolve_targets("action_play")
    assert M.resolve_targets([]) == []
    assert [n for n, _ in M.resolve_targets({"k": TargetConfig("other", "actionPlay")})] == ["k"]


def test_condition_callable(spark):
    cfg = {"play_long": TargetConfig("play_long", "actionPlay", condition=lambda df: F.col("durationSeconds") > 150)}
    df = make_impressions(spark, [
        {"rid": "c", "score": 0.9, "events": ["actionPlay"], "durationSeconds": 200},
        {"rid": "c", "score": 0.1, "events": ["actionPlay"], "durationSeconds": 100},
    ])
    res, _ = _metrics(df, cfg)
    assert res["play_long"]["total_positives"] == 1 and res["play_long"]["GAUCSimple"] == 1.0


def _random_sessions(spark, n_sessions=60, seed=7):
    rnd = random.Random(seed)
    rows = []
    for s in range(n_sessions):
        for _ in range(rnd.randint(1, 9)):
            rows.append({"rid": f"s{s}", "score": round(rnd.random(), 2), "viewTimeSec": rnd.choice([0, 40]),
                         "events": ["watchCoverageRecord"]})
    return make_impressions(spark, rows)


def _brute_gauc(rows):
    by = {}
    for r in rows:
        by.setdefault(r["rid"], []).append((r["score"], 1 if r["viewTimeSec"] >= 30 else 0))
    aucs, sizes = [], []
    for items in by.values():
        pos = [s for s, y in items if y]
        neg = [s for s, y in items if not y]
        if pos and neg:
            u = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
            aucs.append(u / (len(pos) * len(neg)))
            sizes.append(len(items))
    return aucs, sizes


def test_gauc_against_brute_force_and_bucket_invariance(spark):
    df = _random_sessions(spark)
    rows = [r.asDict() for r in df.collect()]
    aucs, sizes = _brute_gauc(rows)
    for buckets, rows_ in ((1, 10**9), (3, 1), (64, 2), (64, 4), (1024, 10**9)):
        # few rows a bucket: every session is cut at its own quantiles
        res, _ = _metrics(df, score_buckets=buckets, session_rows=rows_)
        r = res["watch_coverage_30s"]
        assert r["n_groups"] == len(aucs)
        assert r["GAUCSimple"] == pytest.approx(sum(aucs) / len(aucs), abs=1e-12)
        assert r["GAUCWeighted"] == pytest.approx(sum(a * s for a, s in zip(aucs, sizes)) / sum(sizes), abs=1e-12)
        assert r["median"] == pytest.approx(sorted(aucs)[len(aucs) // 2] if len(aucs) % 2 else
                                            (sorted(aucs)[len(aucs) // 2 - 1] + sorted(aucs)[len(aucs) // 2]) / 2)


def test_auc_symmetry_and_monotone_invariance(spark):
    df = _random_sessions(spark, seed=11)
    base, _ = _metrics(df)
    neg, _ = _metrics(df.withColumn("score", -F.col("score")))
    mono, _ = _metrics(df.withColumn("score", F.exp(F.col("score") * 3)))
    b = base["watch_coverage_30s"]
    assert neg["watch_coverage_30s"]["AUC"] == pytest.approx(1 - b["AUC"], abs=1e-12)
    assert neg["watch_coverage_30s"]["GAUCSimple"] == pytest.approx(1 - b["GAUCSimple"], abs=1e-12)
    assert mono["watch_coverage_30s"]["AUC"] == pytest.approx(b["AUC"], abs=1e-12)


def test_partition_count_independence(spark):
    df = _random_sessions(spark, seed=3)
    a, _ = _metrics(df.repartition(1))
    b, _ = _metrics(df.repartition(7))
    assert a["watch_coverage_30s"]["GAUCWeighted"] == pytest.approx(b["watch_coverage_30s"]["GAUCWeighted"], abs=1e-12)


def test_compare_and_summary(spark):
    m, _ = M.gauc(_session(spark, GOLDEN[5][0]).unionByName(_session(spark, GOLDEN[0][0], "r2")), DEFAULT_TARGETS)
    cmp = {r["target"]: r for r in M.compare_auc_gauc(m).collect()}
    assert cmp["watch_coverage_30s"]["similarity"] in ("high", "medium", "low")
    one, details = M.summary(m)
    row = one.first()
    assert row["total_targets"] == 4
    assert M.lookup(details, "watch_coverage_30s", "n_groups") == 2
    with pytest.raises(KeyError):
        M.lookup(details, "watch_coverage_30s", "median")
    assert math.isfinite(row["average_gauc_weighted"])


def test_hot_session_with_one_score_value(spark):
    """A hot session whose scores are all NULL / NaN (cleaned to 0.0): every
    pair ties, AUC 0.5; the hot path combines equal scores map-side."""
    rows = [{"rid": "hot", "score": None if i % 2 else float("nan"), "viewTimeSec": 40 if i % 3 == 0 else 0,
             "events": ["watchCoverageRecord"]} for i in range(60)]
    rows += [{"rid": "n", "score": 0.9, "viewTimeSec": 40, "events": ["watchCoverageRecord"]},
             {"rid": "n", "score": 0.1, "viewTimeSec": 0, "events": ["watchCoverageRecord"]}]
    df = make_impressions(spark, rows)
    _, details = M.gauc(df, WC30, session_rows=10, score_buckets=4)
    got = {r["session_id"]: r["auc"] for r in details.collect()}
    assert got == {"hot": 0.5, "n": 1.0}
    import re
    plan = re.sub(r"#\d+L?", "", details._jdf.queryExecution().executedPlan().toString())
    # per-score counts are partial-aggregated before the first shuffle
    assert "hashpartitioning(session_id, score" in plan


def test_large_session_in_a_narrow_band_has_buckets_of_its_own(spark):
    """A session whose scores fill a small part of the slice's range is cut at its own quantiles."""
    rnd = random.Random(3)
    rows = [("wide", rnd.random(), rnd.random() < 0.5) for _ in range(900)]
    rows += [("narrow", 0.5 + rnd.random() / 1e6, rnd.random() < 0.5) for _ in range(300)]
    df = spark.createDataFrame(rows, "session_id string, score double, _y0 boolean").withColumn("_y0", F.col("_y0").cast("int"))
    cuts = {r["session_id"]: r["_cuts"] for r in M._session_cuts(df, 20).collect()}
    assert len(cuts["narrow"]) >= 14 and all(0.5 <= c <= 0.500001 for c in cuts["narrow"])
    sums = {r["session_id"]: r for r in M._sums_by_session(df, 1, 20).collect()}
    for name in ("wide", "narrow"):
        pos = [s for n, s, y in rows if n == name and y]
        neg = [s for n, s, y in rows if n == name and not y]
        assert sums[name]["U0"] == sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)


def test_no_targets_and_no_global_auc(spark):
    from rankfold.plans.evaluate import evaluate

    df = _random_sessions(spark)
    assert evaluate(df, [])["metrics"].count() == 0 and evaluate(df, [])["summary"].first()["total_targets"] == 0
    row = evaluate(df, WC30, calculate_regular_auc=False)["metrics"].first()
    assert row["AUC"] == 0.0 and row["AUC_valid"] is False and row["GAUC_valid"]


def test_approximate_median_mode(spark):
    df = _random_sessions(spark, seed=21)
    exact, _ = _metrics(df)
    approx, _ = _metrics(df, exact_median=False)
    e, a = exact["watch_coverage_30s"], approx["watch_coverage_30s"]
    assert abs(e["median"] - a["median"]) <= 0.1
    assert e["GAUCWeighted"] == a["GAUCWeighted"]


def test_median_narrows_to_the_middle_values(spark, monkeypatch):
    """Two parts a pass and a coarse first bracket: many passes, the same median as numpy."""
    import numpy as np

    monkeypatch.setattr(M, "MEDIAN_PARTS", 2)
    rng = np.random.default_rng(4)
    values = {"odd": rng.random(301), "even": rng.random(300), "ties": rng.integers(0, 4, 250) / 4, "two": np.array([0.25, 1.0]), "one": np.array([0.5])}
    rows = [(t, float(v), 2) for t, vs in values.items() for v in vs]
    details = spark.createDataFrame(rows, "target string, auc double, size long")
    got = {r["target"]: r["median"] for r in M.gauc_summary(details, accuracy=4).collect()}
    assert got == {t: float(np.median(vs)) for t, vs in values.items()}


def test_part_of_a_value_is_found_in_few_steps(spark):
    """The number of cuts below a value, for as many cuts as a session can have, without looking at each of them."""
    rows = [(list(map(float, range(n))), v) for n in (0, 1, 2, 3, 64, 999, M.SESSION_STEPS) for v in (-1.0, 0.0, 0.5, 1.0, 63.0, 998.0, 998.5, 5000.0, float("nan"))]
    df = spark.createDataFrame(rows + [([1.0, 2.0], None)], "_cuts array<double>, v double")
    got = df.select("_cuts", "v", M.part_of("v").alias("part"), F.expr("size(filter(_cuts, c -> c < v))").alias("plain"))
    assert [r["part"] for r in got.collect()] == [r["plain"] for r in got.collect()]
    counts = spark.createDataFrame([("a", 1.0, 1, 0)], "session_id string, score double, _c long, _p0 long")
    assert "filter(" not in M._sums_by_session(counts, 1, 10)._jdf.queryExecution().executedPlan().toString()
