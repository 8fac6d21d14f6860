"""The pairwise fit over session blocks, hot sessions in parts, and the Arrow kernel, against plain versions."""

import math
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import make_impressions
from rankfold.functions.vectors import scatter
from rankfold.operators import pairfit as PF
from rankfold.operators import pairs as PR
from rankfold.operators import tuning as TU
from rankfold.sources import extracts as X

SCHEMA = "rid string, pos long, features array<float>, targets array<struct<name: string, target: double, weight: double>>"
NAMES = ("like", "dislike", "consumption_time")
WEIGHTS = (5.0, 14.0, 0.41)


def feature_rows(seed=1, sessions=25, width=3):
    rng = random.Random(seed)
    rows = []
    for s in range(sessions):
        for pos in range(rng.randint(1, 12)):
            x = [rng.choice([rng.uniform(-2, 2), 0.0, float("nan"), -3.4e38]) for _ in range(width)]
            t = (float(rng.random() < 0.3), float(rng.random() < 0.8), rng.choice([0.0, rng.uniform(0, 5)]))
            rows.append((None if s == 0 else f"s{s}", pos, x, [(n, v, w) for n, v, w in zip(NAMES, t, WEIGHTS)]))
    return rows


def plain_objective(rows, beta, weights):
    """Loss, weight, pairs and gradient, pair by pair."""
    loss = total = many = 0.0
    slope = np.zeros(len(beta))
    clean = lambda x: np.array([0.0 if math.isnan(v) or v < -1e38 else float(np.float32(v)) for v in x])
    for a in rows:
        for b in rows:
            if a[0] is None or a[0] != b[0]:
                continue
            for k, w in enumerate(weights):
                p = w * (a[3][k][1] - b[3][k][1])
                if a[3][k][1] > b[3][k][1] and abs(p) >= 1e-8:
                    d = clean(a[2]) - clean(b[2])
                    m = float(d @ beta)
                    loss += p * math.log1p(math.exp(-m))
                    slope += -p / (1 + math.exp(m)) * d
                    total += p
                    many += 1
    return loss, total, many, slope


@pytest.mark.parametrize("block_rows", [2048, 4, 1])
def test_losses_against_all_pairs(spark, block_rows):
    rows = feature_rows()
    blocks = PF.session_blocks(spark.createDataFrame(rows, SCHEMA).repartition(3), block_rows)
    beta, weights = np.array([[0.3, -0.7, 1.1], [0.0, 0.0, 0.0]]), np.array([WEIGHTS, (1.0, 0.0, 2.0)])
    loss, total, many, slope = PF.losses(blocks, beta, weights, several=True)
    for f in range(2):
        want = plain_objective(rows, beta[f], weights[f])
        assert (loss[f], total[f], many[f]) == pytest.approx(want[:3]) and slope[f] == pytest.approx(want[3])


def test_fits_together_equal_fits_alone_and_are_optimal(spark):
    rows = feature_rows(5, 60)
    blocks = PF.session_blocks(spark.createDataFrame(rows, SCHEMA)).cache()
    triples = [WEIGHTS, (1.0, 1.0, 1.0), (0.0, 0.0, 0.0)]
    fits = PF.fit_rankers(blocks, triples, 3, tol=1e-9)
    for f, triple in enumerate(triples[:2]):
        alone = PF.fit_rankers(blocks, [triple], 3, tol=1e-9)[0]
        assert fits[f].coefficients == pytest.approx(alone.coefficients, abs=1e-7) and fits[f].residual <= 1e-9 and fits[f].n_pairs == alone.n_pairs
        base = plain_objective(rows, np.array(fits[f].coefficients), triple)[0]
        for j in range(3):
            for step in (0.2, -0.2):
                moved = np.array(fits[f].coefficients)
                moved[j] += step
                assert plain_objective(rows, moved, triple)[0] > base - 0.05 * abs(base)
    assert fits[2].n_pairs == 0 and fits[2].coefficients == [0.0, 0.0, 0.0]
    blocks.unpersist()


def test_fit_without_rows_or_entries(spark):
    none = PF.session_blocks(spark.createDataFrame([], SCHEMA))
    assert PF.fit_rankers(none, [WEIGHTS], 3)[0].coefficients == [0.0, 0.0, 0.0]
    assert PF.fit_rankers(none, [WEIGHTS], 0)[0].coefficients == []


def test_trials_together_give_the_same_table(spark):
    rows = [{"rid": f"t{s}", "score": 0.1 * k, "events": ["watchCoverageRecord", "actionPlay"] + (["actionLike"] if (k + s) % 4 == 0 else []),
             "viewTimeSec": 20 * ((k + s) % 4), "durationSeconds": 300, "features": [[1.0, float((k + s) % 4)], [2.0, float(k)]]}
            for s in range(30) for k in range(4)]
    df = make_impressions(spark, rows)
    data = TU.prepare_search(df, df, [1, 2])
    tables = [sorted((r["trial"], round(r["value"], 9), r["n_pairs"]) for r in TU.search(spark, data, n_trials=3, timeout=None, together=k).collect()) for k in (1, 3)]
    assert tables[0] == tables[1]


@pytest.mark.parametrize("session_rows", [2_000_000, 15, 3])
def test_hot_sessions_in_parts(spark, session_rows):
    rng = random.Random(9)
    rows = []
    for k in range(400):
        t = rng.choice([0.0, 1.0, round(rng.uniform(0, 3), 2), 1.0 + 5e-9])
        rows.append(("hot" if k % 3 else f"s{k % 7}", k, [0.0], [("a", t, 2.0), ("b", None if k % 5 == 0 else float(k % 2), 1.0)]))
    ft = spark.createDataFrame(rows, SCHEMA).repartition(4)
    totals, wins = {}, {}
    for a in rows:
        wins.setdefault((a[0], a[1]), 0)
        for b in rows:
            if a[0] != b[0]:
                continue
            for k, name in enumerate("ab"):
                x, y, w = a[3][k][1], b[3][k][1], a[3][k][2]
                if x is not None and y is not None and x > y:
                    n, s = totals.get((a[0], name), (0, 0.0))
                    totals[a[0], name] = (n + 1, s + x - y)
                    wins[a[0], a[1]] += w * y <= w * x - 1e-8
    got = {(r["rid"], r["target"]): (r["n_pairs"], r["total_raw_weight"]) for r in PR.pair_totals(ft, session_rows=session_rows).collect()}
    assert got.keys() == totals.keys() and all(got[k][0] == totals[k][0] and got[k][1] == pytest.approx(totals[k][1]) for k in got)
    assert {(r["rid"], r["pos"]): r["wins"] for r in PR.win_labels(ft, session_rows=session_rows).collect()} == wins


def test_parts_spread_a_hot_session(spark):
    ft = spark.range(20_000).selectExpr("'hot' as rid", "id as pos", "array(named_struct('name', 'a', 'target', double(pmod(id * 7919, 5000)), 'weight', 1.0D)) as targets")
    long = PR.unnest_targets(ft).selectExpr("rid", "name", "double(target) as v")
    cuts = PR._cuts(ft, "rid", long, "v", 1_000)
    sizes = [r["count"] for r in PR._with_part(long, cuts, "v").groupBy("part").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 2_500


def test_scatter_against_plain_version():
    rng = random.Random(3)
    vocab = [7, -2, 0, 5, 100]
    rows = [None, [], [None], [[]], [[7.0]], [[7.9, 1.0], [7.2, None], [-2.5, 2.0], [None, 3.0], [float("nan"), 1.0], [float("inf"), 1.0]]]
    for _ in range(200):
        rows.append([[rng.choice([7.0, -2.0, 0.4, 5.0, 100.0, 6.0, 1e300]), rng.choice([None, rng.uniform(-1, 1), 1e10, float("nan")])] for _ in range(rng.randint(0, 9))])
    got = scatter(pa.array(rows, pa.list_(pa.list_(pa.float64()))), vocab, -1.0, 8).to_pylist()
    text = [None if r is None else [None if p is None else [None if v is None else repr(v) for v in p] for p in r] for r in rows]
    assert str(scatter(pa.array(text, pa.list_(pa.list_(pa.string()))), vocab, -1.0, 8).to_pylist()) == str(got)
    for r, out in zip(rows, got):
        last = {}
        for p in r or []:
            if p and len(p) >= 2 and p[0] is not None and p[1] is not None and math.isfinite(p[0]):
                last[math.trunc(p[0])] = p[1]
        for k, v in zip(vocab, out):
            want = last.get(k, -1.0)
            assert (math.isnan(v) and math.isnan(want)) or v == pytest.approx(want, abs=2e-8, rel=1e-6)


def test_filter_lies_below_the_position_window(spark, tmp_dir):
    path = f"{tmp_dir}/imp.jsonl"
    with open(path, "w") as f:
        for k in range(6):
            f.write('{"rid": %s, "platform": "%s", "score": "0.5"}\n' % ('"a"' if k < 4 else "null", "x" if k % 2 else "y"))
    got = X.read_impressions(spark, path, where=F.col("platform") == "x")
    assert sorted((r["rid"] or "", r["pos"]) for r in got.collect()) == [("", 0), ("a", 0), ("a", 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Filter")  # the filter is nearer to the scan
    assert "EqualTo(platform,x)" in got._jdf.queryExecution().executedPlan().toString()


def test_extract_of_a_table_without_positions(spark):
    df = make_impressions(spark, [{"rid": f"r{k % 3}", "score": float(k), "events": ["actionPlay"]} for k in range(9)]).drop("pos")
    got = X.training_extract(df, limit=5, platforms=["android", "vk_video_android"])
    assert got.count() <= 5 and "pos" in got.columns


def test_feature_table_is_made_once_and_tasks_grow(spark, monkeypatch):
    """Totals, normalised pairs and win labels read a kept table of targets, and large ones are dealt over more tasks."""
    from rankfold import session
    from rankfold.operators import pairs as PR

    kept, real = [], PR.written
    monkeypatch.setattr(PR, "written", lambda df: kept.append(df) or real(df))
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    target = "array(struct('a' as name, cast(id % 7 as double) as target, 2D as weight))"
    ft = spark.range(200).selectExpr("cast(id % 9 as string) as rid", "id as pos", f"{target} as targets")
    for made in (PR.pair_totals(ft), PR.win_labels(ft), PR.pair_table(ft, normalize=True)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Range (" not in plan and ", 20)" in plan.replace(", REPARTITION", ")").replace("))", ")")
    assert len(kept) == 3
    assert session.tasks_for(spark, 5) is None and session.tasks_for(spark, 10**4) == 1000


def test_blocks_and_classifier_read_their_rows_once(spark, monkeypatch):
    """The rows that blocks are made of and the matrix of the classifier are written once, whatever reads them later."""
    from rankfold.operators import pairfit as PF
    from rankfold.operators import ranker as RK

    kept = []
    for module in (PF, RK):
        real = module.written
        monkeypatch.setattr(module, "written", lambda df, real=real: kept.append(df) or real(df))
    target = "array(struct('a' as name, cast(id % 7 as double) as target, 2D as weight))"
    ft = spark.range(50).selectExpr("cast(id % 3 as string) as rid", "id as pos", "array(float(id)) as features", f"{target} as targets")
    assert "Range (" not in PF.session_blocks(ft, block_rows=4)._jdf.queryExecution().executedPlan().toString() and len(kept) == 1
    x = spark.range(60).selectExpr("id", "cast(id % 5 as double) as feat_1", "cast(id % 3 = 0 as int) as label")
    RK.linear_classifier(x, ["feat_1"])
    assert len(kept) == 2 and kept[1].columns == ["feat_1", "label"]


def test_impressions_are_dealt_over_more_tasks(spark, monkeypatch):
    """More lines than the session's partitions hold: lines, orders and parts are dealt by key over as many tasks; the same rows."""
    from rankfold import session
    from rankfold.sources import testdata as TD

    sf = os.environ.get("RANKFOLD_TEST_SF", "/root/testdata/sf0.001")
    if not os.path.exists(sf):
        pytest.skip("test tables not present")
    few = TD.impressions(spark, sf)
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    monkeypatch.setattr(TD, "LARGE_PARTS", 10)
    many = TD.impressions(spark, sf)
    tasks = -(-spark.read.parquet(f"{sf}/lineitem.parquet").count() // 500)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f", {tasks}), REPARTITION_BY_NUM") >= 3 and "SortMergeJoin" not in plan
    digest = F.expr("bit_xor(xxhash64(*))")
    assert few.agg(F.count("*"), digest).first() == many.agg(F.count("*"), digest).first()
