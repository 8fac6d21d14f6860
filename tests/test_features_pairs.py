"""Graded targets, dense vectors, text round trip, pairs (invented cases and properties)."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import make_impressions
from rankfold.config import BIG_NEGATIVE
from rankfold.functions import targets as C
from rankfold.functions.targets import consumption_time
from rankfold.functions.vectors import dense_vector, index_vector, text_to_vector, text_width, vector_to_text
from rankfold.operators import features as FT
from rankfold.operators import pairs as PR

# invented (viewTimeSec, durationSeconds)
CT_CASES = [(0, 900), (1, 7), (3, 5000), (30, 1200), (61, 400), (250, 260), (1000, 1000), (2500, 3000), (9000, 9000), (20000, 40000)]


def plain_consumption(v, d):
    """The formula of the target, evaluated in plain Python."""
    if not v or not d or v <= 0 or d <= 0:
        return 0.0
    skip = C.CT_LONG_VIDEO_NWT if d > C.CT_LONG_VIDEO_SEC else min(C.CT_QUAD * d * d + C.CT_LIN * d + C.CT_CONST, d / 2)
    click = C.CT_CLICK_SHARE * skip
    watched = d / (d - skip + click) * max(v - skip, click)
    share = min(watched, C.CT_UPPER) * C._MAX_TARGET
    return share / ((min(d, C.CT_UPPER) ** C.CT_SMOOTH + C.CT_EPS) * C._TARGET_REGAIN)


def test_consumption_time_goldens(spark):
    df = spark.createDataFrame(CT_CASES, "v bigint, d bigint")
    got = [r[0] for r in df.select(consumption_time("v", "d")).collect()]
    for (v, d), g in zip(CT_CASES, got):
        assert g == pytest.approx(plain_consumption(v, d), rel=1e-12, abs=1e-15), (v, d)


def test_consumption_time_guards(spark):
    df = spark.createDataFrame([(10, 0), (10, None), (None, 100), (-5, 100)], "v bigint, d bigint")
    assert [r[0] for r in df.select(consumption_time("v", "d")).collect()] == [0.0, 0.0, 0.0, 0.0]


def _objective_rows(spark):
    """Three invented rows of one session: two unwatched, one watched for a moment."""
    feats = [[[7.0, 0.25], [40.0, 0.5], [33.0, 0.125], [2.0, 0.0]],
             [[7.0, 0.75], [40.0, 0.0625], [33.0, 0.5]],
             [[33.0, 1.5], [7.0, 0.375], [40.0, 0.03125], [9.0, 2.0]]]
    vd = [(0, 900), (0, 1200), (3, 5000)]
    return make_impressions(spark, [
        {"rid": "obj", "events": ["actionPlay", "watchCoverageRecord", "card_view"], "viewTimeSec": v,
         "durationSeconds": d, "features": f} for (v, d), f in zip(vd, feats)])


def test_objective_golden_pairs(spark):
    ft = FT.feature_table(_objective_rows(spark), [7, 40, 33], 5.0, 14.0, 0.41)
    rows = sorted(ft.collect(), key=lambda r: r["pos"])
    assert [r["like_target"] for r in rows] == [0.0, 0.0, 0.0]
    assert [r["dislike_target"] for r in rows] == [1.0, 1.0, 1.0]
    assert rows[2]["consumption_time_target"] == pytest.approx(plain_consumption(3, 5000))
    assert rows[0]["features"] == pytest.approx([0.25, 0.5, 0.125], rel=1e-6)
    pairs = PR.pair_table(ft).collect()
    assert len(pairs) == 2
    assert {(p["winner_pos"], p["loser_pos"]) for p in pairs} == {(2, 0), (2, 1)}
    assert all(p["target"] == "consumption_time" for p in pairs)
    assert pairs[0]["pair_weight"] == pytest.approx(0.41 * plain_consumption(3, 5000), rel=1e-8)


def test_dense_vector_rules(spark):
    df = spark.createDataFrame([
        ([[1.0, 0.123456789123], [2.0, 5.0], [1.0, 7.0], [3.0], [9.0, None], [2.9, 1.5]],),
        (None,),
        ([],),
    ], "features array<array<double>>")
    out = [r[0] for r in df.select(dense_vector("features", [1, 2, 3, 9])).collect()]
    d = float(BIG_NEGATIVE)
    assert out[0][0] == pytest.approx(7.0)          # last duplicate wins
    assert out[0][1] == pytest.approx(1.5)          # 2.9 truncates to id 2, later pair wins
    assert out[0][2] == pytest.approx(d, rel=1e-6)  # short pair skipped
    assert out[0][3] == pytest.approx(d, rel=1e-6)  # NULL value skipped
    assert out[1] == pytest.approx([d] * 4, rel=1e-6)
    assert out[2] == pytest.approx([d] * 4, rel=1e-6)
    idx = [r[0] for r in df.select(index_vector("features", 4)).collect()]
    assert idx[0] == pytest.approx([0.0, 7.0, 1.5, 0.0])
    with pytest.raises(ValueError):
        dense_vector("features", [1, 1])


def test_text_roundtrip_and_import_rules(spark):
    vals = [0.0, 10.0, 100.0, 1e10, -3.4e38, 1e-10, float("nan"), 0.06]
    df = spark.createDataFrame([(1.0000000001, vals)], "label double, features array<float>")
    text = df.select(vector_to_text("label", "features").alias("value"))
    n = text.select(text_width("value")).first()[0]
    assert n == len(vals)
    back = text.select(text_to_vector("value", n).alias("v"), F.split("value", "\t")[0].cast("double").alias("l")).first()
    exp = df.first()["features"]
    for a, b in zip(back["v"], exp):
        assert (math.isnan(a) and math.isnan(b)) or a == b
    assert back["l"] == 1.0000000001
    odd = spark.createDataFrame([("1\t1\tx\t2.5",), ("1\t1",), ("1\t1\t3",)], "value string")
    got = [r[0] for r in odd.select(text_to_vector("value", 3)).collect()]
    assert math.isnan(got[0][0]) and got[0][1:] == [2.5, 0.0]
    assert got[1] == [0.0, 0.0, 0.0] and got[2] == [3.0, 0.0, 0.0]


def _random_feature_table(spark, seed=5):
    rnd = random.Random(seed)
    rows = []
    for s in range(25):
        for _ in range(rnd.randint(1, 8)):
            ev = rnd.sample(["actionLike", "actionDislike", "watchCoverageRecord", "card_view", "actionUnlike"], 2)
            rows.append({"rid": f"q{s}", "events": ev, "viewTimeSec": rnd.choice([0, 10, 300]),
                         "durationSeconds": rnd.choice([100, 4000]), "features": [[1.0, rnd.random()]]})
    return FT.feature_table(make_impressions(spark, rows), [1], 1.0, 2.0, 3.0)


def test_pair_properties(spark):
    ft = _random_feature_table(spark)
    rows = ft.collect()
    pairs = PR.pair_table(ft).collect()
    tgt = {(r["rid"], r["pos"]): {t["name"]: t["target"] for t in r["targets"]} for r in rows}
    # every pair has winner target > loser target and the right weight
    w = {"like": 1.0, "dislike": 2.0, "consumption_time": 3.0}
    for p in pairs:
        tw, tl = tgt[(p["rid"], p["winner_pos"])][p["target"]], tgt[(p["rid"], p["loser_pos"])][p["target"]]
        assert tw > tl and p["pair_weight"] == pytest.approx(w[p["target"]] * (tw - tl))
    # count = number of index pairs with different targets
    expected = 0
    by = {}
    for (rid, pos), t in tgt.items():
        by.setdefault(rid, []).append(t)
    for items in by.values():
        for i in range(len(items)):
            for j in range(i + 1, len(items)):
                expected += sum(1 for k in w if items[i][k] != items[j][k] and abs(w[k] * (items[i][k] - items[j][k])) >= 1e-8)
    assert len(pairs) == expected
    totals = {(r["rid"], r["target"]): r for r in PR.pair_totals(ft).collect()}
    assert sum(r["n_pairs"] for r in totals.values()) >= len(pairs)


def test_export_import_and_labels(spark):
    ft = _random_feature_table(spark, seed=9)
    pairs = PR.pair_table(ft)
    idx = PR.row_index(ft)
    n = idx.count()
    assert sorted(r[0] for r in idx.select("row_index").collect()) == list(range(n))
    back = PR.import_pairs(PR.export_pairs(PR.pair_table(idx, carry=("row_index",))), n)
    assert back.count() == pairs.count()
    bad = spark.createDataFrame([("0", "1"), ("x", "1\t0.5"), ("0", f"{n}\t0.5"), ("0", "1\t0.5")],
                                "key string, value string").withColumn("target", F.lit("like"))
    assert PR.import_pairs(bad, n).count() == 1
    labels = PR.win_labels(ft).collect()
    plain = {}
    for p in pairs.collect():
        plain[p["rid"], p["winner_pos"]] = plain.get((p["rid"], p["winner_pos"]), 0) + 1
    assert {(r["rid"], r["pos"]): r["wins"] for r in labels if r["wins"]} == plain and len(labels) == ft.count()
    assert max(r["win_label"] for r in labels) == pytest.approx(1.0)
    ids, stats = PR.group_sizes(ft)
    s = stats.first()
    assert sorted(r["group_id"] for r in ids.collect()) == list(range(s["n_groups"]))
    assert s["min_size"] >= 1


def test_win_labels_of_a_long_session(spark):
    """100,000 rows in one session: five thousand million pairs, none of them formed."""
    n = 100_000
    t = F.struct(F.lit("like").alias("name"), (F.col("id") % 1000).cast("double").alias("target"), F.lit(2.0).alias("weight"))
    ft = spark.range(n).select(F.lit("s").alias("rid"), F.col("id").cast("int").alias("pos"), F.array(t).alias("targets"))
    got = PR.win_labels(ft).agg(F.sum("wins"), F.max("win_label")).first()
    assert tuple(got) == (100 * 100 * 1000 * 999 // 2, 1.0)
