"""Vocabulary resolution, model persistence, weight search and the end-to-end jobs."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import make_impressions
from rankfold.operators import features as FT
from rankfold.operators import pairs as PR
from rankfold.operators import ranker as RK
from rankfold.operators import tuning as TU
from rankfold.plans import jobs as J


def test_vocabulary_resolution(spark, tmp_dir):
    path = os.path.join(tmp_dir, "names.txt")
    with open(path, "w") as f:
        f.write("  b.name \nunknown\na.name\n\nc.name\nd.same_id\n")
    names = FT.read_feature_names(spark, path)
    assert [r["feature_name"] for r in names.orderBy("idx").collect()] == ["b.name", "unknown", "a.name", "c.name",
                                                                            "d.same_id"]
    dictionary = spark.createDataFrame([("a.name", 8090), ("b.name", 14836), ("c.name", 14823), ("d.same_id", 8090)],
                                       "feature_name string, feature_id int")
    vocab = FT.resolve_vocabulary(names, dictionary)
    # file order kept, unknown dropped, a repeated id keeps one (the last) position
    assert FT.vocabulary_ids(vocab) == [14836, 14823, 8090]


def _train_rows(spark, n_sessions=40):
    rows = []
    for s in range(n_sessions):
        for k in range(4):
            good = (k + s) % 4
            rows.append({"rid": f"t{s}", "score": 0.1 * k,
                         "events": ["watchCoverageRecord", "actionPlay"] + (["actionLike"] if good == 0 else []),
                         "viewTimeSec": 20 * good, "durationSeconds": 300,
                         "features": [[1.0, float(good)], [2.0, float(k)]]})
    return make_impressions(spark, rows)


def test_normalized_pair_weights(spark):
    ft = FT.feature_table(_train_rows(spark, 3), [1, 2], 1.0, 1.0, 1.0)
    p = PR.pair_table(ft, normalize=True)
    sums = p.groupBy("rid", "target").agg(F.sum("pair_weight").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1.0) for r in sums)


def test_model_save_load_and_score_job(spark, tmp_dir):
    df = _train_rows(spark)
    # consumption time only: it grows with feature 1 (the like target, by
    # construction, points the other way)
    ft = FT.feature_table(df, [1, 2], 0.0, 0.0, 1.0)
    model = RK.fit_pairwise(ft, [1, 2], max_iter=30)
    path = os.path.join(tmp_dir, "model")
    RK.save_model(model, path)
    assert RK.coefficients(RK.load_model(path)) == pytest.approx(RK.coefficients(model))
    assert RK.load_model(path).vocab == [1, 2] and RK.load_model(path).settings["weights"] == [0.0, 0.0, 1.0]
    with pytest.raises(ValueError):
        J.score_and_measure(df, path, [2, 1])
    out = J.score_and_measure(df, path, output_path=os.path.join(tmp_dir, "scored"))
    m = out["metrics"].first()
    assert m["GAUC_valid"] and m["GAUCWeighted"] == pytest.approx(1.0)


def test_search_resume_and_best(spark, tmp_dir):
    df = _train_rows(spark)
    data = TU.prepare_search(df, df, [1, 2])
    path = os.path.join(tmp_dir, "trials")
    t1 = TU.search(spark, data, n_trials=2, timeout=None, trials_path=path, max_iter=20)
    assert t1.count() == 2
    t2 = TU.search(spark, data, n_trials=3, timeout=None, trials_path=path, max_iter=20)
    assert sorted(r["trial"] for r in t2.collect()) == [0, 1, 2]
    best = TU.best_trial(t2).first()
    assert best["value"] == max(r["value"] for r in t2.collect())
    zero = TU.weighted_pairs(data, 0.0, 0.0, 0.0)
    assert zero.count() == 0  # weight 0 drops every pair of that target


def test_extract_job(spark, tmp_dir):
    df = _train_rows(spark, 5)
    path = os.path.join(tmp_dir, "extract")
    J.write_training_extract(df, path, limit=7)
    got = spark.read.parquet(path)
    assert got.count() == 7 and "features" in got.columns


def test_command_line(spark, tmp_dir, capsys):
    from rankfold.__main__ import main
    src = os.path.join(tmp_dir, "imp.parquet")
    _train_rows(spark, 12).write.parquet(src)
    main(["evaluate", src, os.path.join(tmp_dir, "ev"), "--no-slice"])
    assert spark.read.parquet(os.path.join(tmp_dir, "ev", "metrics")).count() == 4
    main(["tune", src, src, os.path.join(tmp_dir, "trials"), "--n-trials", "2", "--vocab-ids", "1,2",
          "--iterations", "10", "--model-dir", os.path.join(tmp_dir, "models")])
    main(["score", src, os.path.join(tmp_dir, "models", "trial_1"), os.path.join(tmp_dir, "sc"),
          "--vocab-ids", "1,2", "--format", "parquet"])
    main(["tune", src, src, os.path.join(tmp_dir, "trials2"), "--n-trials", "1", "--vocab-ids", "1,2", "--metric", "AUC",
          "--platforms", "android", "--nav-screen", "nowhere"])
    main(["score", src, os.path.join(tmp_dir, "models", "trial_0"), os.path.join(tmp_dir, "sc2"), "--metric", "GAUCSimple", "--no-slice"])
    assert spark.read.parquet(os.path.join(tmp_dir, "sc", "scored")).count() == 48
    main(["extract", src, os.path.join(tmp_dir, "ex"), "--limit", "5"])
    assert spark.read.parquet(os.path.join(tmp_dir, "ex")).count() == 5
    out = capsys.readouterr().out
    assert "value" in out and "total_targets" in out and '"value": 0.0' in out and '{"GAUCSimple": ' in out


def test_search_time_budget(spark):
    df = _train_rows(spark, 10)
    data = TU.prepare_search(df, df, [1, 2])
    trials = TU.search(spark, data, n_trials=5, timeout=0.0, max_iter=5)
    assert trials.count() == 1  # the budget is checked before each further trial
