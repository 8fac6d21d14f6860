"""Readers, extracts, matrices, ranker, run logs and streaming ingest."""

import json
import math
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from conftest import make_impressions
from rankfold.operators import matrices as MX
from rankfold.operators import metrics as M
from rankfold.operators import ranker as RK
from rankfold.operators import runlog as RL
from rankfold.config import DEFAULT_FORMULA_PATH
from rankfold.operators.indexing import first_n, with_global_index
from rankfold.sources import extracts as X


def _write_ndjson(path, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.jsonl"), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


RAW_ROWS = [
    {"rid": "a", "score": "nan", "events": ["actionPlay"], "viewTimeSec": 10, "durationSeconds": 100,
     "navScreen": "video_for_you", "platform": "android", "formulaPath": "f", "typeId": 1776, "userType": "vk",
     "recommenderId": 200, "features": [[1, "inf"], [2, 0.5]]},
    {"rid": "a", "score": "-Infinity", "events": [], "viewTimeSec": 0, "durationSeconds": 50,
     "navScreen": "video_for_you", "platform": "android", "formulaPath": "f", "typeId": 1776, "userType": "vk",
     "recommenderId": 200, "features": []},
    {"rid": "b", "score": 0.25, "events": None, "viewTimeSec": None, "durationSeconds": None,
     "navScreen": "x", "platform": "ios", "formulaPath": "g", "typeId": 1, "userType": "vk",
     "recommenderId": 200, "features": None},
]


def test_ndjson_reader_non_finite(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in")
    _write_ndjson(path, RAW_ROWS)
    df = X.read_impressions(spark, path)
    rows = df.orderBy("rid", "viewTimeSec").collect()
    assert math.isnan(rows[1]["score"]) or math.isnan(rows[0]["score"])
    scores = sorted((r["score"] for r in rows), key=lambda s: (not math.isnan(s), s))
    assert math.isnan(scores[0]) and scores[1] == float("-inf") and scores[2] == 0.25
    feats = [r["features"] for r in rows if r["rid"] == "a" and r["features"]][0]
    assert feats[0][1] == float("inf")
    with pytest.raises(Exception):
        X.read_impressions(spark, os.path.join(tmp_dir, "missing")).count()


def test_write_read_roundtrip(spark, tmp_dir):
    df = make_impressions(spark, [{"rid": "w", "score": 0.5, "features": [[1.0, 2.0]]}])
    out = os.path.join(tmp_dir, "scored")
    X.write_impressions(df.withColumn("model_score", F.lit(float("nan"))), out)
    back = X.read_impressions(spark, out, extra_columns={"model_score": None}, score_columns=("score", "model_score"))
    r = back.first()
    assert r["score"] == 0.5 and math.isnan(r["model_score"])


def test_first_n_and_whole_sessions(spark):
    rnd = random.Random(1)
    rows = [{"rid": f"{rnd.randint(0, 30):03d}", "score": rnd.random()} for _ in range(200)]
    df = make_impressions(spark, rows)
    got = [(r["rid"], r["pos"]) for r in first_n(df, ["rid", "pos"], 37, num_partitions=5).collect()]
    want = sorted((r["rid"], r["pos"]) for r in df.collect())[:37]
    assert sorted(got) == want
    ext = X.training_extract(df.withColumn("formulaPath", F.lit("fstorage:vk_video_266_1769078359_f")),
                             limit=37, whole_sessions=True).collect()
    keep = {r["rid"] for r in ext}
    sizes = {}
    for r in rows:
        sizes[r["rid"]] = sizes.get(r["rid"], 0) + 1
    total = 0
    expect = set()
    for rid in sorted(sizes):
        total += sizes[rid]
        if total <= 37:
            expect.add(rid)
    assert keep == expect


def test_global_index_dense(spark):
    df = spark.range(0, 500).withColumn("k", (F.col("id") * 7919) % 500)
    idx = with_global_index(df, ["k"], "i", num_partitions=6).collect()
    assert sorted((r["k"], r["i"]) for r in idx) == [(k, k) for k in range(500)]


def test_slice_projection_and_write(spark, tmp_dir):
    df = make_impressions(spark, [{"rid": "a"}, {"rid": "b", "platform": "android"}])
    out = X.slice_projection(df)
    assert out.columns == X.SLICE_COLUMNS and out.count() == 1
    path = os.path.join(tmp_dir, "slice")
    X.write_slice(df, path)
    X.write_slice(df.limit(0), path, overwrite=False)  # existing output kept
    assert spark.read.parquet(path).count() == 1


def _matrix_rows(spark):
    return make_impressions(spark, [
        {"rid": "m", "features": [[0.0, 1.0], [3.0, 2.0], [3.0, 5.0], [300.0, 9.0]], "events": ["actionPlay"]},
        {"rid": "m", "features": [[1.0, 0.0], [2.0, float("nan")], [7.0, None]], "events": ["firstFrame"]},
        {"rid": "n", "features": None, "events": None},
    ])


def test_matrices(spark):
    df = _matrix_rows(spark)
    m = MX.dense_matrix(df, 4).orderBy("pos").collect()
    assert m[0]["features"] == [1.0, 0.0, 0.0, 5.0]
    h = MX.matrix_health(MX.dense_matrix(df, 4), 4).first()
    assert h["total_cells"] == 12 and h["used_features"] == 3 and h["unused_first10"] == [1]
    totals, per_id = MX.feature_profile(df, 256)
    t = totals.first()
    assert t["total_rows"] == 3 and t["total_feature_pairs"] == 7 and t["max_feature_index"] == 300
    p = {r["feature_id"]: r for r in per_id.collect()}
    assert p[3]["count"] == 2 and p[3]["mean"] == 3.5 and p[2]["nan_count"] == 1
    freq = MX.frequent_features(df, min_frequency=2).collect()
    assert [r["feature_id"] for r in freq] == [3]
    x_tr, x_te, ids = MX.train_test_split(df, df, "Play", min_frequency=1, max_features=2)
    assert ids == [0, 1] and "feat_0" in x_te.columns
    assert [r["label"] for r in x_tr.orderBy("pos").collect()] == [1, 0, 0]


def test_pairwise_ranker_learns_direction(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(400):
        a, b = rnd.random(), rnd.random()
        for pos, v in enumerate((a, b)):
            rows.append((f"s{i}", pos, [v, rnd.random()], [("like", float(v == max(a, b)), 1.0)]))
    ft = spark.createDataFrame(rows, "rid string, pos int, features array<float>, targets array<struct<name: string, target: double, weight: double>>")
    three = ft.withColumn("targets", F.expr("concat(targets, array(struct('dislike' as name, 1D as target, 1D as weight), struct('ct' as name, 0D as target, 1D as weight)))"))
    coef = RK.coefficients(RK.fit_pairwise(three, [1, 2], max_iter=50))
    assert coef[0] > 0 and abs(coef[0]) > abs(coef[1])
    scored = RK.score(spark.createDataFrame([([1.0, float("nan")],), ([float("nan"), 0.0],)],
                                            "features array<float>"), coef)
    vals = [r["model_score"] for r in scored.collect()]
    assert all(math.isfinite(v) for v in vals)
    stats = RK.score_stats(scored).first()
    assert stats["max"] >= stats["min"]


def test_linear_classifier(spark):
    rnd = random.Random(2)
    data = [(float(rnd.gauss(0, 1)), float(rnd.gauss(0, 1))) for _ in range(300)]
    df = spark.createDataFrame([(a, b if i % 10 else float("nan"), int(a + 0.3 * b > 0))
                                for i, (a, b) in enumerate(data)], "feat_1 double, feat_2 double, label int")
    model, cols = RK.linear_classifier(df, ["feat_1", "feat_2"], max_iter=100)
    pred = RK.predict_classifier(model, df)
    auc = M.global_auc(pred.select(F.col("label").alias("label_y"), "p1"), ["y"], "p1").first()
    assert auc["AUC"] > 0.9


def _details(spark):
    return spark.createDataFrame([
        ("watch_coverage_30s", "s1", 0.5, 3, 1, 2, 1 / 3), ("watch_coverage_30s", "it's", 1.0, 2, 1, 1, 0.5),
        ("action_play", "s2", 0.25, 5, 2, 3, 0.4)],
        "target string, session_id string, auc double, size bigint, positives bigint, negatives bigint, positive_rate double")


def test_runlog_roundtrip_and_selection(spark, tmp_dir):
    logs = RL.render_messages(_details(spark), chunk_sessions=1, start_time=100.0)
    path = os.path.join(tmp_dir, "log")
    extra = spark.createDataFrame([("Median AUC: 0.5", 1000.0)], "message string, timestamp double") \
        .select(F.struct("message", F.struct("timestamp").alias("time")).alias("record"))
    logs.unionByName(extra).write.json(path)
    read = RL.read_run_log(spark, path)
    got = {r["session_id"]: r["auc"] for r in RL.session_aucs(read, "watch_coverage_30s").collect()}
    assert got == {"s1": 0.5, "it's": 1.0}
    last = RL.select_result(read, "watch_coverage_30s", "group_details", position=-1).collect()
    assert len(last) == 1
    with pytest.raises(ValueError):
        RL.select_result(read, "watch_coverage_30s", "no_such_field")
    rep = spark.createDataFrame([("{'a': True, 'b': None, 'c': False, 'Trueish': 1}",)], "m string")
    assert json.loads(rep.select(RL.repair_message("m")).first()[0]) == {"a": True, "b": None, "c": False,
                                                                          "Trueish": 1}


def test_density_matches_direct_sum(spark):
    vals = [0.1, 0.2, 0.2, 0.5, 0.9]
    df = spark.createDataFrame([(v,) for v in vals], "auc double")
    dens = {round(r["x"], 6): r["density"] for r in RL.auc_density(df, points=[0.0, 0.5, 1.0]).collect()}
    n = len(vals)
    mean = sum(vals) / n
    sd = math.sqrt(sum((v - mean) ** 2 for v in vals) / (n - 1))
    h = sd * n ** -0.2
    for x in (0.0, 0.5, 1.0):
        want = sum(math.exp(-0.5 * ((x - v) / h) ** 2) for v in vals) / (n * h * math.sqrt(2 * math.pi))
        assert dens[x] == pytest.approx(want, rel=1e-12)
    runs = spark.createDataFrame([("a", 0.1), ("a", 0.3), ("a", 0.6), ("b", 0.2), ("b", 0.4)], "run string, auc double")
    cut = RL.cut_to_shortest(runs.withColumn("sid", F.col("auc").cast("string")), "run", "sid").collect()
    assert sorted((r["run"], r["auc"]) for r in cut) == [("a", 0.1), ("a", 0.3), ("b", 0.2), ("b", 0.4)]


def test_streaming_ingest(spark, tmp_dir):
    from rankfold.streaming.ingest import ingest_stream
    src = os.path.join(tmp_dir, "landing")
    _write_ndjson(src, RAW_ROWS)
    sink = os.path.join(tmp_dir, "table")
    q = ingest_stream(spark, src, sink, os.path.join(tmp_dir, "ckpt"), platforms=["android"])
    q.awaitTermination(120)
    assert spark.read.parquet(sink).count() == 2


def test_rendered_summary_fields_are_selectable(spark):
    details = _details(spark)
    metrics = spark.createDataFrame(
        [("watch_coverage_30s", 0.75, 0.7, 2, 0.25, 0.5, 1.0, 0.75, True),
         ("action_play", 0.25, 0.25, 1, 0.0, 0.25, 0.25, 0.25, True)],
        "target string, GAUCSimple double, GAUCWeighted double, n_groups long, std double, min double, "
        "max double, median double, GAUC_valid boolean")
    logs = RL.render_messages(details, chunk_sessions=10, start_time=1.0, metrics=metrics)
    got = RL.select_result(logs, "watch_coverage_30s", "GAUCWeighted").collect()
    assert [r["value"] for r in got] == [0.7]
    assert RL.select_result(logs, "action_play", "n_groups").first()["value"] == 1
    assert sorted(r["session_id"] for r in RL.all_session_aucs(logs).collect()) == ["it's", "s1", "s2"]


def test_streaming_ingest_partitioned_and_incremental(spark, tmp_dir):
    from rankfold.streaming.ingest import ingest_stream
    src = os.path.join(tmp_dir, "landing2")
    _write_ndjson(src, RAW_ROWS)
    sink, ckpt = os.path.join(tmp_dir, "table2"), os.path.join(tmp_dir, "ckpt2")
    ingest_stream(spark, src, sink, ckpt, partition_by="platform").awaitTermination(120)
    assert spark.read.parquet(sink).count() == 3
    with open(os.path.join(src, "part-1.jsonl"), "w") as f:
        f.write(json.dumps(RAW_ROWS[0]) + "\n")
    ingest_stream(spark, src, sink, ckpt, partition_by="platform").awaitTermination(120)
    got = spark.read.parquet(sink)
    assert got.count() == 4  # only the new file was processed on the second run
    assert {r["platform"] for r in got.select("platform").distinct().collect()} == {"android", "ios"}


def test_command_line_reads_ndjson(spark, tmp_dir, capsys):
    from rankfold.__main__ import main
    path = os.path.join(tmp_dir, "imp.jsonl")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        for i in range(6):
            f.write(json.dumps({"rid": f"r{i // 3}", "score": str(i / 10), "events": ["watchCoverageRecord"],
                                "viewTimeSec": 40 * (i % 2), "durationSeconds": 100, "navScreen": "video_for_you",
                                "platform": "android", "formulaPath": "fstorage:vk_video_266_1769078359_f",
                                "typeId": 1776, "userType": "vk", "recommenderId": 200,
                                "features": [[1, i]]}) + "\n")
    main(["evaluate", path, os.path.join(tmp_dir, "out"), "--targets", "watch_coverage_30s"])
    m = spark.read.parquet(os.path.join(tmp_dir, "out", "metrics")).first()
    assert m["total_samples"] == 6 and m["n_groups"] == 2


def test_score_with_user_model(spark):
    import numpy as np
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, float("nan")])], "rid string, features array<float>")
    scored = RK.score_with_model(df, lambda x: x[:, 0] * 2 + x[:, 1]).orderBy("rid").collect()
    assert scored[0]["model_score"] == 4.0 and scored[1]["model_score"] == -3.4e38
    linear = RK.score_with_model(df.limit(1), lambda x: x @ np.array([0.5, 0.25])).first()["model_score"]
    assert linear == RK.score(df.limit(1), [0.5, 0.25]).first()["model_score"]


def test_printed_dicts_with_hard_ids_survive(spark):
    ids = ["it's", 'a "quote"', "None of it", "is True", "back\\slash", "both ' and \"", "new\nline", "é"]
    text = str({"t": {"GAUC_valid": True, "median": None, "group_details": [
        {"session_id": s, "auc": 0.5, "size": 2, "positives": 1, "negatives": 1, "positive_rate": 0.5} for s in ids]}})
    logs = spark.createDataFrame([(text, 1.0), ("plain line", 2.0)], "message string, timestamp double")
    assert [r["session_id"] for r in RL.session_aucs(logs, "t").collect()] == ids
    details = RL.session_aucs(logs, "t").withColumn("target", F.lit("t's"))
    back = RL.all_session_aucs(RL.render_messages(details))
    assert sorted(r["session_id"] for r in back.collect()) == sorted(ids)
    broken = spark.createDataFrame([("{'t': {'group_details': [", 1.0)], "message string, timestamp double")
    with pytest.raises(Exception, match="unreadable result message"):
        RL.parse_messages(broken).collect()
    assert RL.parse_messages(broken, strict=False).first()["parsed"] is None


def test_nth_message_from_the_end_is_exact(spark):
    rows = [(str({"t": {"n_groups": k, "group_details": []}}), float(k // 2)) for k in range(3)]
    logs = spark.createDataFrame(rows, "message string, timestamp double")
    assert [RL.select_result(logs, "t", "n_groups", -k).first()["value"] for k in (1, 2, 3)] == [2, 1, 0]
    with pytest.raises(IndexError):
        RL.select_result(logs, "t", "n_groups", -10)


def _ndjson(path, lines):
    os.makedirs(path)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_malformed_lines_never_count(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bad")
    _ndjson(path, ['{"rid": "a", "score": 1.0}', "{broken", "no json"])
    with pytest.raises(Exception):
        X.read_impressions(spark, path).collect()
    assert [r["pos"] for r in X.read_impressions(spark, path, malformed="drop").collect()] == [0]


def test_command_line_reads_ndjson_in_every_command(spark, tmp_dir):
    import json

    from rankfold.__main__ import main
    from rankfold.config import DEFAULT_RECOMMENDER_ID, DEFAULT_TYPE_ID, DEFAULT_USER_TYPE

    rnd = random.Random(4)
    lines = [json.dumps({
        "rid": f"r{k % 8}", "score": rnd.random(), "viewTimeSec": rnd.choice([0, 50, 400]), "durationSeconds": 600,
        "events": ["watchCoverageRecord"] + (["like"] if k % 3 else []), "navScreen": "video_for_you", "platform": "vk_video_android",
        "formulaPath": DEFAULT_FORMULA_PATH, "typeId": DEFAULT_TYPE_ID, "userType": DEFAULT_USER_TYPE,
        "recommenderId": DEFAULT_RECOMMENDER_ID, "features": [[1, rnd.random()], [2, rnd.random()]]}) for k in range(48)]
    src = os.path.join(tmp_dir, "in")
    _ndjson(src, lines)
    out = lambda name: os.path.join(tmp_dir, name)
    main(["--format", "json", "evaluate", src, out("ev"), "--targets", "watch_coverage_30s"])
    main(["--format", "json", "tune", src, src, out("trials"), "--n-trials", "1", "--vocab-ids", "1,2", "--iterations", "5", "--model-dir", out("m")])
    main(["--format", "json", "score", src, out("m/trial_0"), out("sc"), "--vocab-ids", "1,2"])
    main(["--format", "json", "extract", src, out("ex"), "--limit", "5"])
    assert spark.read.parquet(out("ex")).count() == 5 and spark.read.parquet(out("sc/scored")).count() == 48


def test_large_chunks_are_written_in_parts(spark):
    rows = [("t", str(k), k / 1000, 2, 1, 1, 0.5) for k in range(1000)] + [("u", "7", 0.5, 2, 1, 1, 0.5)]
    details = spark.createDataFrame(rows, "target string, session_id string, auc double, size long, positives long, negatives long, positive_rate double")
    number = F.col("session_id").cast("long")
    logs = RL.render_messages(details, start_time=5.0, chunk=F.pmod(number, F.lit(4)), part=F.floor(number / 100))
    sizes = [r["value"] for r in RL.select_result(logs, "t").select(F.size("value").alias("value")).collect()]
    assert sizes == [25] * 40
    for back in (1, 2, 4):
        got = RL.session_aucs(logs, "t", position=-back, parts=True).collect()
        assert sorted(int(r["session_id"]) for r in got) == list(range(4 - back, 1000, 4))
    with pytest.raises(IndexError):
        RL.session_aucs(logs, "t", position=-5, parts=True)


def test_first_n_with_ties_at_the_cut(spark):
    rows = [("a", 1, 0), ("b", 2, 1), ("b", 2, 2), ("b", 2, 3), ("c", 1, 4), (None, None, 5), (None, None, 6)]
    df = spark.createDataFrame(rows, "rid string, pos int, k int").repartition(3)
    order = [(r[0] is not None, r[0] or "", r[1] or 0) for r in rows]
    for n in range(9):
        got = first_n(df, ["rid", "pos"], n).collect()
        assert len({r["k"] for r in got}) == len(got) == min(n, 7)
        assert sorted(order[r["k"]] for r in got) == sorted(order)[:n]


def test_messages_without_escapes_need_no_pattern(spark):
    """Cut at apostrophes or by the pattern: the same JSON, also for words inside literals and an odd number of apostrophes."""
    texts = ["{'a': True, 'True': None, 'b None': False}", "{'x': [1, -2.5e-7], 'y': {'z': 'it is False'}}", "", "INFO True", "{'open: True", "None", "{'': ''}"]
    df = spark.createDataFrame([(m,) for m in texts] + [(m + '\\"',) for m in texts[:2]], "m string")
    got = [r[0] for r in df.select(RL.repair_message("m")).collect()]
    assert json.loads(got[0]) == {"a": True, "True": None, "b None": False} and json.loads(got[1])["y"] == {"z": "it is False"}
    assert got[2:4] == ["", "INFO true"] and got[5:7] == ["null", '{"": ""}']
    plan = df.select(RL.repair_message("m"))._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" in plan


def test_messages_are_parsed_once_for_a_position(spark, monkeypatch):
    """The nth message in parts: times and values come from a kept table, the log is in the plan of that one alone."""
    kept, real = [], RL.written
    monkeypatch.setattr(RL, "written", lambda df: kept.append(df) or real(df))
    details = spark.createDataFrame([("t", str(i), 0.5, 2, 1, 1, 0.5) for i in range(30)],
                                    "target string, session_id string, auc double, size long, positives long, negatives long, positive_rate double")
    number = F.col("session_id").cast("long")
    logs = RL.render_messages(details, start_time=0.0, chunk=number % 5, part=F.floor(number / 10))
    out = RL.session_aucs(logs, "t", position=-2, parts=True)
    assert sorted(int(r["session_id"]) for r in out.collect()) == [3, 8, 13, 18, 23, 28]
    assert len(kept) == 1 and "from_json" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_small_rows_with_much_work_and_compressed_lines(spark, monkeypatch):
    """Customers are dealt by number before their pairs are made; the NDJSON files of the round trip are compressed."""
    from rankfold.plans import registry as R

    sf = os.environ.get("RANKFOLD_TEST_SF", "/root/testdata/sf0.001")
    if not os.path.exists(sf):
        pytest.skip("test tables not present")
    monkeypatch.setattr(R, "DENSE_TASK_ROWS", 10)
    n = spark.read.parquet(f"{sf}/customer.parquet").count()
    assert f"RoundRobinPartitioning({-(-n // 10)})" in R.q_dense_wide(spark, sf)._jdf.queryExecution().executedPlan().toString()
    back = R.q_ndjson_file_roundtrip(spark, sf)
    assert back.inputFiles() and all(f.endswith(".gz") for f in back.inputFiles())


def _exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange " in line]


def test_round_trip_moves_lines_and_asked_columns_over_growing_tasks(spark, monkeypatch):
    """The NDJSON round trip moves a row as its line, then as the columns it returns; the tasks of both grow with the rows."""
    from rankfold import session
    from rankfold.plans import registry as R

    sf = os.environ.get("RANKFOLD_TEST_SF", "/root/testdata/sf0.001")
    if not os.path.exists(sf):
        pytest.skip("test tables not present")
    n = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    monkeypatch.setattr(session, "TASK_ROWS", -(-n // 20))
    back = R.q_ndjson_file_roundtrip(spark, sf)
    assert len(back.inputFiles()) == 20  # one file a task of the ordering
    plan = back._jdf.queryExecution().executedPlan().toString()
    moved = plan[plan.index("Exchange hashpartitioning"):].splitlines()
    assert ", 20)" in moved[0] and "Project [" in moved[1]
    out = moved[1].split(" AS ")
    assert "features" not in out[-1] and out[-1].split("#")[0] == "events_str" and "transform(" not in plan[:plan.index("Exchange")]
    small = {(r["rid"], r["pos"]): r for r in back.collect()}
    assert len(small) == n
    monkeypatch.setattr(session, "TASK_ROWS", 10**9)
    assert {(r["rid"], r["pos"]): r for r in R.q_ndjson_file_roundtrip(spark, sf).collect()} == small


def test_shuffles_of_the_written_lines_are_dropped(spark, tmp_dir):
    """What a write inside ``shuffles_dropped`` shuffled leaves the disk with its end; the setting is as before then."""
    import glob
    import time

    from rankfold.session import shuffles_dropped

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    dirs = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}
    before = spark.conf.get(key, None)
    old = files()
    with shuffles_dropped(spark):
        spark.range(1000).repartition(3, "id").write.parquet(os.path.join(tmp_dir, "t"))
    for _ in range(100):
        if not files() - old:
            break
        time.sleep(0.1)
    assert not files() - old and spark.read.parquet(os.path.join(tmp_dir, "t")).count() == 1000
    assert spark.conf.get(key, None) == before
    with pytest.raises(ZeroDivisionError):
        with shuffles_dropped(spark):
            1 / 0
    assert spark.conf.get(key, None) == before


def test_reader_makes_columns_before_it_numbers(spark, tmp_dir):
    """Positions by nested files and lines, also for asked columns, a condition, rows without a session and more tasks."""
    for k, part in enumerate(["b", "a", "a/c"]):
        _ndjson(os.path.join(tmp_dir, "in", part, "x"), [json.dumps({"rid": ["s", "t", None][i % 3], "score": k * 10 + i, "platform": "p%d" % (i % 2),
                                                                       "features": [[i, "inf"]]}) for i in range(7)])
    path = os.path.join(tmp_dir, "in", "*", "x"), os.path.join(tmp_dir, "in", "a", "c", "x")
    whole = X.read_impressions(spark, list(path))
    assert [c for c in whole.columns if c not in [f.name for f in X.RAW_SCHEMA.fields]] == ["pos"]
    order = lambda rows: sorted((r["rid"] or "", r["pos"], r["score"]) for r in rows)
    want, seen = [], {}
    for k in (2, 1, 0):  # a/c/x, a/x, b/x
        for i in range(7):
            rid = ["s", "t", ""][i % 3]
            want.append((rid, seen.get(rid, 0) if rid else 0, k * 10.0 + i))
            seen[rid] = seen.get(rid, 0) + 1
    assert order(whole.collect()) == sorted(want)
    for rows in (None, 21, 10**8):
        asked = X.read_impressions(spark, list(path), columns=["rid", "score", F.col("features")[0][1].alias("v")], rows=rows)
        moved = _exchanges(asked)
        assert len(moved) == 1 and "hashpartitioning(rid" in moved[0] and "_alone" in moved[0]
        assert asked.columns == ["rid", "score", "v", "pos"] and order(asked.collect()) == sorted(want)
        assert {r["v"] for r in asked.collect()} == {float("inf")}
    placed = X.read_impressions(spark, list(path), extra_columns={"pos": LongType()})  # a column of that name in the files gives way
    assert placed.columns.count("pos") == 1 and order(placed.collect()) == sorted(want)
    some = X.read_impressions(spark, list(path), where=F.col("platform") == "p1", columns=["rid", "score"])
    assert order(some.collect()) == sorted((r, p, s) for r, p, s in _numbered_again(want, lambda s: s % 10 % 2 == 1))


def _numbered_again(rows, keep):
    seen, out = {}, []
    for rid, _, score in rows:
        if keep(score):
            out.append((rid, seen.get(rid, 0) if rid else 0, score))
            seen[rid] = seen.get(rid, 0) + 1
    return out


def test_tasks_keep_to_what_is_dealt_unsorted(spark, monkeypatch):
    """Up to a quarter more rows a task where the number of tasks then needs no sorting by the dealing task."""
    from rankfold import session

    monkeypatch.setattr(session, "TASK_ROWS", 1000)
    assert [session.tasks_for(spark, n) for n in (200_000, 200_001, 250_000, 250_001)] == [200, 200, 200, 251]
