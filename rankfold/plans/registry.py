"""Registered queries over the test tables and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose computed
columns are aliased and rounded exactly like the oracle SQL (ratios to 9
digits, sums to 6), so the order-insensitive value hash is stable.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.config import DEFAULT_TARGETS
from rankfold.plans.evaluate import evaluate
from rankfold.sources.testdata import impressions, read_table
from rankfold.operators import metrics as M
from rankfold.session import shuffles_dropped, tasks_for, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def r9(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 9)


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


METRIC_COLS = ["target", "total_samples", "total_positives", "positive_rate", "AUC", "AUC_valid",
               "GAUCSimple", "GAUCWeighted", "n_groups", "std", "min", "max", "median", "GAUC_valid"]
_RATIO = {"positive_rate", "AUC", "GAUCSimple", "GAUCWeighted", "std", "min", "max", "median"}


def _metrics_out(m: DataFrame) -> DataFrame:
    return m.select(*[r9(c).alias(c) if c in _RATIO else F.col(c) for c in METRIC_COLS])


# ---------------------------------------------------------------- metrics
@register("gauc_by_target")
def q_gauc_by_target(spark, sf_dir):
    """L1, L2, M1-M9: full metric row per built-in target (score = discount)."""
    return _metrics_out(evaluate(impressions(spark, sf_dir))["metrics"])


@register("gauc_group_details")
def q_gauc_group_details(spark, sf_dir):
    """M3, M4: one row per valid (target, session)."""
    d = evaluate(impressions(spark, sf_dir), details_only=True)["group_details"]
    return d.select("target", "session_id", r9("auc").alias("auc"), "size", "positives", "negatives",
                    r9("positive_rate").alias("positive_rate"))


@register("auc_by_target")
def q_auc_by_target(spark, sf_dir):
    """M2, M9: exact global AUC with the near tie-free score (extended price)."""
    labeled, names = M.with_labels(impressions(spark, sf_dir), DEFAULT_TARGETS)
    n, qs = M._quantiles(labeled, F.col("score_alt"))
    aucs = M.global_auc(labeled, names, "score_alt", M._pick(qs, M.auto_buckets(n, 4096)))
    return aucs.select("target", r9("AUC").alias("AUC"), "AUC_valid")


@register("label_stats")
def q_label_stats(spark, sf_dir):
    """Total, positives and rate per target."""
    labeled, names = M.with_labels(impressions(spark, sf_dir), DEFAULT_TARGETS)
    return M.label_stats(labeled, names).select("target", "total_samples", "total_positives",
                                                r9("positive_rate").alias("positive_rate"))


@register("eval_slice")
def q_eval_slice(spark, sf_dir):
    """F1 + M13: metrics on the evaluation slice with the command-line defaults."""
    return _metrics_out(evaluate(impressions(spark, sf_dir), sliced=True)["metrics"])


@register("auc_gauc_compare")
def q_auc_gauc_compare(spark, sf_dir):
    """AUC vs GAUC differences and similarity band."""
    c = evaluate(impressions(spark, sf_dir))["compare"]
    ratio = ["AUC", "GAUCWeighted", "GAUCSimple", "difference_auc_gauc_weighted",
             "difference_auc_gauc_simple", "relative_diff_auc_gauc_weighted"]
    return c.select(*[r9(x).alias(x) if x in ratio else F.col(x) for x in c.columns])


@register("metric_summary")
def q_metric_summary(spark, sf_dir):
    """Summary row over targets."""
    one = evaluate(impressions(spark, sf_dir))["summary"]
    return one.select("total_targets", "targets_with_valid_auc", "targets_with_valid_gauc",
                      *[r9(c).alias(c) for c in ("average_auc", "average_gauc_weighted", "average_gauc_simple")])


# ---------------------------------------------------------------- slices and extracts
from rankfold.config import (DEFAULT_FORMULA_PATH, NAV_VIDEO_FOR_YOU,  # noqa: E402
                             PLATFORM_VK_VIDEO_ANDROID)
from rankfold.sources import extracts as X  # noqa: E402


@register("train_extract_topk")
def q_train_extract_topk(spark, sf_dir):
    """12-column training extract, first 500,000 rows by (rid, pos)."""
    ext = X.training_extract(impressions(spark, sf_dir), limit=500_000)
    return ext.select("rid", "pos", "typeId", "userType", "recommenderId", "navScreen", "platform", "formulaPath",
                      "viewTimeSec", "durationSeconds", "score",
                      F.array_join("events", ",").alias("events_str"), F.size("features").alias("n_features"))


@register("train_extract_cut")
def q_train_extract_cut(spark, sf_dir):
    """S3: the ordered limit where it bites (the limit is the operator)."""
    ext = X.training_extract(impressions(spark, sf_dir), limit=2000)
    return ext.select("rid", "pos", "viewTimeSec", "durationSeconds", "score")


@register("train_extract_sessions")
def q_train_extract_sessions(spark, sf_dir):
    """S3: only the sessions that fit into the limit whole."""
    ext = X.training_extract(impressions(spark, sf_dir), limit=2000, whole_sessions=True)
    return ext.select("rid", "pos", "viewTimeSec", "durationSeconds", "score")


@register("slice_projection")
def q_slice_projection(spark, sf_dir):
    """Three equalities, seven columns."""
    out = X.slice_projection(impressions(spark, sf_dir), platform=PLATFORM_VK_VIDEO_ANDROID,
                             nav_screen=NAV_VIDEO_FOR_YOU, formula_path=DEFAULT_FORMULA_PATH)
    return out.select("navScreen", "rid", F.array_join("events", ",").alias("events_str"), "viewTimeSec",
                      "platform", "score", "formulaPath")


@register("event_pattern_label")
def q_event_pattern_label(spark, sf_dir):
    """Regex event label with a watch-time threshold."""
    from rankfold.functions.labels import pattern_label_expr
    imp = impressions(spark, sf_dir)
    return imp.select("rid", "pos", pattern_label_expr("action(Play|Like)", 30).alias("label"))


# ---------------------------------------------------------------- targets and features
from rankfold.operators import features as FT  # noqa: E402
from rankfold.operators import pairs as PR  # noqa: E402

WEIGHTS = (5.0, 14.0, 0.41)
VOCAB = [2, 5, 1, 9]
WIDE_VOCAB = list(range(795, -1, -3))


def _feature_table(spark, sf_dir, vocab=VOCAB, keep_informative_only=True):
    return FT.feature_table(impressions(spark, sf_dir), vocab, *WEIGHTS,
                            keep_informative_only=keep_informative_only)


def _target_cols(df):
    return df.select("rid", "pos", "like_target", "dislike_target",
                     r9("consumption_time_target").alias("consumption_time_target"),
                     r9("label_value").alias("label_value"))


@register("graded_targets")
def q_graded_targets(spark, sf_dir):
    """Targets on the training slice."""
    return _target_cols(FT.with_graded_targets(FT.training_slice(impressions(spark, sf_dir))))


@register("informative_rows")
def q_informative_rows(spark, sf_dir):
    """Rows whose three targets are not all equal."""
    return _target_cols(_feature_table(spark, sf_dir))


def _vector_cols(df, col="features", n=len(VOCAB), prefix="f_"):
    return [F.col(col)[i].alias(f"{prefix}{i}") for i in range(n)]


@register("dense_features")
def q_dense_features(spark, sf_dir):
    """Dense float vectors by vocabulary [2, 5, 1, 9], default -3.4e38."""
    from rankfold.functions.vectors import dense_vector
    imp = impressions(spark, sf_dir).select("rid", "pos", dense_vector("features", VOCAB).alias("features"))
    return imp.select("rid", "pos", *_vector_cols(imp))


@register("features_text_roundtrip")
def q_features_text_roundtrip(spark, sf_dir):
    """Typed vector -> tab text -> vector; must equal the typed vector."""
    from rankfold.functions.vectors import text_to_vector, text_width, vector_to_text
    ft = _feature_table(spark, sf_dir)
    text = ft.select("rid", "pos", vector_to_text("label_value", "features").alias("value"))
    n = text.select(text_width("value").alias("w")).agg(F.min("w"), F.max("w")).first()
    if n[0] != n[1]:
        raise ValueError(f"ragged text rows: widths {n[0]}..{n[1]}")
    back = text.select("rid", "pos", F.split("value", "\t")[0].try_cast("double").alias("label_value"),
                       text_to_vector("value", int(n[0] or 0)).alias("features"))
    return back.select("rid", "pos", r9("label_value").alias("label_value"), *_vector_cols(back))


# ---------------------------------------------------------------- pairs
@register("pair_table")
def q_pair_table(spark, sf_dir):
    """Weighted winner/loser pairs (weights 5 / 14 / 0.41)."""
    p = PR.pair_table(_feature_table(spark, sf_dir))
    return p.select("rid", "target", "winner_pos", "loser_pos", r9("pair_weight").alias("pair_weight"))


@register("pair_totals")
def q_pair_totals(spark, sf_dir):
    """Pair count and total raw weight per (session, target)."""
    t = PR.pair_totals(_feature_table(spark, sf_dir))
    return t.select("rid", "target", "n_pairs", r9("total_raw_weight").alias("total_raw_weight"))


def _exported_pairs(spark, sf_dir):
    idx = PR.row_index(_feature_table(spark, sf_dir))
    n = idx.count()
    return PR.import_pairs(PR.export_pairs(PR.pair_table(idx, carry=("row_index",))), n)


@register("pair_export_roundtrip")
def q_pair_export_roundtrip(spark, sf_dir):
    """Pairs exported with global row indices, parsed back."""
    back = _exported_pairs(spark, sf_dir)
    return back.select("winner", "loser", "target", r9("pair_weight").alias("pair_weight"))


@register("win_labels")
def q_win_labels(spark, sf_dir):
    """Wins per row over all targets / max wins."""
    return PR.win_labels(_feature_table(spark, sf_dir)).select("rid", "pos", "wins", "win_label")


@register("group_sizes")
def q_group_sizes(spark, sf_dir):
    """P10: dense group ids of the sorted sessions and their sizes."""
    ids, _ = PR.group_sizes(_feature_table(spark, sf_dir))
    return ids.select("rid", "group_id", "size")


# ---------------------------------------------------------------- matrices and feature statistics
from rankfold.operators import matrices as MX  # noqa: E402

MATRIX_WIDTH = 8
SPLIT_DAY = "1998-04-25"


@register("dense_matrix")
def q_dense_matrix(spark, sf_dir):
    """B1: dense matrix by raw id, 0 <= id < 8, default 0.0."""
    m = MX.dense_matrix(impressions(spark, sf_dir), MATRIX_WIDTH)
    return m.select("rid", "pos", *_vector_cols(m, n=MATRIX_WIDTH, prefix="feat_"))


@register("matrix_health")
def q_matrix_health(spark, sf_dir):
    """B2: non-zero cells, share, used columns, first unused ids."""
    h = MX.matrix_health(MX.dense_matrix(impressions(spark, sf_dir), MATRIX_WIDTH), MATRIX_WIDTH)
    return h.select("non_zero", "total_cells", r9("non_zero_share").alias("non_zero_share"), "used_features",
                    F.array_join(F.col("unused_first10").cast("array<string>"), ",").alias("unused_first10"))


@register("feature_profile")
def q_feature_profile(spark, sf_dir):
    """Per-id count, mean, population std, min, max (ids < 256)."""
    _, per_id = MX.feature_profile(impressions(spark, sf_dir))
    return per_id.select("feature_id", "count", r6("mean").alias("mean"), r6("std").alias("std"),
                         r6("min").alias("min"), r6("max").alias("max"))


@register("feature_totals")
def q_feature_totals(spark, sf_dir):
    """Rows, total pairs, pairs per row, max feature id."""
    totals, _ = MX.feature_profile(impressions(spark, sf_dir))
    return totals.select("total_rows", "total_feature_pairs", r9("avg_pairs_per_row").alias("avg_pairs_per_row"),
                         "max_feature_index")


@register("frequent_features")
def q_frequent_features(spark, sf_dir):
    """Ids with >= 10 pairs, the 500 lowest."""
    return MX.frequent_features(impressions(spark, sf_dir), 10, 500).select("feature_id", "n")


@register("selected_matrix_train_test")
def q_selected_matrix_train_test(spark, sf_dir):
    """Vocabulary (4 lowest frequent ids) fitted on the early days,
    applied to the later days; label = actionPlay pattern."""
    imp = impressions(spark, sf_dir)
    train = imp.where(F.col("day") < F.lit(SPLIT_DAY).cast("date"))
    test = imp.where(F.col("day") >= F.lit(SPLIT_DAY).cast("date"))
    _, x_test, ids = MX.train_test_split(train, test, "actionPlay", max_features=4, wide=False)
    return x_test.select("rid", "pos", "label", *_vector_cols(x_test, n=len(ids), prefix="x_"),
                         F.lit(",".join(str(i) for i in ids)).alias("feature_ids"))


# ---------------------------------------------------------------- ranker, scoring, search
from rankfold.operators import ranker as RK  # noqa: E402

RANK_VOCAB = [1, 2, 3, 4, 5]
FIXED_COEF = [0.05, -2.0, 3.0, 0.01, 0.0005]


def _split(spark, sf_dir):
    imp = impressions(spark, sf_dir)
    return (imp.where(F.col("day") < F.lit(SPLIT_DAY).cast("date")),
            imp.where(F.col("day") >= F.lit(SPLIT_DAY).cast("date")))


def _fixed_scores(spark, sf_dir):
    from rankfold.functions.vectors import dense_vector
    imp = impressions(spark, sf_dir).withColumn("features", dense_vector("features", RANK_VOCAB))
    return RK.score(imp, FIXED_COEF)


@register("linear_score")
def q_linear_score(spark, sf_dir):
    """Dense features (X3) scored with fixed coefficients."""
    return _fixed_scores(spark, sf_dir).select("rid", "pos", r9("model_score").alias("model_score"))


@register("score_stats")
def q_score_stats(spark, sf_dir):
    """Min / max / population std of the fixed-coefficient scores."""
    s = RK.score_stats(_fixed_scores(spark, sf_dir))
    return s.select(r6("min").alias("min"), r6("max").alias("max"), r6("std").alias("std"))


@register("pairwise_ranker_gauc")
def q_pairwise_ranker_gauc(spark, sf_dir):
    """Fit the pairwise ranker on the early days (weights
    5 / 14 / 0.41), score the later days, metrics for watch_coverage_30s."""
    train, val = _split(spark, sf_dir)
    from rankfold.functions.vectors import dense_vector
    model = RK.fit_pairwise(FT.feature_table(train, RANK_VOCAB, *WEIGHTS), RANK_VOCAB)
    scored = RK.score(val.withColumn("features", dense_vector("features", RANK_VOCAB)), RK.coefficients(model))
    m = evaluate(scored, {"watch_coverage_30s": DEFAULT_TARGETS["watch_coverage_30s"]},
                 score_col="model_score", sliced=True)["metrics"]
    return _metrics_out(m)


@register("pairwise_gradient")
def q_pairwise_gradient(spark, sf_dir):
    """Mean pairwise-logit loss, its gradient, pairs and weight at fixed coefficients, from row weights (no pair table)."""
    from rankfold.operators import pairfit as PF
    train, _ = _split(spark, sf_dir)
    blocks = written(PF.session_blocks(FT.feature_table(train, RANK_VOCAB, *WEIGHTS), block_rows=4))  # sessions of several blocks too
    loss, weight, pairs, slope = PF.losses(blocks, FIXED_COEF, WEIGHTS, several=True)
    rows = [("loss", loss[0] / weight[0]), ("weight", weight[0]), ("pairs", float(pairs[0]))]
    rows += [(str(i), g / weight[0]) for i, g in zip(RANK_VOCAB, slope[0].tolist())]
    return spark.createDataFrame([(k, float(v)) for k, v in rows], "term string, value double").select("term", r6("value").alias("value"))


FIT_VOCAB = [2, 3]


@register("pairwise_fit")
def q_pairwise_fit(spark, sf_dir):
    """The fitted coefficients of two features (the oracle makes Newton steps over the pairs)."""
    train, _ = _split(spark, sf_dir)
    model = RK.fit_pairwise(FT.feature_table(train, FIT_VOCAB, *WEIGHTS), FIT_VOCAB, tol=1e-11)
    rows = list(zip(model.vocab, RK.coefficients(model)))
    return spark.createDataFrame(rows, "feature_id int, coefficient double").select("feature_id", F.round("coefficient", 5).alias("coefficient"))


@register("saved_model_gauc")
def q_saved_model_gauc(spark, sf_dir):
    """A model table with fixed coefficients is written, read back, scored and measured on the later days' slice."""
    import uuid

    from rankfold.plans.jobs import score_and_measure
    from rankfold.session import checkpoint_dir
    _, val = _split(spark, sf_dir)
    path = f"{checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    RK.save_model(RK.LinearModel(RANK_VOCAB, FIXED_COEF), path)
    return _metrics_out(score_and_measure(val, path, RANK_VOCAB)["metrics"])


@register("linear_classifier_fit")
def q_linear_classifier_fit(spark, sf_dir):
    """Intercept and coefficient of the recipe on one feature (the oracle makes Newton steps)."""
    train, test = _split(spark, sf_dir)
    x_train, _, ids = MX.train_test_split(train, test, "actionPlay", max_features=1)
    model, _ = RK.linear_classifier(x_train, [f"feat_{i}" for i in ids], tol=1e-12)
    fit = model.stages[-1]
    rows = [(int(ids[0]), float(fit.intercept), float(fit.coefficients[0]))]
    return spark.createDataFrame(rows, "feature_id int, intercept double, coefficient double").select(
        "feature_id", F.round("intercept", 4).alias("intercept"), F.round("coefficient", 4).alias("coefficient"))


@register("trial_best")
def q_trial_best(spark, sf_dir):
    """Three seeded trials of the weight search, best one."""
    from rankfold.plans.jobs import tune_weights
    train, val = _split(spark, sf_dir)
    _, best = tune_weights(spark, train, val, RANK_VOCAB, n_trials=3, timeout=None, seed=0)
    return best.select("trial", "like_weight", "dislike_weight", "consumption_time_weight",
                                        r9("value").alias("value"))


@register("linear_classifier_auc")
def q_linear_classifier_auc(spark, sf_dir):
    """Impute -> scale -> logistic regression on the B8 matrices; AUC of
    the hard predictions and of the probabilities on the later days."""
    train, test = _split(spark, sf_dir)
    x_train, x_test, ids = MX.train_test_split(train, test, "actionPlay", max_features=213)
    cols = [f"feat_{i}" for i in ids]
    model, used = RK.linear_classifier(x_train, cols)
    pred = written(RK.predict_classifier(model, x_test).select("label", "prediction", "p1"))  # read for both AUCs and their quantiles
    out = []
    for name, col in (("prediction", "prediction"), ("probability", "p1")):
        labeled = pred.select(F.col("label").alias("label_y"), F.col(col).alias("s"))
        a = M.global_auc(labeled, ["y"], "s").select(F.lit(name).alias("score_kind"), r9("AUC").alias("AUC"),
                                                     "AUC_valid")
        out.append(a)
    return out[0].unionByName(out[1])


# ---------------------------------------------------------------- run logs and AUC distributions
from rankfold.operators import runlog as RL  # noqa: E402


def _details(spark, sf_dir):
    return evaluate(impressions(spark, sf_dir), details_only=True)["group_details"]


@register("runlog_aucs")
def q_runlog_aucs(spark, sf_dir):
    """Group details written as printed-dict log messages (chunks
    of 1,000 sessions), parsed back per target."""
    logs = RL.render_messages(_details(spark, sf_dir), chunk_sessions=1000)
    out = RL.all_session_aucs(logs)
    return out.select("target", "session_id", r9("auc").alias("auc"), "size", "positives", "negatives",
                      r9("positive_rate").alias("positive_rate"))


@register("auc_density")
def q_auc_density(spark, sf_dir):
    """Session-AUC density per target on 101 grid points in [0, 1]."""
    d = RL.auc_density(_details(spark, sf_dir), "auc", "target")
    return d.select(F.col("run").alias("target"), r9("x").alias("x"), r6("density").alias("density"))


@register("auc_density_by_run")
def q_auc_density_by_run(spark, sf_dir):
    """Densities of the targets' session AUCs, each cut to the shortest
    target's session count (sessions in id order)."""
    cut = RL.cut_to_shortest(_details(spark, sf_dir), "target", "session_id")
    d = RL.auc_density(cut, "auc", "target")
    return d.select(F.col("run").alias("target"), r9("x").alias("x"), r6("density").alias("density"))


# ---------------------------------------------------------------- second source: event sessions
from rankfold.config import TargetConfig  # noqa: E402
from rankfold.sources.testdata import event_sessions  # noqa: E402

EVENT_TARGETS = {"purchase": TargetConfig("purchase", "purchase"), "click": TargetConfig("click", "click"),
                 "signup": TargetConfig("signup", "signup")}


@register("gauc_events")
def q_gauc_events(spark, sf_dir):
    """M1-M13 on the events table: sessions = (user, day), score = value."""
    return _metrics_out(evaluate(event_sessions(spark, sf_dir), EVENT_TARGETS)["metrics"])


# ---------------------------------------------------------------- skewed sessions (hot-session path)
SKEW_HOT_ROWS = 10_000


def _skewed(spark, sf_dir, details_only=False):
    """Sessions keyed by platform: three keys, each holding a fifth to two
    fifths of all rows.  With 10,000 scores a bucket they are cut into several score buckets
    at test scale; the result does not depend on that number."""
    return evaluate(impressions(spark, sf_dir), DEFAULT_TARGETS, score_col="score_alt", session_col="platform",
                    session_rows=SKEW_HOT_ROWS, details_only=details_only)


@register("gauc_skewed_sessions")
def q_gauc_skewed_sessions(spark, sf_dir):
    """M3-M9 with hot sessions split into score buckets."""
    return _metrics_out(_skewed(spark, sf_dir)["metrics"])


@register("gauc_skewed_details")
def q_gauc_skewed_details(spark, sf_dir):
    """M4 per hot session."""
    d = _skewed(spark, sf_dir, details_only=True)["group_details"]
    return d.select("target", "session_id", r9("auc").alias("auc"), "size", "positives", "negatives",
                    r9("positive_rate").alias("positive_rate"))


# ---------------------------------------------------------------- operators the queries above do not reach
POSITION_ORDER = ["score", "line"]


@register("session_positions")
def q_session_positions(spark, sf_dir):
    """Positions inside each session by the caller's order columns."""
    imp = impressions(spark, sf_dir).withColumnRenamed("pos", "line").select("rid", "line", "score")
    return FT.with_positions(imp, tiebreak=POSITION_ORDER).select("rid", "line", "pos")


@register("feature_map")
def q_feature_map(spark, sf_dir):
    """The valid pairs as a map, last value of a repeated id."""
    from rankfold.functions.vectors import feature_map
    m = impressions(spark, sf_dir).select("rid", "pos", feature_map("features").alias("m"))
    return m.select("rid", "pos", F.size("m").alias("n_ids"),
                    *[F.try_element_at("m", F.lit(i)).alias(f"m_{i}") for i in VOCAB])


@register("vocab_resolve")
def q_vocab_resolve(spark, sf_dir):
    """S5 (file order), X1, X2: brand names resolved through a dictionary that lacks some and repeats ids."""
    from pyspark.sql import Window
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    names = part.groupBy(F.col("p_brand").alias("feature_name")).agg(F.min("p_partkey").alias("first"))
    # a few dozen brands, whatever the number of parts
    names = names.select("feature_name", (F.row_number().over(Window.orderBy("first")) - 1).alias("idx"))
    ids = part.groupBy(F.col("p_brand").alias("feature_name")).agg((F.max("p_partkey") % 17).alias("feature_id"))
    return FT.resolve_vocabulary(names, ids.where("feature_id % 5 != 0")).select("idx", "feature_name", "feature_id")


@register("ndjson_roundtrip")
def q_ndjson_roundtrip(spark, sf_dir):
    """Impressions as NDJSON lines, read back by the raw schema and its conversions."""
    imp = impressions(spark, sf_dir)
    lines = imp.select("rid", "pos", F.to_json(F.struct(*[f.name for f in X.RAW_SCHEMA.fields])).alias("line"))
    raw = lines.select("pos", F.from_json("line", X.RAW_SCHEMA, {"mode": "FAILFAST"}).alias("r")).select("pos", "r.*")
    back = X.normalize_raw(raw)
    return back.select("rid", "pos", "score", F.array_join("events", ",").alias("events_str"), "viewTimeSec",
                       "durationSeconds", "navScreen", "platform", "formulaPath", "typeId", "userType", "recommenderId",
                       F.size("features").alias("n_features"), F.col("features")[0][1].alias("first_value"))


@register("pair_table_normalized")
def q_pair_table_normalized(spark, sf_dir):
    """P5: pair weights divided by the total raw weight of their session and target."""
    p = PR.pair_table(_feature_table(spark, sf_dir), normalize=True)
    return p.select("rid", "target", "winner_pos", "loser_pos", r6("pair_weight").alias("pair_weight"))


@register("pair_normalized_check")
def q_pair_normalized_check(spark, sf_dir):
    """P5: count, sum of weights (1 for every session and target) and sum of squared weights of the normalised pairs."""
    p = PR.pair_table(_feature_table(spark, sf_dir), normalize=True).groupBy("rid", "target")
    return p.agg(F.count(F.lit(1)).alias("n_pairs"), r6(F.sum("pair_weight")).alias("total"), r6(F.sum(F.col("pair_weight") * F.col("pair_weight"))).alias("squares"))


def _by_platform(spark, sf_dir):
    """The feature table with one session per platform: three of a third of all rows or so."""
    imp = impressions(spark, sf_dir)
    ft = FT.feature_table(imp.withColumn("rid", F.concat_ws(":", "rid", "platform")), [], *WEIGHTS)
    return ft.select(F.element_at(F.split("rid", ":"), -1).alias("rid"), F.xxhash64("rid", "pos").alias("pos"), "targets")


@register("pair_totals_hot")
def q_pair_totals_hot(spark, sf_dir):
    """P4 with sessions of a fifth to two fifths of all rows, cut into parts of 5,000 rows."""
    t = PR.pair_totals(_by_platform(spark, sf_dir), session_rows=5000)
    return t.select("rid", "target", "n_pairs", F.round(F.col("total_raw_weight") / F.col("n_pairs"), 9).alias("mean_raw_weight"))


@register("win_labels_hot")
def q_win_labels_hot(spark, sf_dir):
    """P9 with the same sessions: rows and their wins per session and share of wins."""
    w = PR.win_labels(_by_platform(spark, sf_dir), session_rows=5000)
    return w.groupBy("rid", "wins").agg(F.count(F.lit(1)).alias("n"))


DENSE_TASK_ROWS = 10_000


@register("dense_wide")
def q_dense_wide(spark, sf_dir):
    """X3 at the reference's width: 400 pairs a row on 266 vocabulary ids, ids repeated and unknown ones too."""
    from rankfold.functions.vectors import dense_vector
    key = F.col("c_custkey")
    pairs = F.transform(F.sequence(F.lit(1), F.lit(400)), lambda i: F.array((key * i % 997).cast("double"), i / 8.0))
    keys = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    # a row becomes 400 pairs: tasks by the number of rows, not by the few bytes of their keys
    keys = keys.repartition(max(1, -(-keys.count() // DENSE_TASK_ROWS)))
    rows = keys.select("c_custkey", dense_vector(pairs, WIDE_VOCAB, default=-1.0).alias("v"))
    return rows.select("c_custkey", F.size(F.filter("v", lambda x: x >= 0)).alias("found"),
                       F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double")).alias("total"), F.col("v")[100].cast("double").alias("v100"))


@register("pair_check")
def q_pair_check(spark, sf_dir):
    """Count and sums of the pairs of every session and target."""
    p = PR.pair_table(_feature_table(spark, sf_dir)).groupBy("rid", "target")
    return p.agg(F.count(F.lit(1)).alias("n_pairs"), F.sum("winner_pos").alias("winners"), F.sum("loser_pos").alias("losers"),
                 r6(F.sum("pair_weight")).alias("pair_weight"))


@register("pair_export_check")
def q_pair_export_check(spark, sf_dir):
    """Count and sums of the pairs read back, per target and block of 100 winners."""
    back = _exported_pairs(spark, sf_dir).groupBy("target", F.floor(F.col("winner") / 100).alias("block"))
    return back.agg(F.count(F.lit(1)).alias("n_pairs"), F.sum("loser").alias("losers"), r6(F.sum("pair_weight")).alias("pair_weight"))


NO_EVENT_TARGETS = {"action_play": DEFAULT_TARGETS["action_play"], "never": TargetConfig("never", "noSuchEvent")}


@register("gauc_without_positives")
def q_gauc_without_positives(spark, sf_dir):
    """M8: a target without any valid session gives zeros, marked invalid."""
    return _metrics_out(evaluate(impressions(spark, sf_dir), NO_EVENT_TARGETS)["metrics"])


@register("metric_lookup")
def q_metric_lookup(spark, sf_dir):
    """Single values of the summary's target details."""
    d = evaluate(impressions(spark, sf_dir))["target_details"]
    rows = [(t, m, float(M.lookup(d, t, m))) for t in DEFAULT_TARGETS for m in ("AUC", "GAUCWeighted", "n_groups")]
    return spark.createDataFrame(rows, "target string, metric string, value double").select("target", "metric", r9("value").alias("value"))


LOG_RUNS = 40
LOG_POSITION = -10
LOG_SESSIONS = 1000


@register("runlog_nth")
def q_runlog_nth(spark, sf_dir):
    """Session AUCs of the tenth message from the end (one per session id modulo 40, in parts of at most
    1,000 sessions by spans of ids, so that more sessions make more parts and no longer ones)."""
    number = F.col("session_id").cast("long")
    part = F.floor(number / F.lit(LOG_RUNS * LOG_SESSIONS))
    logs = RL.render_messages(_details(spark, sf_dir), start_time=0.0, chunk=F.pmod(number, F.lit(LOG_RUNS)), part=part)
    out = RL.session_aucs(logs, "action_play", position=LOG_POSITION, parts=True)
    return out.select("session_id", r9("auc").alias("auc"), "size", "positives", "negatives")


TRIAL_GRID = [(1.0, 1.0, 1.0), (5.0, 14.0, 0.41), (0.5, 2.0, 10.0)]


@register("trial_grid")
def q_trial_grid(spark, sf_dir):
    """A fixed grid of weights, the objective from a linear score with these weights as coefficients."""
    from rankfold.functions.vectors import dense_vector
    from rankfold.operators import tuning as TU
    imp = impressions(spark, sf_dir).withColumn("features", dense_vector("features", [2, 3, 1]))
    name = "watch_coverage_30s"
    data = TU.SearchData(imp, imp, name, {name: DEFAULT_TARGETS[name]})

    def weighted_scores(data, weights, model_paths=None):
        scored, columns = data.validation, [f"model_score{k}" for k in range(len(weights))]
        for column, (like_weight, dislike_weight, consumption_time_weight) in zip(columns, weights):
            scored = RK.score(scored, [like_weight, -dislike_weight, consumption_time_weight], score_col=column)
        found = M.gauc(scored, data.target_configs, score_col=columns, calculate_regular_auc=False, exact_median=False)
        return [(float(M.lookup(m, data.target_name, "GAUCWeighted")), 0) for m, _ in found]

    trials = TU.search(spark, data, timeout=None, grid=TRIAL_GRID, objectives=weighted_scores)
    best = TU.best_trial(trials).select("trial", F.lit(True).alias("best"))
    return trials.join(best, "trial", "left").select("trial", "like_weight", "dislike_weight", "consumption_time_weight",
                                                     r9("value").alias("value"), F.coalesce("best", F.lit(False)).alias("best"))


# ---------------------------------------------------------------- readers over files in the shared folder
def _shared_path(spark, name):
    import uuid

    from rankfold.session import checkpoint_dir
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register("ndjson_file_roundtrip")
def q_ndjson_file_roundtrip(spark, sf_dir):
    """Impressions written as NDJSON files in (rid, pos) order and read by the file reader, which numbers the positions."""
    path = _shared_path(spark, "impressions")
    imp = impressions(spark, sf_dir)
    rows = read_table(spark, sf_dir, "lineitem").count()
    # a row travels as its line and the keys of the order
    lines = imp.select("rid", "pos", F.to_json(F.struct(*[f.name for f in X.RAW_SCHEMA.fields])).alias("value"))
    tasks = tasks_for(spark, rows)
    ordered = lines.repartitionByRange(tasks, "rid", "pos") if tasks else lines.repartitionByRange("rid", "pos")
    with shuffles_dropped(spark):
        ordered.sortWithinPartitions("rid", "pos").select("value").write.text(path, compression="gzip")
    # of the texts, those of few values come first: the order in which they are moved, the rows are the same
    back = X.read_impressions(spark, path, rows=rows, columns=[
        "rid", "score", "viewTimeSec", "durationSeconds", F.col("features")[0][1].alias("first_value"), F.size("features").alias("n_features"),
        "typeId", "recommenderId", "formulaPath", "userType", "navScreen", "platform", F.array_join("events", ",").alias("events_str")])
    return back.select("rid", "pos", "score", "events_str", "viewTimeSec", "durationSeconds", "navScreen", "platform", "formulaPath", "typeId",
                       "userType", "recommenderId", "n_features", "first_value")


@register("runlog_file")
def q_runlog_file(spark, sf_dir):
    """The run log written as NDJSON files and read back by its reader."""
    path = _shared_path(spark, "runlog")
    RL.render_messages(_details(spark, sf_dir), chunk_sessions=1000).write.json(path)
    out = RL.all_session_aucs(RL.read_run_log(spark, path))
    return out.select("target", "session_id", r9("auc").alias("auc"), "size", "positives", "negatives",
                      r9("positive_rate").alias("positive_rate"))


@register("vocab_file")
def q_vocab_file(spark, sf_dir):
    """The brand names as a name file, read in file order and resolved."""
    path = _shared_path(spark, "names")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    # a vocabulary of a few dozen brands: one file
    names = part.groupBy("p_brand").agg(F.min("p_partkey").alias("first")).repartition(1).sortWithinPartitions("first")
    names.select(F.concat(F.lit("  "), "p_brand", F.lit(" ")).alias("value")).write.text(path)
    ids = part.groupBy(F.col("p_brand").alias("feature_name")).agg((F.max("p_partkey") % 17).alias("feature_id"))
    return FT.resolve_vocabulary(FT.read_feature_names(spark, path), ids.where("feature_id % 5 != 0")).select("idx", "feature_name", "feature_id")


@register("label_stats_empty")
def q_label_stats_empty(spark, sf_dir):
    """An empty slice gives zeros for every target, an empty target list no row."""
    empty = impressions(spark, sf_dir).where("score < -1e300")
    labeled, names = M.with_labels(empty, DEFAULT_TARGETS)
    stats = M.label_stats(labeled, names).select("target", "total_samples", "total_positives", r9("positive_rate").alias("positive_rate"))
    nothing, _ = M.gauc(impressions(spark, sf_dir), [])
    return stats.union(nothing.select("target", "total_samples", "total_positives", "positive_rate"))
