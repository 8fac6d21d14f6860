"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The oracle deliberately uses different algorithms from the Spark side, e.g.
AUC through average ranks (``rank()`` + tie counts) instead of bucketed
running sums, and pairs through a plain self-join.
"""

from __future__ import annotations

from rankfold.config import DEFAULT_FORMULA_PATH
from rankfold.config import DEFAULT_TARGETS
from rankfold.sources.testdata import IMPRESSIONS_DUCKDB

ORACLE: dict[str, str] = {}


def _has(ev: str) -> str:
    return f"coalesce(list_contains(events, '{ev}'), false)"


def _label_sql(cfg) -> str:
    cond = _has(cfg.event_name)
    if cfg.view_threshold_sec is not None:
        cond += f" AND CAST(viewTimeSec AS DOUBLE) >= {float(cfg.view_threshold_sec)}"
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


def _clean(col: str) -> str:
    return f"coalesce(CASE WHEN isnan({col}) THEN 0.0 ELSE {col} END, 0.0)"


def long_labels(source: str = "impressions", score: str = "score", where: str = "TRUE", targets=None,
                session: str = "rid") -> str:
    """UNION ALL of one select per target: (target, rid, score, label)."""
    targets = targets or DEFAULT_TARGETS
    parts = [f"SELECT '{name}' AS target, {session} AS rid, {_clean(score)} AS score, {_label_sql(cfg)} AS label "
             f"FROM {source} WHERE {where}" for name, cfg in targets.items()]
    return "\nUNION ALL\n".join(parts)


def metric_ctes(where: str = "TRUE", source_cte: str = IMPRESSIONS_DUCKDB, targets=None, session: str = "rid",
                score: str = "score", long_sql: str = "") -> str:
    """CTEs: long, stats, details, summ, aucs, metrics (all targets)."""
    return f"""WITH {source_cte},
long AS ({long_sql or long_labels(where=where, targets=targets, session=session, score=score)}),
stats AS (
  SELECT target, CAST(count(*) AS BIGINT) AS total_samples, CAST(sum(label) AS BIGINT) AS total_positives,
         CASE WHEN count(*) > 0 THEN sum(label) / count(*) ELSE 0.0 END AS positive_rate
  FROM long GROUP BY target),
ranked AS (
  SELECT target, rid, score, label,
         rank() OVER (PARTITION BY target, rid ORDER BY score) AS rk,
         count(*) OVER (PARTITION BY target, rid, score) AS ties
  FROM long WHERE rid IS NOT NULL),
sess AS (
  SELECT target, rid AS session_id, CAST(count(*) AS BIGINT) AS size, CAST(sum(label) AS BIGINT) AS positives,
         CAST(count(*) - sum(label) AS BIGINT) AS negatives,
         sum(CASE WHEN label = 1 THEN rk + (ties - 1) / 2.0 ELSE 0.0 END) AS rsum
  FROM ranked GROUP BY target, rid),
details AS (
  SELECT target, session_id,
         (rsum - positives * (positives + 1) / 2.0) / (CAST(positives AS DOUBLE) * CAST(negatives AS DOUBLE)) AS auc,
         size, positives, negatives, positives / size AS positive_rate
  FROM sess WHERE positives > 0 AND negatives > 0),
summ AS (
  SELECT target, avg(auc) AS GAUCSimple, sum(auc * size) / sum(size) AS GAUCWeighted,
         CAST(count(*) AS BIGINT) AS n_groups, stddev_pop(auc) AS std, min(auc) AS min, max(auc) AS max,
         median(auc) AS median
  FROM details GROUP BY target),
granked AS (
  SELECT target, label, rank() OVER (PARTITION BY target ORDER BY score) AS rk,
         count(*) OVER (PARTITION BY target, score) AS ties FROM long),
gsum AS (
  SELECT target, sum(label) AS p, count(*) - sum(label) AS n,
         sum(CASE WHEN label = 1 THEN rk + (ties - 1) / 2.0 ELSE 0.0 END) AS rsum
  FROM granked GROUP BY target),
aucs AS (
  SELECT target, CASE WHEN p > 0 AND n > 0 THEN (rsum - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * CAST(n AS DOUBLE))
                      ELSE 0.0 END AS AUC, (p > 0 AND n > 0) AS AUC_valid
  FROM gsum),
metrics AS (
  SELECT s.target, s.total_samples, s.total_positives, s.positive_rate,
         coalesce(a.AUC, 0.0) AS AUC, coalesce(a.AUC_valid, false) AS AUC_valid,
         coalesce(g.GAUCSimple, 0.0) AS GAUCSimple, coalesce(g.GAUCWeighted, 0.0) AS GAUCWeighted,
         coalesce(g.n_groups, 0) AS n_groups, coalesce(g.std, 0.0) AS std, coalesce(g.min, 0.0) AS min,
         coalesce(g.max, 0.0) AS max, coalesce(g.median, 0.0) AS median, coalesce(g.n_groups, 0) > 0 AS GAUC_valid
  FROM stats s LEFT JOIN aucs a USING (target) LEFT JOIN summ g USING (target))
"""


_METRIC_SELECT = """SELECT target, total_samples, total_positives, round(positive_rate, 9) AS positive_rate,
  round(AUC, 9) AS AUC, AUC_valid, round(GAUCSimple, 9) AS GAUCSimple, round(GAUCWeighted, 9) AS GAUCWeighted,
  n_groups, round(std, 9) AS std, round(min, 9) AS min, round(max, 9) AS max, round(median, 9) AS median,
  GAUC_valid FROM metrics"""

_SLICE = ("navScreen = 'video_for_you' AND platform IN ('android', 'vk_video_android') "
          f"AND formulaPath = '{DEFAULT_FORMULA_PATH}'")

ORACLE["gauc_by_target"] = metric_ctes() + _METRIC_SELECT
ORACLE["eval_slice"] = metric_ctes(_SLICE) + _METRIC_SELECT
ORACLE["gauc_group_details"] = metric_ctes() + """SELECT target, session_id, round(auc, 9) AS auc, size,
  positives, negatives, round(positive_rate, 9) AS positive_rate FROM details"""
ORACLE["label_stats"] = metric_ctes() + """SELECT target, total_samples, total_positives,
  round(positive_rate, 9) AS positive_rate FROM stats"""
ORACLE["auc_by_target"] = f"""WITH {IMPRESSIONS_DUCKDB},
long AS ({long_labels(score='score_alt')}),
granked AS (
  SELECT target, label, rank() OVER (PARTITION BY target ORDER BY score) AS rk,
         count(*) OVER (PARTITION BY target, score) AS ties FROM long),
gsum AS (
  SELECT target, sum(label) AS p, count(*) - sum(label) AS n,
         sum(CASE WHEN label = 1 THEN rk + (ties - 1) / 2.0 ELSE 0.0 END) AS rsum
  FROM granked GROUP BY target)
SELECT target, round(CASE WHEN p > 0 AND n > 0 THEN (rsum - p * (p + 1) / 2.0) / (CAST(p AS DOUBLE) * CAST(n AS DOUBLE))
                     ELSE 0.0 END, 9) AS AUC, (p > 0 AND n > 0) AS AUC_valid
FROM gsum"""
ORACLE["auc_gauc_compare"] = metric_ctes() + """SELECT target, round(AUC, 9) AS AUC,
  round(GAUCWeighted, 9) AS GAUCWeighted, round(GAUCSimple, 9) AS GAUCSimple,
  round(AUC - GAUCWeighted, 9) AS difference_auc_gauc_weighted,
  round(AUC - GAUCSimple, 9) AS difference_auc_gauc_simple,
  round((AUC - GAUCWeighted) / greatest(AUC, 1e-10), 9) AS relative_diff_auc_gauc_weighted,
  n_groups, total_samples, AUC_valid, GAUC_valid,
  CASE WHEN abs(AUC - GAUCWeighted) < 0.01 THEN 'high' WHEN abs(AUC - GAUCWeighted) < 0.05 THEN 'medium'
       ELSE 'low' END AS similarity
FROM metrics"""
ORACLE["metric_summary"] = metric_ctes() + """SELECT CAST(count(*) AS BIGINT) AS total_targets,
  CAST(count(*) FILTER (WHERE AUC_valid) AS BIGINT) AS targets_with_valid_auc,
  CAST(count(*) FILTER (WHERE GAUC_valid) AS BIGINT) AS targets_with_valid_gauc,
  round(coalesce(avg(AUC) FILTER (WHERE AUC_valid), 0.0), 9) AS average_auc,
  round(coalesce(avg(GAUCWeighted) FILTER (WHERE GAUC_valid), 0.0), 9) AS average_gauc_weighted,
  round(coalesce(avg(GAUCSimple) FILTER (WHERE GAUC_valid), 0.0), 9) AS average_gauc_simple
FROM metrics"""


# ---------------------------------------------------------------- slices and extracts
_F3 = _SLICE + " AND typeId = 1776 AND userType = 'vk' AND recommenderId = 200"
ORACLE["train_extract_topk"] = f"""WITH {IMPRESSIONS_DUCKDB}
SELECT rid, pos, typeId, userType, recommenderId, navScreen, platform, formulaPath, viewTimeSec,
       durationSeconds, score, array_to_string(events, ',') AS events_str, CAST(len(features) AS INTEGER) AS n_features
FROM impressions WHERE {_F3} ORDER BY rid, pos LIMIT 500000"""

ORACLE["train_extract_cut"] = f"""WITH {IMPRESSIONS_DUCKDB}
SELECT rid, pos, viewTimeSec, durationSeconds, score FROM impressions WHERE {_F3} ORDER BY rid, pos LIMIT 2000"""

ORACLE["train_extract_sessions"] = f"""WITH {IMPRESSIONS_DUCKDB},
ranked AS (SELECT rid, pos, viewTimeSec, durationSeconds, score, row_number() OVER (ORDER BY rid, pos) AS k FROM impressions WHERE {_F3})
SELECT rid, pos, viewTimeSec, durationSeconds, score FROM ranked QUALIFY max(k) OVER (PARTITION BY rid) <= 2000"""

ORACLE["slice_projection"] = f"""WITH {IMPRESSIONS_DUCKDB}
SELECT navScreen, rid, array_to_string(events, ',') AS events_str, viewTimeSec, platform, score, formulaPath
FROM impressions WHERE platform = 'vk_video_android' AND navScreen = 'video_for_you'
  AND formulaPath = '{DEFAULT_FORMULA_PATH}'"""

ORACLE["event_pattern_label"] = f"""WITH {IMPRESSIONS_DUCKDB}
SELECT rid, pos, CAST(coalesce(len(list_filter(events, lambda e: regexp_matches(e, 'action(Play|Like)'))) > 0, false)
                      AND coalesce(CAST(viewTimeSec AS DOUBLE) >= 30.0, false) AS INTEGER) AS label
FROM impressions"""


# ---------------------------------------------------------------- targets and features
def _ct_sql(v: str = "CAST(viewTimeSec AS DOUBLE)", d: str = "CAST(durationSeconds AS DOUBLE)") -> str:
    from rankfold.functions import targets as T
    regain = repr(T.CT_UPPER ** (1.0 - T.CT_SMOOTH))
    nwt = (f"(CASE WHEN {d} > 7200.0 THEN 850.0 ELSE least({T.CT_QUAD!r} * {d} * {d} + {T.CT_LIN!r} * {d} "
           f"+ {T.CT_CONST!r}, {d} / 2.0) END)")
    cw = f"(0.01 * {nwt})"
    nw = f"(({d} / ({d} - {nwt} + {cw})) * greatest({v} - {nwt}, {cw}))"
    val = f"(least({nw}, 7200.0) * 12.0 / ((pow(least({d}, 7200.0), 0.25) + 1e-7) * {regain}))"
    return f"CASE WHEN {v} > 0.0 AND {d} > 0.0 THEN {val} ELSE 0.0 END"


_TRAIN_WHERE = ("typeId = 1776 AND userType = 'vk' AND recommenderId = 200 AND "
                "coalesce(len(list_intersect(events, ['actionDislike','actionLike','watchCoverageRecord','card_view'])) > 0, false)")


def _dense_sql(vocab, default="CAST(-3.4e38 AS FLOAT)", rnd=True, prefix="f_", src="features") -> str:
    cols = []
    for i, fid in enumerate(vocab):
        last = f"list_filter({src}, lambda f: CAST(f[1] AS INTEGER) = {int(fid)})[-1][2]"
        val = f"round({last}, 8)" if rnd else last
        cols.append(f"coalesce(CAST({val} AS FLOAT), {default}) AS {prefix}{i}")
    return ", ".join(cols)


TARGET_CTES = f"""WITH {IMPRESSIONS_DUCKDB},
tgt AS (
  SELECT rid, pos, features,
    CASE WHEN {_has('actionLike')} AND NOT {_has('actionUnlike')} THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS like_target,
    CASE WHEN {_has('actionDislike')} AND NOT {_has('actionUndislike')} THEN CAST(0.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS dislike_target,
    {_ct_sql()} AS consumption_time_target
  FROM impressions WHERE {_TRAIN_WHERE}),
tgt2 AS (SELECT *, 2.0 * (2.0 * like_target + dislike_target) + consumption_time_target AS label_value FROM tgt),
ft AS (SELECT * FROM tgt2 WHERE len(list_distinct([like_target, dislike_target, consumption_time_target])) > 1),
long AS MATERIALIZED (
  SELECT rid, pos, 'like' AS name, like_target AS target, CAST(5.0 AS DOUBLE) AS weight FROM ft
  UNION ALL SELECT rid, pos, 'dislike', dislike_target, CAST(14.0 AS DOUBLE) FROM ft
  UNION ALL SELECT rid, pos, 'consumption_time', consumption_time_target, CAST(0.41 AS DOUBLE) FROM ft),
pairs AS (
  SELECT a.rid, a.name AS target, a.pos AS winner_pos, b.pos AS loser_pos, a.weight * (a.target - b.target) AS pair_weight,
         a.target - b.target AS gap
  FROM long a JOIN long b ON a.rid = b.rid AND a.name = b.name AND a.target > b.target
  WHERE abs(a.weight * (a.target - b.target)) >= 1e-8)
"""

_TARGET_SELECT = """SELECT rid, pos, like_target, dislike_target, round(consumption_time_target, 9) AS consumption_time_target,
  round(label_value, 9) AS label_value FROM """

ORACLE["graded_targets"] = TARGET_CTES + _TARGET_SELECT + "tgt2"
ORACLE["informative_rows"] = TARGET_CTES + _TARGET_SELECT + "ft"
ORACLE["dense_features"] = f"""WITH {IMPRESSIONS_DUCKDB}
SELECT rid, pos, {_dense_sql([2, 5, 1, 9])} FROM impressions"""
ORACLE["features_text_roundtrip"] = TARGET_CTES + f"""SELECT rid, pos, round(label_value, 9) AS label_value,
  {_dense_sql([2, 5, 1, 9])} FROM ft"""
ORACLE["pair_table"] = TARGET_CTES + """SELECT rid, target, winner_pos, loser_pos, round(pair_weight, 9) AS pair_weight
FROM pairs"""
ORACLE["pair_totals"] = TARGET_CTES + """SELECT a.rid, a.name AS target, count(*) AS n_pairs,
  round(sum(a.target - b.target), 9) AS total_raw_weight
FROM long a JOIN long b ON a.rid = b.rid AND a.name = b.name AND a.target > b.target GROUP BY a.rid, a.name"""
ORACLE["pair_export_roundtrip"] = TARGET_CTES + """, idx AS (SELECT rid, pos, row_number() OVER (ORDER BY rid, pos) - 1 AS row_index FROM ft)
SELECT w.row_index AS winner, l.row_index AS loser, p.target, round(p.pair_weight, 9) AS pair_weight
FROM pairs p JOIN idx w ON p.rid = w.rid AND p.winner_pos = w.pos JOIN idx l ON p.rid = l.rid AND p.loser_pos = l.pos"""
ORACLE["win_labels"] = TARGET_CTES + """, wins AS (SELECT rid, winner_pos AS pos, count(*) AS wins FROM pairs GROUP BY ALL),
mx AS (SELECT max(wins) AS m FROM wins)
SELECT f.rid, f.pos, CAST(coalesce(w.wins, 0) AS BIGINT) AS wins,
       CAST(CASE WHEN (SELECT m FROM mx) > 0 THEN coalesce(w.wins, 0) / (SELECT m FROM mx) ELSE coalesce(w.wins, 0) END AS FLOAT) AS win_label
FROM ft f LEFT JOIN wins w ON f.rid = w.rid AND f.pos = w.pos"""
ORACLE["group_sizes"] = TARGET_CTES + """SELECT rid, row_number() OVER (ORDER BY rid) - 1 AS group_id, size
FROM (SELECT rid, count(*) AS size FROM ft GROUP BY rid)"""


# ---------------------------------------------------------------- matrices and feature statistics
_VALID_PAIRS = "list_filter(features, lambda f: len(f) >= 2 AND f[1] IS NOT NULL AND f[2] IS NOT NULL)"
ORACLE["dense_matrix"] = f"""WITH {IMPRESSIONS_DUCKDB}
SELECT rid, pos, {_dense_sql(range(8), default="CAST(0.0 AS FLOAT)", rnd=False, prefix="feat_")} FROM impressions"""
ORACLE["matrix_health"] = f"""WITH {IMPRESSIONS_DUCKDB},
m AS (SELECT {_dense_sql(range(8), default="CAST(0.0 AS FLOAT)", rnd=False, prefix="feat_")} FROM impressions),
cells AS (SELECT unnest(range(8)) AS i, unnest([feat_0, feat_1, feat_2, feat_3, feat_4, feat_5, feat_6, feat_7]) AS v FROM m),
percol AS (SELECT i, sum(CASE WHEN v <> 0 THEN 1 ELSE 0 END) AS nz FROM cells GROUP BY i),
rows_ AS (SELECT count(*) AS n FROM impressions)
SELECT CAST(sum(nz) AS BIGINT) AS non_zero, CAST((SELECT n FROM rows_) * 8 AS BIGINT) AS total_cells,
       round(sum(nz) / ((SELECT n FROM rows_) * 8), 9) AS non_zero_share,
       CAST(count(*) FILTER (WHERE nz > 0) AS INTEGER) AS used_features,
       array_to_string(list_sort(list(i) FILTER (WHERE nz = 0))[1:10], ',') AS unused_first10
FROM percol"""
_PAIRS_SQL = f"""p AS (SELECT CAST(f[1] AS INTEGER) AS feature_id, f[2] AS value
  FROM (SELECT unnest({_VALID_PAIRS}) AS f FROM impressions))"""
ORACLE["feature_profile"] = f"""WITH {IMPRESSIONS_DUCKDB}, {_PAIRS_SQL}
SELECT feature_id, count(*) AS count, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
       round(min(value), 6) AS min, round(max(value), 6) AS max
FROM p WHERE feature_id < 256 GROUP BY feature_id"""
ORACLE["feature_totals"] = f"""WITH {IMPRESSIONS_DUCKDB}, {_PAIRS_SQL}
SELECT count(*) AS total_rows, CAST(sum(len(features)) AS BIGINT) AS total_feature_pairs,
       round(sum(len(features)) / count(*), 9) AS avg_pairs_per_row,
       (SELECT CAST(max(feature_id) AS INTEGER) FROM p) AS max_feature_index
FROM impressions"""
ORACLE["frequent_features"] = f"""WITH {IMPRESSIONS_DUCKDB},
p AS (SELECT CAST(f[1] AS INTEGER) AS feature_id
  FROM (SELECT unnest(list_filter(features, lambda f: len(f) >= 2 AND f[1] IS NOT NULL)) AS f FROM impressions))
SELECT feature_id, count(*) AS n FROM p GROUP BY feature_id HAVING count(*) >= 10 ORDER BY feature_id LIMIT 500"""
ORACLE["selected_matrix_train_test"] = f"""WITH {IMPRESSIONS_DUCKDB},
vocab AS (
  SELECT list(feature_id ORDER BY feature_id) AS ids FROM (
    SELECT CAST(f[1] AS INTEGER) AS feature_id
    FROM (SELECT unnest(list_filter(features, lambda f: len(f) >= 2 AND f[1] IS NOT NULL)) AS f
          FROM impressions WHERE day < DATE '1998-04-25')
    GROUP BY 1 HAVING count(*) >= 10 ORDER BY 1 LIMIT 4)),
test AS (SELECT * FROM impressions, vocab WHERE day >= DATE '1998-04-25')
SELECT rid, pos,
  CAST(coalesce(len(list_filter(events, lambda e: regexp_matches(e, 'actionPlay'))) > 0, false) AS INTEGER) AS label,
  {", ".join(f"coalesce(CAST(list_filter({_VALID_PAIRS}, lambda f: CAST(f[1] AS INTEGER) = ids[{k + 1}])[-1][2] AS FLOAT), CAST(0.0 AS FLOAT)) AS x_{k}" for k in range(4))},
  array_to_string(ids, ',') AS feature_ids
FROM test"""


# ---------------------------------------------------------------- fixed-coefficient scoring
def _score_sql() -> str:
    coef = [0.05, -2.0, 3.0, 0.01, 0.0005]
    terms = []
    for k, (fid, c) in enumerate(zip([1, 2, 3, 4, 5], coef)):
        x = f"CAST(round(list_filter({_VALID_PAIRS}, lambda f: CAST(f[1] AS INTEGER) = {fid})[-1][2], 8) AS FLOAT)"
        terms.append(f"CAST(coalesce(CASE WHEN isnan({x}) THEN NULL ELSE {x} END, 0.0) AS DOUBLE) * {c!r}")
    return "(" + " + ".join(["0.0"] + terms) + ")"


ORACLE["linear_score"] = f"""WITH {IMPRESSIONS_DUCKDB}
SELECT rid, pos, round({_score_sql()}, 9) AS model_score FROM impressions"""
ORACLE["score_stats"] = f"""WITH {IMPRESSIONS_DUCKDB}, s AS (SELECT {_score_sql()} AS v FROM impressions)
SELECT round(min(v), 6) AS min, round(max(v), 6) AS max, round(stddev_pop(v), 6) AS std FROM s"""


# ---------------------------------------------------------------- run logs and AUC distributions
ORACLE["runlog_aucs"] = ORACLE["gauc_group_details"]


def _density_sql(src: str) -> str:
    return f"""kstats AS (SELECT target, count(*) AS n, stddev_samp(auc) AS sd FROM {src} GROUP BY target
                HAVING count(*) >= 2 AND stddev_samp(auc) > 0),
dv AS (SELECT target, auc, count(*) AS c FROM {src} GROUP BY target, auc),
ex AS (SELECT dv.target, auc, c, n, sd * pow(CAST(n AS DOUBLE), -0.2) AS h, unnest(range(101)) / 100.0 AS x
       FROM dv JOIN kstats USING (target))
SELECT target, round(x, 9) AS x,
       round(sum(c * exp(-0.5 * ((x - auc) / h) * ((x - auc) / h))) / (max(n) * max(h) * sqrt(2 * pi())), 6) AS density
FROM ex GROUP BY target, x"""


ORACLE["auc_density"] = metric_ctes() + ", " + _density_sql("details")
ORACLE["auc_density_by_run"] = metric_ctes() + """, numbered AS (
  SELECT target, auc, row_number() OVER (PARTITION BY target ORDER BY session_id) AS rn FROM details),
cut AS (SELECT target, auc FROM numbered WHERE rn <= (SELECT min(c) FROM (SELECT count(*) AS c FROM details GROUP BY target))),
""" + _density_sql("cut")


# ---------------------------------------------------------------- second source: event sessions
from rankfold.config import TargetConfig  # noqa: E402
from rankfold.sources.testdata import EVENT_SESSIONS_DUCKDB  # noqa: E402

EVENT_TARGETS = {"purchase": TargetConfig("purchase", "purchase"), "click": TargetConfig("click", "click"),
                 "signup": TargetConfig("signup", "signup")}
ORACLE["gauc_events"] = metric_ctes(source_cte=EVENT_SESSIONS_DUCKDB, targets=EVENT_TARGETS) + _METRIC_SELECT


# ---------------------------------------------------------------- skewed sessions (hot-session path)
ORACLE["gauc_skewed_sessions"] = metric_ctes(session="platform", score="score_alt") + _METRIC_SELECT
ORACLE["gauc_skewed_details"] = metric_ctes(session="platform", score="score_alt") + """SELECT target, session_id,
  round(auc, 9) AS auc, size, positives, negatives, round(positive_rate, 9) AS positive_rate FROM details"""


# ---------------------------------------------------------------- operators the queries above do not reach
ORACLE["session_positions"] = f"""WITH {IMPRESSIONS_DUCKDB}
SELECT rid, pos AS line, row_number() OVER (PARTITION BY rid ORDER BY score, pos) - 1 AS pos FROM impressions"""
ORACLE["feature_map"] = f"""WITH {IMPRESSIONS_DUCKDB}
SELECT rid, pos, len(list_distinct(list_transform({_VALID_PAIRS}, lambda f: CAST(f[1] AS INTEGER)))) AS n_ids,
  {", ".join(f"round(list_filter({_VALID_PAIRS}, lambda f: CAST(f[1] AS INTEGER) = {i})[-1][2], 8) AS m_{i}" for i in (2, 5, 1, 9))}
FROM impressions"""
ORACLE["vocab_resolve"] = """WITH names AS (
  SELECT p_brand AS feature_name, row_number() OVER (ORDER BY min(p_partkey)) - 1 AS idx FROM part GROUP BY p_brand),
ids AS (SELECT p_brand AS feature_name, max(p_partkey) % 17 AS feature_id FROM part GROUP BY p_brand),
known AS (SELECT * FROM names JOIN ids USING (feature_name) WHERE feature_id % 5 <> 0),
last AS (SELECT * FROM known k WHERE NOT EXISTS (SELECT 1 FROM known l WHERE l.feature_id = k.feature_id AND l.idx > k.idx))
SELECT row_number() OVER (ORDER BY idx) - 1 AS idx, feature_name, feature_id FROM last"""
ORACLE["ndjson_roundtrip"] = f"""WITH {IMPRESSIONS_DUCKDB}
SELECT rid, pos, score, array_to_string(events, ',') AS events_str, viewTimeSec, durationSeconds, navScreen, platform,
  formulaPath, typeId, userType, recommenderId, len(features) AS n_features, features[1][2] AS first_value FROM impressions"""
ORACLE["pair_table_normalized"] = TARGET_CTES + """, totals AS (SELECT a.rid, a.name AS target, sum(a.target - b.target) AS total
  FROM long a JOIN long b ON a.rid = b.rid AND a.name = b.name AND a.target > b.target GROUP BY a.rid, a.name)
SELECT a.rid, a.name AS target, a.pos AS winner_pos, b.pos AS loser_pos, round(a.weight * (a.target - b.target) / t.total, 6) AS pair_weight
FROM long a JOIN long b ON a.rid = b.rid AND a.name = b.name AND a.target > b.target JOIN totals t ON t.rid = a.rid AND t.target = a.name
WHERE abs(a.weight * (a.target - b.target) / t.total) >= 1e-8"""
ORACLE["pair_check"] = TARGET_CTES + """SELECT rid, target, count(*) AS n_pairs, CAST(sum(winner_pos) AS BIGINT) AS winners,
  CAST(sum(loser_pos) AS BIGINT) AS losers, round(sum(pair_weight), 6) AS pair_weight FROM pairs GROUP BY rid, target"""
ORACLE["pair_export_check"] = TARGET_CTES + """, idx AS (SELECT rid, pos, row_number() OVER (ORDER BY rid, pos) - 1 AS row_index FROM ft)
SELECT p.target, CAST(floor(w.row_index / 100) AS BIGINT) AS block, count(*) AS n_pairs, CAST(sum(l.row_index) AS BIGINT) AS losers,
       round(sum(p.pair_weight), 6) AS pair_weight
FROM pairs p JOIN idx w ON p.rid = w.rid AND p.winner_pos = w.pos JOIN idx l ON p.rid = l.rid AND p.loser_pos = l.pos GROUP BY ALL"""
ORACLE["gauc_without_positives"] = metric_ctes(targets={
    "action_play": DEFAULT_TARGETS["action_play"], "never": TargetConfig("never", "noSuchEvent")}) + _METRIC_SELECT
ORACLE["metric_lookup"] = metric_ctes() + """, wide AS (SELECT target, unnest(['AUC', 'GAUCWeighted', 'n_groups']) AS metric,
  unnest([AUC, GAUCWeighted, CAST(n_groups AS DOUBLE)]) AS value FROM metrics)
SELECT target, metric, round(value, 9) AS value FROM wide"""
ORACLE["runlog_nth"] = metric_ctes() + """SELECT session_id, round(auc, 9) AS auc, size, positives, negatives
FROM details WHERE target = 'action_play' AND CAST(session_id AS BIGINT) % 40 = 30"""


def _trial_grid_sql() -> str:
    grid = [(1.0, 1.0, 1.0), (5.0, 14.0, 0.41), (0.5, 2.0, 10.0)]

    def score(weights) -> str:
        x = [f"CAST(coalesce(CAST(round(list_filter(features, lambda f: CAST(f[1] AS INTEGER) = {i})[-1][2], 8) AS FLOAT), 0.0) AS DOUBLE)"
             for i in (2, 3, 1)]
        return "(0.0 + " + " + ".join(f"{v} * CAST({w!r} AS DOUBLE)" for v, w in zip(x, (weights[0], -weights[1], weights[2]))) + ")"

    label = _label_sql(DEFAULT_TARGETS["watch_coverage_30s"])
    long_sql = " UNION ALL ".join(f"SELECT '{k}' AS target, rid, {_clean(score(w))} AS score, {label} AS label FROM impressions"
                                  for k, w in enumerate(grid))
    rows = ", ".join(f"({k}, {a!r}, {b!r}, {c!r})" for k, (a, b, c) in enumerate(grid))
    return metric_ctes(long_sql=long_sql) + f""", g AS (SELECT * FROM (VALUES {rows}) v(trial, l, d, c))
SELECT CAST(trial AS BIGINT) AS trial, CAST(l AS DOUBLE) AS like_weight, CAST(d AS DOUBLE) AS dislike_weight,
       CAST(c AS DOUBLE) AS consumption_time_weight, round(GAUCWeighted, 9) AS value,
       row_number() OVER (ORDER BY GAUCWeighted DESC, trial) = 1 AS best
FROM g JOIN metrics ON target = CAST(trial AS VARCHAR)"""


ORACLE["trial_grid"] = _trial_grid_sql()


# ---------------------------------------------------------------- fitted models
def _value_sql(fid: int, digits: str = "8") -> str:
    """A dense value of a feature id, missing ones as 0."""
    return f"CAST(coalesce(CAST(round(list_filter(features, lambda f: CAST(f[1] AS INTEGER) = {fid})[-1][2], {digits}) AS FLOAT), 0.0) AS DOUBLE)"


_EARLY_CTES = TARGET_CTES.replace("FROM impressions WHERE", "FROM impressions WHERE day < DATE '1998-04-25' AND")
_LATER = _SLICE + " AND day >= DATE '1998-04-25'"


def _gradient_sql() -> str:
    ids, coef = [1, 2, 3, 4, 5], [0.05, -2.0, 3.0, 0.01, 0.0005]
    xs = ", ".join(f"{_value_sql(i)} AS x{i}" for i in ids)
    score = " + ".join(f"x{i} * CAST({c!r} AS DOUBLE)" for i, c in zip(ids, coef))
    terms = " UNION ALL ".join([
        "SELECT 'loss' AS term, sum(p * (ln(1 + exp(-abs(d))) + greatest(-d, 0.0))) / sum(p) AS value FROM margins",
        "SELECT 'weight', sum(p) FROM margins", "SELECT 'pairs', CAST(count(*) AS DOUBLE) FROM margins",
        *(f"SELECT '{i}', sum(-p * q * (w{i} - l{i})) / (SELECT sum(p) FROM margins) FROM margins" for i in ids)])
    sides = ", ".join(f"w.x{i} AS w{i}, l.x{i} AS l{i}" for i in ids)
    return _EARLY_CTES + f""", vec AS (SELECT rid, pos, {xs} FROM ft), scored AS (SELECT *, {score} AS s FROM vec),
diffs AS (SELECT pair_weight AS p, w.s - l.s AS d, {sides} FROM pairs JOIN scored w ON w.rid = pairs.rid AND w.pos = winner_pos
  JOIN scored l ON l.rid = pairs.rid AND l.pos = loser_pos),
margins AS MATERIALIZED (SELECT *, CASE WHEN d >= 0 THEN exp(-d) / (1 + exp(-d)) ELSE 1 / (1 + exp(d)) END AS q FROM diffs)
SELECT term, round(value, 6) AS value FROM ({terms})"""


def _newton(rows: str, steps: int, penalty0: str, penalty1: str) -> str:
    """CTEs b1 .. b<steps>: Newton steps for a weighted logistic loss over ``rows`` (a, b, p, y) with two coefficients."""
    out = "b0 AS (SELECT CAST(0.0 AS DOUBLE) AS z0, CAST(0.0 AS DOUBLE) AS z1)"
    for k in range(steps):
        out += f""",
b{k + 1} AS MATERIALIZED (
  SELECT z0 - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS z0, z1 - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS z1 FROM (
    SELECT z0, z1, sum(p * (q - y) * a) / sum(p) + {penalty0} * z0 AS g0, sum(p * (q - y) * b) / sum(p) + {penalty1} * z1 AS g1,
      sum(p * q * (1 - q) * a * a) / sum(p) + {penalty0} AS h00, sum(p * q * (1 - q) * a * b) / sum(p) AS h01,
      sum(p * q * (1 - q) * b * b) / sum(p) + {penalty1} AS h11
    FROM (SELECT *, 1 / (1 + exp(-(z0 * a + z1 * b))) AS q FROM {rows}, b{k}) GROUP BY z0, z1))"""
    return out


ORACLE["pairwise_gradient"] = _gradient_sql()
ORACLE["pairwise_fit"] = _EARLY_CTES + f""", vec AS (SELECT rid, pos, {_value_sql(2)} AS x0, {_value_sql(3)} AS x1 FROM ft),
sd AS (SELECT stddev_pop(x0) AS s0, stddev_pop(x1) AS s1 FROM vec),
d AS MATERIALIZED (SELECT (w.x0 - l.x0) / s0 AS a, (w.x1 - l.x1) / s1 AS b, pair_weight AS p, 1 AS y FROM sd, pairs
  JOIN vec w ON w.rid = pairs.rid AND w.pos = winner_pos JOIN vec l ON l.rid = pairs.rid AND l.pos = loser_pos),
{_newton("d", 12, "0.001", "0.001")}
SELECT 2 AS feature_id, round(z0 / s0, 5) AS coefficient FROM b12, sd UNION ALL SELECT 3, round(z1 / s1, 5) FROM b12, sd"""
ORACLE["saved_model_gauc"] = metric_ctes(_LATER, targets={"watch_coverage_30s": DEFAULT_TARGETS["watch_coverage_30s"]},
                                         score=_score_sql()) + _METRIC_SELECT
ORACLE["linear_classifier_fit"] = f"""WITH {IMPRESSIONS_DUCKDB},
early AS (SELECT * FROM impressions WHERE day < DATE '1998-04-25'),
ids AS (SELECT min(feature_id) AS fid FROM (
  SELECT CAST(f[1] AS INTEGER) AS feature_id FROM (SELECT unnest(list_filter(features, lambda f: len(f) >= 2 AND f[1] IS NOT NULL)) AS f FROM early)
  GROUP BY 1 HAVING count(*) >= 10)),
x AS (SELECT CAST(coalesce(CAST(list_filter({_VALID_PAIRS}, lambda f: CAST(f[1] AS INTEGER) = fid)[-1][2] AS FLOAT), 0.0) AS DOUBLE) AS v,
  CASE WHEN {_has('actionPlay')} THEN 1 ELSE 0 END AS y FROM early, ids),
m AS (SELECT avg(v) AS mean, stddev_samp(v) AS sd, 1.0 / (10.0 * count(*)) AS reg FROM x),
d AS MATERIALIZED (SELECT 1.0 AS a, (v - mean) / sd AS b, 1.0 AS p, y FROM x, m),
{_newton("d", 12, "0.0", "(SELECT reg FROM m)")}
SELECT fid AS feature_id, round(z0, 4) AS intercept, round(z1, 4) AS coefficient FROM b12, ids"""


ORACLE["pair_normalized_check"] = TARGET_CTES + """, plain AS (SELECT a.rid, a.name AS target, a.weight * (a.target - b.target) AS w, a.target - b.target AS gap
  FROM long a JOIN long b ON a.rid = b.rid AND a.name = b.name AND a.target > b.target),
weighed AS (SELECT rid, target, w / sum(gap) OVER (PARTITION BY rid, target) AS w FROM plain)
SELECT rid, target, count(*) AS n_pairs, round(sum(w), 6) AS total, round(sum(w * w), 6) AS squares FROM weighed WHERE abs(w) >= 1e-8 GROUP BY ALL"""

# hot sessions: counts by value instead of the pairs themselves
_HOT_CTES = TARGET_CTES.replace("SELECT rid, pos, features,", "SELECT platform AS rid, pos, features,") + """,
vals AS (SELECT rid, name, target AS v, any_value(weight) AS weight, count(*) AS c FROM long GROUP BY rid, name, target)"""
ORACLE["pair_totals_hot"] = _HOT_CTES + """, sums AS (SELECT rid, name, v, c, coalesce(sum(c) OVER w, 0) AS b, coalesce(sum(c * v) OVER w, 0) AS s FROM vals
  WINDOW w AS (PARTITION BY rid, name ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT rid, name AS target, CAST(sum(c * b) AS BIGINT) AS n_pairs, round(sum(c * (v * b - s)) / sum(c * b), 9) AS mean_raw_weight
FROM sums GROUP BY rid, name HAVING sum(c * b) > 0"""
ORACLE["win_labels_hot"] = _HOT_CTES + """, scaled AS (SELECT rid, name, weight * v AS v, sum(c) AS c FROM vals GROUP BY ALL),
beaten AS (SELECT rid, name, v, coalesce(sum(c) OVER (PARTITION BY rid, name ORDER BY v RANGE BETWEEN UNBOUNDED PRECEDING AND 1e-8 PRECEDING), 0) AS k FROM scaled),
mine AS (SELECT rid, pos, row_number() OVER () AS row, like_target, dislike_target, consumption_time_target FROM ft),
won AS (SELECT m.rid, row, sum(k) AS wins FROM (
    SELECT rid, row, 'like' AS name, 5.0 * like_target AS v FROM mine UNION ALL SELECT rid, row, 'dislike', 14.0 * dislike_target FROM mine
    UNION ALL SELECT rid, row, 'consumption_time', CAST(0.41 AS DOUBLE) * consumption_time_target FROM mine) m
  JOIN beaten USING (rid, name, v) GROUP BY ALL)
SELECT rid, CAST(wins AS BIGINT) AS wins, count(*) AS n FROM won GROUP BY ALL"""
ORACLE["dense_wide"] = """WITH p AS (SELECT c_custkey, unnest(range(1, 401)) AS i FROM customer),
last AS (SELECT c_custkey, (c_custkey * i) % 997 AS id, max(i) / 8.0 AS v FROM p GROUP BY ALL),
hit AS (SELECT * FROM last WHERE id % 3 = 0 AND id <= 795)
SELECT c_custkey, CAST(count(id) AS INTEGER) AS found, CAST(coalesce(sum(v), 0) - (266 - count(id)) AS DOUBLE) AS total,
  CAST(coalesce(max(v) FILTER (WHERE id = 495), -1) AS DOUBLE) AS v100 FROM customer LEFT JOIN hit USING (c_custkey) GROUP BY c_custkey"""

ORACLE["ndjson_file_roundtrip"] = ORACLE["ndjson_roundtrip"]
ORACLE["runlog_file"] = ORACLE["gauc_group_details"]
ORACLE["vocab_file"] = ORACLE["vocab_resolve"]
ORACLE["label_stats_empty"] = f"""WITH {IMPRESSIONS_DUCKDB}, none AS (SELECT count(*) AS n FROM impressions WHERE score < -1e300)
SELECT unnest([{", ".join(f"'{t}'" for t in DEFAULT_TARGETS)}]) AS target, n AS total_samples, n AS total_positives, CAST(n AS DOUBLE) AS positive_rate FROM none"""
