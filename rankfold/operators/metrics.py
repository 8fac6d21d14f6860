"""AUC / GAUC metrics (M1-M13) as aggregations and windows.

Exact AUC with ties counted as 1/2 is the Mann-Whitney statistic

    U = sum over distinct scores s of  pos(s) * (neg_below(s) + neg(s) / 2)
    AUC = U / (P * N)

``neg_below`` is a running sum in score order.  The rows are read once, into a kept table of counts: for each (session, score)
the rows and, for every target as a column, the positives.  Session details, global AUC, label counts, quantiles and the
cuts of large sessions all come from it.  To order without a single
un-partitioned window (global AUC) and without one task per hot session
(GAUC), scores are cut into buckets at split points taken from the score
distribution; those of the global AUC are literals of the plan, those of large sessions a written table, so a recompute after executor
loss assigns identical buckets.  The running sum then has two levels:

    neg_below(s) = negatives in lower buckets of the group      (window over
                                                                  <= B rows/group)
                 + negatives below s inside its own bucket       (window over one
                                                                  bucket of one group)

Split points only change balance, never the result.
"""

from __future__ import annotations

import math
from typing import Iterable, Iterator, Optional, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.config import Cols, resolve_targets
from rankfold.functions.labels import clean_score, label_expr
from rankfold.operators.sessions import whole_sessions
from rankfold.session import dealt, written

LABEL_PREFIX = "label_"
_B = "_bucket"


# ---------------------------------------------------------------- labels (L4, M9)
def with_labels(df: DataFrame, target_configs, events: str = Cols.EVENTS,
                view_time: str = Cols.VIEW_TIME) -> tuple[DataFrame, list[str]]:
    """L4: add ``label_<name>`` for every target in one projection."""
    targets = resolve_targets(target_configs)
    cols = [label_expr(cfg, df, events, view_time).alias(LABEL_PREFIX + name) for name, cfg in targets]
    return df.select("*", *cols), [name for name, _ in targets]


def eval_slice(df: DataFrame, nav_screen: Optional[str] = None, platforms: Optional[Iterable[str]] = None,
               formula_path: Optional[str] = None, nav_screen_col: str = Cols.NAV_SCREEN,
               platform_col: str = Cols.PLATFORM, formula_path_col: str = Cols.FORMULA_PATH) -> DataFrame:
    """nav screen equality AND platform in set AND formula path equality.
    Arguments left as ``None`` are not filtered.  Pushed to the Parquet scan."""
    cond = F.lit(True)
    if nav_screen is not None:
        cond = cond & (F.col(nav_screen_col) == F.lit(str(nav_screen)))
    if platforms is not None:
        cond = cond & F.col(platform_col).isin(*[str(p) for p in platforms])
    if formula_path is not None:
        cond = cond & (F.col(formula_path_col) == F.lit(str(formula_path)))
    return df.where(cond)


# ---------------------------------------------------------------- M1 / L6
def label_stats(labeled: DataFrame, target_names: Sequence[str]) -> DataFrame:
    """M1: total, positives, positive rate per target, one aggregate for all."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for t in target_names:
        aggs.append(F.sum(F.col(LABEL_PREFIX + t)).alias("p_" + t))
    wide = labeled.agg(*aggs)
    rows = [F.struct(F.lit(t).alias("target"), F.coalesce(F.col("p_" + t), F.lit(0)).cast("long").alias("pos"))
            for t in target_names]
    out = wide.select(F.col("_n").alias("total_samples"), F.inline(F.array(*rows)))
    return out.select(
        "target", "total_samples", F.col("pos").alias("total_positives"),
        F.when(F.col("total_samples") > 0, F.col("pos") / F.col("total_samples")).otherwise(F.lit(0.0))
         .alias("positive_rate"))


# ---------------------------------------------------------------- bucketing
def add_bucket(df: DataFrame, score_col: str, splits: Sequence[float]) -> DataFrame:
    """Deterministic bucket index by binary search (``Bucketizer``) over literals."""
    if not splits:
        return df.withColumn(_B, F.lit(0))
    b = Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol=score_col, outputCol=_B + "_d")
    # integer bucket: float grouping keys get NaN-normalised, which would hide
    # the (session, bucket) partitioning from the aggregate and the window.
    return b.transform(df).withColumn(_B, F.col(_B + "_d").cast("int")).drop(_B + "_d")


def auto_buckets(n_rows: int, rows_per_bucket: int = 2_000_000, lo: int = 16) -> int:
    return int(max(lo, math.ceil(n_rows / rows_per_bucket)))


# ---------------------------------------------------------------- M3 / M4
#: Rows of one session above which it is cut into score buckets of its own, and the steps of its quantiles.
SESSION_ROWS = 2_000_000
SESSION_STEPS = 1000


def session_cuts(narrow: DataFrame, session_rows: int) -> DataFrame:
    """(session_id, _cuts): score quantiles of the sessions with more than ``session_rows`` rows, from their own scores."""
    large = narrow.groupBy("session_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > F.lit(int(session_rows)))
    parts = F.ceil(F.col("_n") / F.lit(float(session_rows)))
    probs = [i / SESSION_STEPS for i in range(1, SESSION_STEPS)]
    # at most rows / session_rows keys, whatever the sessions
    rows = narrow.join(F.broadcast(large.select("session_id", parts.cast("int").alias("_parts"))), "session_id")
    q = rows.groupBy("session_id").agg(F.percentile_approx("score", probs, 4 * SESSION_STEPS).alias("_q"), F.first("_parts").alias("_parts"))
    # one cut per part, spread over the steps
    step = F.greatest(F.lit(1), F.floor(F.lit(SESSION_STEPS) / F.col("_parts"))).cast("int")
    cuts = F.array_distinct(F.filter("_q", lambda x, i: (i + 1) % step == 0))
    return q.select("session_id", cuts.alias("_cuts"))


def part_of(value, cuts: str = "_cuts"):
    """Number of the ascending ``cuts`` below ``value``, 0 without cuts: a search by halves, so its steps are the logarithm of their number."""
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(SESSION_STEPS.bit_length()))])
    c = F.col(value) if isinstance(value, str) else value
    return F.aggregate(halves, F.lit(0), lambda at, half: F.when(F.get(F.col(cuts), at + half - 1) < c, at + half).otherwise(at))


def score_counts(labeled: DataFrame, target_names: Sequence[str], session_col: str = Cols.RID, score_col: str = Cols.SCORE) -> DataFrame:
    """The kept table: ``session_id, score, _c`` and positives ``_p<i>`` of each target, combined before the one shuffle."""
    narrow = labeled.select(F.col(session_col).alias("session_id"), clean_score(score_col).alias("score"),
                            *[F.col(LABEL_PREFIX + t).cast("long").alias(f"_y{i}") for i, t in enumerate(target_names)])
    return written(narrow.groupBy("session_id", "score").agg(
        F.count(F.lit(1)).alias("_c"), *[F.sum(f"_y{i}").alias(f"_p{i}") for i in range(len(target_names))]))


def _sums_by_session(per_score: DataFrame, k: int, session_rows: int) -> DataFrame:
    """Per-session sums U_i, P_i, N_i of the k targets from :func:`score_counts`, in one plan for sessions of any size.

    A session has one score bucket per ``session_rows`` distinct scores, cut at its own quantiles;
    the ordered work runs per (session, bucket), a last window over the
    buckets of a session.  Which sessions are large is a table that is joined.
    """
    neg = [F.col("_c") - F.col(f"_p{i}") for i in range(k)]
    per_score = per_score.where(F.col("session_id").isNotNull())
    # one cut per session_rows rows in all, so its size is bounded by rows / session_rows
    cuts = written(session_cuts(per_score.select("session_id", "score"), session_rows))
    per_score = per_score.join(F.broadcast(cuts), "session_id", "left")
    per_score = per_score.withColumn(_B, F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(part_of("score"))).drop("_cuts")
    w_in = Window.partitionBy("session_id", _B).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    per_score = per_score.select("*", *[F.coalesce(F.sum(n).over(w_in), F.lit(0)).alias(f"_nb{i}")
                                        for i, n in enumerate(neg)])
    per_bucket = per_score.groupBy("session_id", _B).agg(*[
        a for i, n in enumerate(neg) for a in (
            F.sum(F.col(f"_p{i}").cast("double") * (F.col(f"_nb{i}") + n / 2.0)).alias(f"_u{i}"),
            F.sum(f"_p{i}").alias(f"_P{i}"), F.sum(n).alias(f"_N{i}"))])
    w_b = Window.partitionBy("session_id").orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.select("*", *[F.coalesce(F.sum(f"_N{i}").over(w_b), F.lit(0)).alias(f"_nl{i}")
                                          for i in range(k)])
    return per_bucket.groupBy("session_id").agg(*[
        a for i in range(k) for a in (
            F.sum(F.col(f"_u{i}") + F.col(f"_P{i}").cast("double") * F.col(f"_nl{i}")).alias(f"U{i}"),
            F.sum(f"_P{i}").alias(f"P{i}"), F.sum(f"_N{i}").alias(f"N{i}"))])


def session_details(labeled: DataFrame, target_names: Sequence[str], session_col: str = Cols.RID,
                    score_col: str = Cols.SCORE, session_rows: int = SESSION_ROWS, counts: Optional[DataFrame] = None) -> DataFrame:
    """M3 + M4: one row per valid (target, session): session_id, auc, size,
    positives, negatives, positive_rate.  Sessions need >= 1 positive and
    >= 1 negative; NULL sessions are not groups.  Targets stay columns until
    the end (see :func:`_sums_by_session` for the plan).  ``counts`` is the :func:`score_counts` of the same arguments, if there."""
    names = list(target_names)
    counts = score_counts(labeled, names, session_col, score_col) if counts is None else counts
    return _details_from_sums(_sums_by_session(counts, len(names), session_rows), names)


def sums_by_scores(rows: DataFrame, scores: int, k: int, session_rows: int = SESSION_ROWS) -> DataFrame:
    """Per session and score column: ``score_no, session_id`` and the sums U_i, P_i, N_i of the k targets.

    ``rows`` is a kept table of ``session_id``, scores ``_s<j>`` and labels ``_y<i>``.  Sessions of up to ``session_rows`` rows are dealt
    over the tasks once for all scores and ranked there session by session; larger ones take the plan of :func:`_sums_by_session` for each score.
    """
    rows = rows.where(F.col("session_id").isNotNull())
    # at most rows / session_rows keys, whatever the sessions
    large = written(rows.groupBy("session_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > F.lit(int(session_rows))).select("session_id"))
    hot = large.count() > 0
    small = rows.join(F.broadcast(large), "session_id", "left_anti") if hot else rows
    key = rows.schema["session_id"].dataType.simpleString()
    sums = [f"{name}{i} {kind}" for i in range(k) for name, kind in (("U", "double"), ("P", "long"), ("N", "long"))]
    names = ["score_no", "session_id", *[f.split()[0] for f in sums]]
    small = dealt(small, rows.count(), "session_id").sortWithinPartitions("session_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts in whole_sessions(batches):
            ids = batch.column(0).take(pa.array(starts))
            labels = np.stack([batch.column(1 + scores + i).to_numpy() for i in range(k)], 1)
            for j in range(scores):
                u, p, n = rank_sums(batch.column(1 + j).to_numpy(), labels, starts)
                found = [pa.array(v[:, i]) for i in range(k) for v in (u, p, n)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(starts), j, np.int32)), ids, *found], names)

    columns = [*[f"_s{j}" for j in range(scores)], *[f"_y{i}" for i in range(k)]]
    out = small.select("session_id", *columns).mapInArrow(run, f"score_no int, session_id {key}, " + ", ".join(sums))
    for j in range(scores if hot else 0):
        counts = rows.join(F.broadcast(large), "session_id").groupBy("session_id", F.col(f"_s{j}").alias("score")).agg(
            F.count(F.lit(1)).alias("_c"), *[F.sum(f"_y{i}").alias(f"_p{i}") for i in range(k)])
        out = out.unionByName(_sums_by_session(counts, k, session_rows).select(F.lit(j).alias("score_no"), *names[1:]))
    return out


def rank_sums(score: np.ndarray, labels: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """U, P and N of each session (row) and label (column); the rows of session s begin at ``starts[s]``."""
    n = len(score)
    order = np.lexsort((score, np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))))
    s = score[order]
    new = np.concatenate(([True], s[1:] != s[:-1]))
    new[starts] = True
    first = np.flatnonzero(new)  # rows of equal score in a session together
    p = np.add.reduceat(labels[order], first)
    neg = np.diff(np.append(first, n))[:, None] - p
    begin = np.searchsorted(first, starts)
    below = np.cumsum(neg, 0) - neg
    below -= np.repeat(below[begin], np.diff(np.append(begin, len(first))), 0)
    return tuple(np.add.reduceat(v, begin) for v in (p * (below + neg / 2.0), p, neg))


def scored_rows(labeled: DataFrame, target_names: Sequence[str], score_cols: Sequence[str], session_col: str = Cols.RID) -> DataFrame:
    """The kept table of :func:`sums_by_scores`, the only read of the source whatever the number of scores."""
    return written(labeled.select(
        # -0.0 becomes 0.0, as in the grouped counts
        F.col(session_col).alias("session_id"), *[(clean_score(c) + F.lit(0.0)).alias(f"_s{j}") for j, c in enumerate(score_cols)],
        *[F.col(LABEL_PREFIX + t).cast("long").alias(f"_y{i}") for i, t in enumerate(target_names)]))


def session_details_by_score(labeled: DataFrame, target_names: Sequence[str], score_cols: Sequence[str], session_col: str = Cols.RID,
                             session_rows: int = SESSION_ROWS, rows: Optional[DataFrame] = None) -> DataFrame:
    """:func:`session_details` for several scores of the same rows: ``score_no`` (from 0) before its columns.  ``rows`` is the
    :func:`scored_rows` of the same arguments, if there."""
    names = list(target_names)
    rows = scored_rows(labeled, names, score_cols, session_col) if rows is None else rows
    return _details_from_sums(sums_by_scores(rows, len(score_cols), len(names), session_rows), names, "score_no")


def _details_from_sums(per_session: DataFrame, names: Sequence[str], *carry: str) -> DataFrame:
    """(session, U_i, P_i, N_i per target) -> one detail row per valid (target, session), ``carry`` in front."""
    rows = [F.struct(F.lit(t).alias("target"), F.col(f"U{i}").alias("U"), F.col(f"P{i}").alias("P"),
                     F.col(f"N{i}").alias("N")) for i, t in enumerate(names)]
    u = per_session.select(*carry, "session_id", F.inline(F.array(*rows)))
    valid = u.where((F.col("P") > 0) & (F.col("N") > 0))
    size = F.col("P") + F.col("N")
    return valid.select(
        *carry, "target", "session_id",
        (F.col("U") / (F.col("P").cast("double") * F.col("N").cast("double"))).alias("auc"),
        size.alias("size"), F.col("P").alias("positives"), F.col("N").alias("negatives"),
        (F.col("P") / size).alias("positive_rate"))


# ---------------------------------------------------------------- M5-M8
MEDIAN_ACCURACY = 100_000
#: Parts of a bracket of the exact median; with the number of targets it bounds what a pass returns.
MEDIAN_PARTS = 1024


def _base_summary_aggs():
    return [F.avg("auc").alias("GAUCSimple"),
            (F.sum(F.col("auc") * F.col("size")) / F.sum("size")).alias("GAUCWeighted"),
            F.count(F.lit(1)).alias("n_groups"), F.stddev_pop("auc").alias("std"),
            F.min("auc").alias("min"), F.max("auc").alias("max")]


DETAILS_SCHEMA = ("target string, session_id string, auc double, size long, positives long, negatives long, "
                  "positive_rate double")
METRICS_SCHEMA = ("target string, total_samples long, total_positives long, positive_rate double, AUC double, "
                  "AUC_valid boolean, AUC_error string, GAUCSimple double, GAUCWeighted double, n_groups long, "
                  "std double, min double, max double, median double, GAUC_valid boolean")
SUMMARY_SCHEMA = ("target string, GAUCSimple double, GAUCWeighted double, n_groups long, std double, "
                  "min double, max double, median double")


def gauc_summary(details: DataFrame, exact_median: bool = True, accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    """M5-M7 per target: simple and weighted GAUC, count, population std, min,
    max and median (numpy's: the mean of the two middle values).

    The exact median never gathers all AUC values in one task or on the driver.  Pass 1 computes
    the other statistics and ``percentile_approx`` brackets around the middle
    rank; further passes narrow each bracket to the middle values and return at
    most MEDIAN_PARTS + 2 rows per target, whatever the number of sessions.
    ``exact_median=False`` returns the approximate median of pass 1.
    """
    return _summary_table(details.sparkSession, _summaries(details, exact_median, accuracy))


def _summary_table(spark, rows: Sequence[dict]) -> DataFrame:
    cols = [c.split()[0] for c in SUMMARY_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], SUMMARY_SCHEMA)


def _summaries(details: DataFrame, exact_median: bool, accuracy: int = MEDIAN_ACCURACY) -> list[dict]:
    """The rows of :func:`gauc_summary`, one per target."""
    d = details.select("target", "auc", "size").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        eps = 2.0 / accuracy
        first = d.groupBy("target").agg(
            *_base_summary_aggs(),
            F.percentile_approx("auc", [max(0.0, 0.5 - eps), 0.5, min(1.0, 0.5 + eps)], accuracy).alias("_q"),
        ).collect()
        rows = [r.asDict() for r in first]
        for row in rows:
            row["_q"] = [float(x) for x in row["_q"]]
            row["median"] = row["_q"][1]
        if exact_median and rows:
            _exact_medians(d, rows)
        return rows
    finally:
        d.unpersist()


def _exact_medians(d: DataFrame, rows: list[dict]) -> None:
    """Fill ``median`` exactly for every target row, one job for all targets per pass.

    A pass cuts each target's bracket into MEDIAN_PARTS equal parts (and one on either side) and returns
    the count, least and greatest value of each.  Middle ranks in two parts are the ends of those parts; in
    one part, its least and greatest value are the next bracket, until they are equal.
    """
    todo = {r["target"]: r for r in rows}
    brackets = {t: (r["_q"][0], r["_q"][2]) for t, r in todo.items()}
    while todo:
        low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
        for t, (a, b) in brackets.items():
            low = F.when(F.col("target") == F.lit(t), F.lit(a)).otherwise(low)
            high = F.when(F.col("target") == F.lit(t), F.lit(b)).otherwise(high)
        marked = d.where(F.col("target").isin(*brackets)).select("target", "auc", low.alias("_lo"), high.alias("_hi"))
        place = F.floor((F.col("auc") - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0)) * MEDIAN_PARTS)
        part = (F.when(F.col("auc") < F.col("_lo"), F.lit(-1)).when(F.col("auc") > F.col("_hi"), F.lit(MEDIAN_PARTS))
                 .otherwise(F.least(F.lit(MEDIAN_PARTS - 1), F.coalesce(place, F.lit(0)))).cast("int"))
        found = marked.groupBy("target", part.alias("_part")).agg(
            F.count(F.lit(1)).alias("c"), F.min("auc").alias("a"), F.max("auc").alias("b")).collect()
        parts: dict[str, list] = {}
        for r in sorted(found, key=lambda r: r["_part"]):
            parts.setdefault(r["target"], []).append((int(r["c"]), float(r["a"]), float(r["b"])))
        brackets = {}
        for t, row in list(todo.items()):
            n, before, middle = int(row["n_groups"]), 0, []
            for c, a, b in parts[t]:
                middle += [(a, b)] * sum(before <= k < before + c for k in ((n - 1) // 2, n // 2))
                before += c
            (a, b), (a2, b2) = middle
            if n % 2 == 0 and (a, b) != (a2, b2):  # ranks next to each other in two parts
                a, b = b, a2
            elif a != b:
                brackets[t] = (a, b)
                continue
            row["median"] = (a + b) / 2.0
            del todo[t]


# ---------------------------------------------------------------- M2
def global_auc(labeled: DataFrame, target_names: Sequence[str], score_col: str = Cols.SCORE,
               splits: Optional[Sequence[float]] = None) -> DataFrame:
    """M2: exact AUC over all rows per target (NULL sessions included).

    Without ``splits`` a first pass takes the score quantiles, one bucket per
    two million rows.

    Per-(bucket, score) counts for every target at once are combined map-side
    before the shuffle; the ordered windows run per bucket, then once over the
    <= B bucket rows.  Fewer than two classes -> AUC 0.0, ``AUC_valid`` false,
    error text.
    """
    names = list(target_names)
    counts = labeled.select(clean_score(score_col).alias("score"), F.lit(1).alias("_c"),
                            *[F.col(LABEL_PREFIX + t).cast("long").alias(f"_p{i}") for i, t in enumerate(names)])
    if splits is None:
        n, qs = _quantiles(counts, F.col("score"))
        splits = _pick(qs, auto_buckets(n))
    return auc_from_counts(counts, names, splits)


def auc_from_counts(counts: DataFrame, names: Sequence[str], splits: Sequence[float]) -> DataFrame:
    """:func:`global_auc` from rows of ``score, _c`` and positives ``_p<i>`` of each target."""
    k = len(names)
    per_score = add_bucket(counts, "score", splits).groupBy(_B, "score").agg(
        F.sum("_c").alias("_c"), *[F.sum(f"_p{i}").alias(f"_p{i}") for i in range(k)])
    neg = [F.col("_c") - F.col(f"_p{i}") for i in range(k)]
    w_in = Window.partitionBy(_B).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    per_score = per_score.select("*", *[F.coalesce(F.sum(n).over(w_in), F.lit(0)).alias(f"_nb{i}")
                                        for i, n in enumerate(neg)])
    per_bucket = per_score.groupBy(_B).agg(*[
        a for i, n in enumerate(neg) for a in (
            F.sum(F.col(f"_p{i}").cast("double") * (F.col(f"_nb{i}") + n / 2.0)).alias(f"_u{i}"),
            F.sum(f"_p{i}").alias(f"_P{i}"), F.sum(n).alias(f"_N{i}"))])
    # <= B rows (B <= the split resolution): a single ordered window is cheap
    w_b = Window.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.select("*", *[F.coalesce(F.sum(f"_N{i}").over(w_b), F.lit(0)).alias(f"_nl{i}")
                                          for i in range(k)])
    tot = per_bucket.agg(*[
        a for i in range(k) for a in (
            F.sum(F.col(f"_u{i}") + F.col(f"_P{i}").cast("double") * F.col(f"_nl{i}")).alias(f"U{i}"),
            F.sum(f"_P{i}").alias(f"P{i}"), F.sum(f"_N{i}").alias(f"N{i}"))])
    rows = [F.struct(F.lit(t).alias("target"), F.coalesce(F.col(f"U{i}"), F.lit(0.0)).alias("U"),
                     F.coalesce(F.col(f"P{i}"), F.lit(0)).alias("P"), F.coalesce(F.col(f"N{i}"), F.lit(0)).alias("N"))
            for i, t in enumerate(names)]
    u = tot.select(F.inline(F.array(*rows)))
    ok = (F.col("P") > 0) & (F.col("N") > 0)
    classes = F.concat(F.lit("Insufficient classes: ["),
                       F.concat_ws(", ", F.filter(F.array(F.when(F.col("N") > 0, F.lit("0")),
                                                          F.when(F.col("P") > 0, F.lit("1"))),
                                                  lambda x: x.isNotNull())), F.lit("]"))
    return u.select(
        "target",
        F.when(ok, F.col("U") / (F.col("P").cast("double") * F.col("N").cast("double"))).otherwise(F.lit(0.0)).alias("AUC"),
        ok.alias("AUC_valid"),
        F.when(ok, F.lit(None).cast("string")).otherwise(classes).alias("AUC_error"))


# ---------------------------------------------------------------- M13
#: Steps of the score quantiles, that is the most buckets of the global AUC; rows of equal score are one row there.
SPLIT_RESOLUTION = 4096


def _quantile_agg(score):
    probs = [i / SPLIT_RESOLUTION for i in range(1, SPLIT_RESOLUTION)]
    return F.percentile_approx(score, probs, 4 * SPLIT_RESOLUTION).alias("_q")


def _quantiles(df: DataFrame, score):
    row = df.agg(F.count(F.lit(1)).alias("_n"), _quantile_agg(score)).first()
    return int(row["_n"] or 0), [float(q) for q in (row["_q"] or [])]


def _pick(qs: Sequence[float], n_buckets: int) -> list[float]:
    """Split points for ``n_buckets`` buckets from quantiles at 1/R steps."""
    if n_buckets <= 1 or not qs:
        return []
    r = len(qs) + 1
    idx = sorted({min(len(qs) - 1, max(0, (k * r) // n_buckets - 1)) for k in range(1, n_buckets)})
    return sorted({qs[i] for i in idx if math.isfinite(qs[i])})


def gauc(df: DataFrame, target_configs, session_col: str = Cols.RID, score_col: str | Sequence[str] = Cols.SCORE,
         platforms: Optional[Iterable[str]] = None, nav_screen: Optional[str] = None,
         formula_path: Optional[str] = None, nav_screen_col: str = Cols.NAV_SCREEN,
         platform_col: str = Cols.PLATFORM, formula_path_col: str = Cols.FORMULA_PATH,
         calculate_regular_auc: bool = True, score_buckets: Optional[int] = None,
         exact_median: bool = True, session_rows: int = SESSION_ROWS,
         details_only: bool = False) -> tuple[Optional[DataFrame], DataFrame] | list[tuple[Optional[DataFrame], DataFrame]]:
    """Public entry: ``(metrics, group_details)``, for a list of score columns a list of them, from one read of the source.

    ``metrics`` has one row per target: target, total_samples, total_positives,
    positive_rate, [AUC, AUC_valid, AUC_error], GAUCSimple, GAUCWeighted,
    n_groups, std, min, max, median, GAUC_valid.  Targets without valid
    sessions get zeros and ``GAUC_valid = false``.
    """
    sliced = eval_slice(df, nav_screen, platforms, formula_path, nav_screen_col, platform_col, formula_path_col)
    labeled, names = with_labels(sliced, target_configs)
    spark = df.sparkSession
    if not names:
        nothing = spark.createDataFrame([], METRICS_SCHEMA), spark.createDataFrame([], DETAILS_SCHEMA)
        return nothing if isinstance(score_col, str) else [nothing for _ in score_col]
    if not isinstance(score_col, str):
        return _gauc_by_score(labeled, names, session_col, list(score_col), calculate_regular_auc, score_buckets, exact_median, session_rows, details_only)
    counts = score_counts(labeled, names, session_col, score_col)  # the only read of the source
    details = session_details(labeled, names, session_col, score_col, session_rows, counts)
    if details_only:
        return None, details
    # row count, positives per target and, for the global AUC, score quantiles at a fixed resolution; the
    # per-target counts become a tiny literal table, so the final job does not recount
    quantiles = [_quantile_agg(F.col("score"))] if calculate_regular_auc else []
    row = counts.agg(F.sum("_c").alias("_n"), *[F.sum(f"_p{i}").alias(f"_p{i}") for i in range(len(names))], *quantiles).first()
    n_rows = int(row["_n"] or 0)
    aucs = None
    if calculate_regular_auc:
        aucs = auc_from_counts(counts, names, _pick([float(q) for q in (row["_q"] or [])], score_buckets or auto_buckets(n_rows)))
    return _metrics(spark, names, n_rows, [int(row[f"_p{i}"] or 0) for i in range(len(names))], aucs, gauc_summary(details, exact_median)), details


def _gauc_by_score(labeled: DataFrame, names: list[str], session_col: str, score_cols: list[str], calculate_regular_auc: bool,
                   score_buckets: Optional[int], exact_median: bool, session_rows: int, details_only: bool) -> list[tuple[Optional[DataFrame], DataFrame]]:
    """:func:`gauc` of each score column; rows are read, dealt by session and summarised once for all of them."""
    spark, k = labeled.sparkSession, len(names)
    rows = scored_rows(labeled, names, score_cols, session_col)
    details = session_details_by_score(labeled, names, score_cols, session_col, session_rows, rows)
    each = [details.where(F.col("score_no") == j).drop("score_no") for j in range(len(score_cols))]
    if details_only:
        return [(None, d) for d in each]
    row = rows.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(f"_y{i}").alias(f"_p{i}") for i in range(k)]).first()
    positives = [int(row[f"_p{i}"] or 0) for i in range(k)]
    # a target of a score counts as a target of its own here
    found = _summaries(details.withColumn("target", F.concat_ws(":", "score_no", "target")), exact_median)
    out = []
    for j, detail in enumerate(each):
        mine = [{**r, "target": t} for r in found for t in names if r["target"] == f"{j}:{t}"]
        aucs = None
        if calculate_regular_auc:
            counts = rows.select(F.col(f"_s{j}").alias("score"), F.lit(1).alias("_c"), *[F.col(f"_y{i}").alias(f"_p{i}") for i in range(k)])
            n, qs = _quantiles(counts, F.col("score"))
            aucs = auc_from_counts(counts, names, _pick(qs, score_buckets or auto_buckets(n)))
        out.append((_metrics(spark, names, int(row["_n"]), positives, aucs, _summary_table(spark, mine)), detail))
    return out


def _metrics(spark, names: Sequence[str], n_rows: int, positives: Sequence[int], aucs: Optional[DataFrame], summ: DataFrame) -> DataFrame:
    """The metric row of each target; without ``aucs`` the global AUC was not asked for."""
    stats = spark.createDataFrame(
        [(t, n_rows, int(positives[i]), (positives[i] / n_rows) if n_rows else 0.0) for i, t in enumerate(names)],
        "target string, total_samples long, total_positives long, positive_rate double")
    out = stats
    if aucs is not None:
        out = out.join(aucs, "target", "left").select(
            *stats.columns,
            F.coalesce("AUC", F.lit(0.0)).alias("AUC"),
            F.coalesce("AUC_valid", F.lit(False)).alias("AUC_valid"),
            F.when(F.col("AUC_valid").isNull(), F.lit("Insufficient classes: []")).otherwise(F.col("AUC_error")).alias("AUC_error"))
    else:  # not asked for: zeros, marked invalid
        out = out.select("*", F.lit(0.0).alias("AUC"), F.lit(False).alias("AUC_valid"), F.lit(None).cast("string").alias("AUC_error"))
    zero = F.lit(0.0)
    return out.join(summ, "target", "left").select(
        *out.columns,
        F.coalesce("GAUCSimple", zero).alias("GAUCSimple"),
        F.coalesce("GAUCWeighted", zero).alias("GAUCWeighted"),
        F.coalesce("n_groups", F.lit(0)).cast("long").alias("n_groups"),
        F.coalesce("std", zero).alias("std"), F.coalesce("min", zero).alias("min"),
        F.coalesce("max", zero).alias("max"), F.coalesce("median", zero).alias("median"),
        (F.coalesce("n_groups", F.lit(0)) > 0).alias("GAUC_valid"))


# ---------------------------------------------------------------- M10
def compare_auc_gauc(metrics: DataFrame) -> DataFrame:
    """AUC minus GAUC, relative difference (floor 1e-10), similarity band."""
    d_w = F.col("AUC") - F.col("GAUCWeighted")
    band = F.when(F.abs(d_w) < 0.01, F.lit("high")).when(F.abs(d_w) < 0.05, F.lit("medium")).otherwise(F.lit("low"))
    return metrics.select(
        "target", "AUC", "GAUCWeighted", "GAUCSimple",
        d_w.alias("difference_auc_gauc_weighted"),
        (F.col("AUC") - F.col("GAUCSimple")).alias("difference_auc_gauc_simple"),
        (d_w / F.greatest(F.col("AUC"), F.lit(1e-10))).alias("relative_diff_auc_gauc_weighted"),
        "n_groups", "total_samples", "AUC_valid", "GAUC_valid", band.alias("similarity"))


# ---------------------------------------------------------------- M11 / M12
TARGET_DETAIL_FIELDS = ("AUC", "AUC_valid", "GAUCWeighted", "GAUCSimple", "GAUC_valid",
                        "n_groups", "total_samples", "positive_rate")


def summary(metrics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One summary row plus the per-target details table.  Averages run
    over valid targets only and are 0.0 when there are none."""
    auc_ok = F.col("AUC_valid")
    g_ok = F.col("GAUC_valid")
    one = metrics.agg(
        F.count(F.lit(1)).alias("total_targets"),
        F.count_if(auc_ok).alias("targets_with_valid_auc"),
        F.count_if(g_ok).alias("targets_with_valid_gauc"),
        F.coalesce(F.avg(F.when(auc_ok, F.col("AUC"))), F.lit(0.0)).alias("average_auc"),
        F.coalesce(F.avg(F.when(g_ok, F.col("GAUCWeighted"))), F.lit(0.0)).alias("average_gauc_weighted"),
        F.coalesce(F.avg(F.when(g_ok, F.col("GAUCSimple"))), F.lit(0.0)).alias("average_gauc_simple"))
    details = metrics.select("target", *TARGET_DETAIL_FIELDS)
    return one, details


def lookup(target_details: DataFrame, target: str, metric: str):
    """``summary[target_details][target][metric]`` - one small result row."""
    if metric not in TARGET_DETAIL_FIELDS:
        raise KeyError(f"metric {metric!r} is not in the target details: {TARGET_DETAIL_FIELDS}")
    row = target_details.where(F.col("target") == target).select(metric).first()
    if row is None:
        raise KeyError(f"target {target!r} not found")
    return row[0]
