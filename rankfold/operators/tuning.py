"""Target-weight search (R6) and best trial.

Everything that does not depend on the three weights is computed once and
kept: the session blocks of the training rows and, where trials read them more than once, the dense validation features.  Trials run together: one pass over the
blocks serves every fit (``pairfit``), and one pass over the validation slice scores each row with every model and measures
session AUC by trial and session.  What a trial adds grows with rows, not pairs.  Finished trials are appended to a
Parquet ``trials`` table, so a restarted search resumes where it stopped.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass
from typing import Callable, Optional, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.config import (CLI_PLATFORMS, DEFAULT_FORMULA_PATH, DEFAULT_TARGETS, GRADED_TARGET_NAMES, MIN_PAIR_WEIGHT,
                             NAV_VIDEO_FOR_YOU, WEIGHT_RANGES, Cols)
from rankfold.functions.vectors import dense_vector
from rankfold.operators import metrics as M
from rankfold.operators.features import feature_table
from rankfold.operators.pairfit import fit_rankers, session_blocks
from rankfold.operators.pairs import pair_table
from rankfold.operators.ranker import LinearModel, save_model, score

TRIAL_SCHEMA = ("trial long, like_weight double, dislike_weight double, consumption_time_weight double, "
                "value double, n_pairs long, seconds double, settings string")


@dataclass
class SearchData:
    training: DataFrame      # session blocks of the training rows (with unit weights)
    validation: DataFrame    # impressions + dense ``features`` array<float>
    target_name: str
    target_configs: dict
    features: Optional[DataFrame] = None   # the feature table that the blocks are made of
    vocab: Sequence[int] = ()


def prepare_search(train: DataFrame, validation: DataFrame, vocab: Sequence[int],
                   target_name: str = "watch_coverage_30s", target_configs: Optional[dict] = None) -> SearchData:
    ft = feature_table(train, vocab, 1.0, 1.0, 1.0)
    training = session_blocks(ft).persist(StorageLevel.MEMORY_AND_DISK)
    val = validation.withColumn("features", dense_vector(Cols.FEATURES, vocab))
    cfgs = target_configs or {target_name: DEFAULT_TARGETS[target_name]}
    return SearchData(training, val, target_name, cfgs, ft, list(vocab))


def trial_weights(n_trials: int, seed: int = 0) -> list[dict]:
    """Seeded uniform draws in the reference's ranges (like, dislike, ct)."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n_trials):
        w = {k: float(rng.uniform(lo, hi)) for k, (lo, hi) in WEIGHT_RANGES.items()}
        w["trial"] = i
        out.append(w)
    return out


def weighted_pairs(data: SearchData, like_weight: float, dislike_weight: float,
                   consumption_time_weight: float) -> DataFrame:
    """The training pairs of a trial, for inspection; the fit itself forms no pair table."""
    w = F.lit(0.0)
    for name, weight in zip(GRADED_TARGET_NAMES, (like_weight, dislike_weight, consumption_time_weight), strict=True):
        w = F.when(F.col("target") == name, F.lit(float(weight))).otherwise(w)
    t = pair_table(data.features, min_abs_weight=0.0).withColumn("pair_weight", F.col("pair_weight") * w)
    return t.where(F.abs("pair_weight") >= F.lit(MIN_PAIR_WEIGHT))


def _session_metric(metric: str):
    """The aggregate over sessions of a metric that one pass by (trial, session) gives; None for those measured trial by trial."""
    return {"GAUCWeighted": lambda: F.sum(F.col("auc") * F.col("size")) / F.sum("size"), "GAUCSimple": lambda: F.avg("auc"),
            "n_groups": lambda: F.count(F.lit(1))}.get(metric)


def evaluate_together(data: SearchData, weights: Sequence[Sequence[float]], metric: str = "GAUCWeighted", max_iter: int = 150,
                      reg_param: float = 1e-3, platforms=CLI_PLATFORMS, nav_screen=NAV_VIDEO_FOR_YOU,
                      formula_path=DEFAULT_FORMULA_PATH, model_paths: Optional[Sequence[Optional[str]]] = None) -> list[tuple[float, int]]:
    """(objective value, number of training pairs) of each (like, dislike, consumption time) weight triple.

    The models are fitted in common passes.  Without a training pair the value is 0.0, without a valid session too.
    """
    fits = fit_rankers(data.training, weights, len(data.vocab), max_iter, reg_param)
    for fit, w, path in zip(fits, weights, model_paths or [None] * len(fits), strict=True):
        if path and fit.n_pairs:
            save_model(LinearModel(list(data.vocab), fit.coefficients, {"weights": [float(x) for x in w], "reg_param": reg_param, "n_pairs": fit.n_pairs}), path)
    sliced = M.eval_slice(data.validation, nav_screen, platforms, formula_path)
    useful = [k for k, fit in enumerate(fits) if fit.n_pairs]
    values = dict.fromkeys(range(len(fits)), 0.0)
    measure = _session_metric(metric)
    if measure and useful:
        labeled, _ = M.with_labels(sliced, {data.target_name: data.target_configs[data.target_name]})
        for k in useful:
            labeled = score(labeled, fits[k].coefficients, score_col=f"_score{k}")
        details = M.session_details_by_score(labeled, [data.target_name], [f"_score{k}" for k in useful])
        for r in details.groupBy("score_no").agg(measure().alias("value")).collect():
            values[useful[r["score_no"]]] = float(r["value"] or 0.0)
    for k in [] if measure else useful:
        metrics, _ = M.gauc(score(sliced, fits[k].coefficients), data.target_configs, score_col=Cols.MODEL_SCORE,
                            calculate_regular_auc=metric.startswith("AUC"), exact_median=False)  # no objective uses the median
        values[k] = float(M.lookup(metrics, data.target_name, metric))
    return [(values[k], fit.n_pairs) for k, fit in enumerate(fits)]


def evaluate_weights(data: SearchData, like_weight: float, dislike_weight: float, consumption_time_weight: float,
                     model_path: Optional[str] = None, **kw) -> tuple[float, int]:
    """One trial by itself, see :func:`evaluate_together`."""
    return evaluate_together(data, [(like_weight, dislike_weight, consumption_time_weight)], model_paths=[model_path], **kw)[0]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store Spark reads it from."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def search(spark: SparkSession, data: SearchData, n_trials: int = 3, timeout: Optional[float] = 120.0,
           seed: int = 0, trials_path: Optional[str] = None, model_dir: Optional[str] = None,
           grid: Optional[Sequence[Sequence[float]]] = None, objective: Optional[Callable] = None, together: int = 8,
           objectives: Optional[Callable] = None, **kw) -> DataFrame:
    """Run trials, up to ``together`` at a time, until ``n_trials`` or ``timeout`` seconds (looked at between them);
    trials already in ``trials_path`` with the same settings (seed, target,
    ranges, options) are skipped, and only those of these settings returned.  With
    ``model_dir`` every trial's model is saved as ``<model_dir>/trial_<n>``.
    ``grid`` gives the (like, dislike, consumption time) weights of each trial instead of draws, and
    ``objective`` is called like :func:`evaluate_weights`, one trial at a time, or ``objectives`` like :func:`evaluate_together`."""
    trials = [dict(zip(WEIGHT_RANGES, map(float, g), strict=True), trial=i) for i, g in enumerate(grid)] if grid else trial_weights(n_trials, seed)
    settings = json.dumps({"seed": seed, "target": data.target_name, "ranges": WEIGHT_RANGES,
                           **({"grid": [list(map(float, g)) for g in grid]} if grid else {}),
                           **({"objective": (objective or objectives).__name__} if objective or objectives else {}),
                           **{k: list(v) if isinstance(v, (list, tuple)) else v for k, v in kw.items()}}, sort_keys=True, default=str)
    done: set[int] = set()
    if trials_path and path_exists(spark, trials_path):
        mine = spark.read.schema(TRIAL_SCHEMA).parquet(trials_path).where(F.col("settings") == settings)
        done = {int(r["trial"]) for r in mine.select("trial").collect()}
    rows = []
    start = time.time()
    todo = [w for w in trials if w["trial"] not in done]
    # read once, the validation rows need not be kept
    keep = len(todo) > (1 if objective or timeout is not None else together) and not data.validation.is_cached
    if keep:
        data.validation.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        while todo:
            spent = time.time() - start
            if timeout is not None and rows and spent > timeout:
                break
            # a budget lets the first trial run alone; its time bounds how many may follow together
            fits = 1 if objective or (timeout is not None and not rows) else together
            if timeout is not None and rows and not objective:
                fits = max(1, min(together, int((timeout - spent) / max(rows[0][6], 1e-3))))
            batch, todo = todo[:fits], todo[fits:]
            t0 = time.time()
            paths = [f"{model_dir.rstrip('/')}/trial_{w['trial']}" if model_dir else None for w in batch]
            triples = [tuple(w[k] for k in WEIGHT_RANGES) for w in batch]
            found = [objective(data, *triples[0], model_path=paths[0], **kw)] if objective else (objectives or evaluate_together)(data, triples, model_paths=paths, **kw)
            seconds = (time.time() - t0) / len(batch)
            new = [(w["trial"], *triple, value, n_pairs, seconds, settings) for w, triple, (value, n_pairs) in zip(batch, triples, found, strict=True)]
            rows += new
            if trials_path:
                spark.createDataFrame(new, TRIAL_SCHEMA).coalesce(1).write.mode("append").parquet(trials_path)
    finally:
        if keep:
            data.validation.unpersist()
    if trials_path:
        return spark.read.schema(TRIAL_SCHEMA).parquet(trials_path).where(F.col("settings") == settings)
    return spark.createDataFrame(rows, TRIAL_SCHEMA)


def best_trial(trials: DataFrame) -> DataFrame:
    """Highest value; ties go to the earliest trial."""
    return trials.orderBy(F.desc("value"), F.asc("trial")).limit(1)
