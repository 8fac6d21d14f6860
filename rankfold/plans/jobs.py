"""End-to-end jobs (the reference's entry points, as Spark plans).

* :func:`tune_weights`   - Entry A: weight search over a train / validation pair.
* :func:`score_and_measure` - Entry B: score with a saved pairwise model, GAUC.
* :func:`linear_model_auc`  - Entry D: matrices for a linear classifier + AUC.
* :func:`write_training_extract` - Entry E: the training-slice extract.

Each reads DataFrames (or paths) and writes results as Parquet; nothing
passes through the driver except vocabularies, split points, trial weights
and single metric values.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.config import CLI_PLATFORMS, DEFAULT_FORMULA_PATH, DEFAULT_TARGETS, EV_ACTION_PLAY, NAV_VIDEO_FOR_YOU, Cols
from rankfold.functions.vectors import dense_vector
from rankfold.operators import matrices as MX
from rankfold.operators import metrics as M
from rankfold.operators import ranker as RK
from rankfold.operators import tuning as TU
from rankfold.plans.evaluate import evaluate
from rankfold.session import written
from rankfold.sources.extracts import training_extract


def tune_weights(spark: SparkSession, train: DataFrame, validation: DataFrame, vocab: Sequence[int],
                 trials_path: Optional[str] = None, n_trials: int = 3, timeout: Optional[float] = 120.0,
                 seed: int = 0, target_name: str = "watch_coverage_30s", **kw) -> tuple[DataFrame, DataFrame]:
    """Entry A: (trials, best trial)."""
    data = TU.prepare_search(train, validation, vocab, target_name)
    try:
        trials = TU.search(spark, data, n_trials=n_trials, timeout=timeout, seed=seed, trials_path=trials_path, **kw)
        best = TU.best_trial(trials)
        return trials, best
    finally:
        data.training.unpersist()


def score_and_measure(validation: DataFrame, model_path: str, vocab: Optional[Sequence[int]] = None,
                      target_configs=None, sliced: bool = True, output_path: Optional[str] = None,
                      noise: float = 0.0, seed: int = 0, platforms=CLI_PLATFORMS, nav_screen: Optional[str] = NAV_VIDEO_FOR_YOU,
                      formula_path: Optional[str] = DEFAULT_FORMULA_PATH) -> dict[str, DataFrame]:
    """Entry B: load the saved model, score, measure; optionally write the
    scored table (Parquet) next to the metrics.

    The model table names its vocabulary; ``vocab``, where given, must be the same ids in the same order.  The slice is the
    one of :func:`evaluate`; an argument of None does not filter."""
    model = RK.load_model(model_path)
    if vocab is not None and list(vocab) != model.vocab:
        raise ValueError(f"the model was fitted on the ids {model.vocab}, not {list(vocab)}")
    scored = RK.score(validation.withColumn("features", dense_vector(Cols.FEATURES, model.vocab)), model.coefficients,
                      noise=noise, seed=seed)
    if output_path:
        scored.write.mode("overwrite").parquet(output_path)
        scored = validation.sparkSession.read.parquet(output_path)
    targets = target_configs or {"watch_coverage_30s": DEFAULT_TARGETS["watch_coverage_30s"]}
    return evaluate(scored, targets, score_col=Cols.MODEL_SCORE, sliced=sliced, platforms=platforms, nav_screen=nav_screen,
                    formula_path=formula_path)


def linear_model_auc(train: DataFrame, test: DataFrame, target_label: str = EV_ACTION_PLAY,
                     max_features: int = 213, c: float = 10.0) -> DataFrame:
    """Entry D: B8 matrices -> R8 classifier -> AUC of predictions and probabilities."""
    x_train, x_test, ids = MX.train_test_split(train, test, target_label, max_features=max_features)
    model, _ = RK.linear_classifier(x_train, [f"feat_{i}" for i in ids], c=c)
    pred = written(RK.predict_classifier(model, x_test).select("label", "prediction", "p1"))
    parts = []
    for kind, col in (("prediction", "prediction"), ("probability", "p1")):
        lab = pred.select(F.col("label").alias("label_y"), F.col(col).alias("s"))
        parts.append(M.global_auc(lab, ["y"], "s").select(F.lit(kind).alias("score_kind"), "AUC", "AUC_valid"))
    return parts[0].unionByName(parts[1])


def write_training_extract(df: DataFrame, path: str, limit: Optional[int] = 500_000,
                           whole_sessions: bool = False, **predicate) -> None:
    """Entry E: filter, project, cut and replace the target table.  Files are
    written in (rid, pos) order (range partitions, sorted within each); the
    extract holds at most ``limit`` rows, so this sort is small."""
    ext = training_extract(df, limit=limit, whole_sessions=whole_sessions, **predicate)
    ext.repartitionByRange("rid", "pos").sortWithinPartitions("rid", "pos").write.mode("overwrite").parquet(path)
