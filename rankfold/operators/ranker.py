"""Pairwise linear ranker (R1-R5) and the impute -> scale ->
logistic-regression recipe (R8).

The reference trains a boosted-tree ranker with a pairwise-logit loss.  Here
the same loss is fitted on a linear scorer, over sessions and without a row per pair (see ``pairfit``).  A fitted
model is a small table: vocabulary id, coefficient and settings.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Optional, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.config import BIG_NEGATIVE, GRADED_TARGET_NAMES, Cols
from rankfold.functions.vectors import dot
from rankfold.operators.pairfit import fit_rankers, session_blocks
from rankfold.session import written


def clean_value(x: Column, missing: float = BIG_NEGATIVE) -> Column:
    """Missing sentinel and NaN -> 0.0 (a linear scorer cannot use -3.4e38)."""
    return F.when(F.isnan(x) | (x <= F.lit(missing) / 2), F.lit(0.0)).otherwise(x.cast("double"))


def clean_vector(features: str = "features", missing: float = BIG_NEGATIVE):
    """:func:`clean_value` of each entry."""
    return F.transform(F.col(features), lambda x: clean_value(x, missing))


@dataclass
class LinearModel:
    """Coefficients by vocabulary id, and how they were fitted."""

    vocab: list[int]
    coefficients: list[float]
    settings: dict = field(default_factory=dict)


def target_weights(features: DataFrame) -> list[float]:
    """The weights of the graded targets that a feature table was made with (zeros when it is empty)."""
    row = features.select(F.transform("targets", lambda t: t["weight"])).first()
    return [float(w) for w in row[0]] if row else [0.0] * len(GRADED_TARGET_NAMES)


def fit_pairwise(features: DataFrame, vocab: Sequence[int], max_iter: int = 150, reg_param: float = 1e-3, tol: float = 1e-6) -> LinearModel:
    """R1 + R2: pairwise-logit fit on a feature table with the weights of its targets."""
    weights = target_weights(features)
    blocks = session_blocks(features).persist(StorageLevel.MEMORY_AND_DISK)  # made here, read by every pass
    try:
        fit = fit_rankers(blocks, [weights], len(vocab), max_iter, reg_param, tol)[0]
    finally:
        blocks.unpersist()
    return LinearModel(list(vocab), fit.coefficients, {"weights": weights, "reg_param": reg_param, "n_pairs": fit.n_pairs, "loss": fit.loss, "residual": fit.residual})


def coefficients(model: LinearModel) -> list[float]:
    return [float(c) for c in model.coefficients]


def score(df: DataFrame, coef: Sequence[float], features: str = "features",
          score_col: str = Cols.MODEL_SCORE, noise: float = 0.0, seed: Optional[int] = 0) -> DataFrame:
    """Linear score of the dense features; NaN -> -3.4e38; optional
    Gaussian noise with a seed."""
    s = dot(features, coef, clean_value)
    if noise:
        s = s + F.lit(float(noise)) * F.randn(seed)
    return df.withColumn(score_col, F.nanvl(s, F.lit(BIG_NEGATIVE)))


def score_with_model(df: DataFrame, predict, features: str = "features", score_col: str = Cols.MODEL_SCORE,
                     noise: float = 0.0, seed: int = 0) -> DataFrame:
    """R3 for any user model: ``predict(X: np.ndarray[float32, (rows, V)]) ->
    np.ndarray`` runs on Arrow batches inside the tasks (``mapInPandas``);
    NaN predictions become -3.4e38; the optional Gaussian noise is seeded per
    partition, in the plan.
    Use :func:`score` for linear models (stays in the JVM)."""
    import numpy as np
    from pyspark.sql import types as T

    schema = T.StructType(df.schema.fields + [T.StructField(score_col, T.DoubleType())])

    def run(batches):
        for pdf in batches:
            x = np.array(pdf[features].tolist(), dtype=np.float32) if len(pdf) else np.zeros((0, 0), np.float32)
            pred = np.asarray(predict(x), dtype=np.float64).reshape(-1) if len(pdf) else np.zeros(0)
            pdf[score_col] = pred
            yield pdf

    scored = df.mapInPandas(run, schema)
    s = F.col(score_col) + F.lit(float(noise)) * F.randn(seed) if noise else F.col(score_col)
    return scored.withColumn(score_col, F.nanvl(F.coalesce(s, F.lit(float("nan"))), F.lit(BIG_NEGATIVE)))


def score_stats(scored: DataFrame, score_col: str = Cols.MODEL_SCORE) -> DataFrame:
    """Min, max, population std of the predictions."""
    return scored.agg(F.min(score_col).alias("min"), F.max(score_col).alias("max"),
                      F.stddev_pop(score_col).alias("std"))


MODEL_SCHEMA = "position int, feature_id int, coefficient double, settings string"


def save_model(model: LinearModel, path: str) -> None:
    """The model as a Parquet table of one row per vocabulary id."""
    spark = SparkSession.active()
    rows = [(k, int(i), float(c), json.dumps(model.settings, sort_keys=True)) for k, (i, c) in enumerate(zip(model.vocab, model.coefficients, strict=True))]
    spark.createDataFrame(rows, MODEL_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def load_model(path: str) -> LinearModel:
    """A saved model (as many rows as the vocabulary has ids)."""
    rows = SparkSession.active().read.schema(MODEL_SCHEMA).parquet(path).orderBy("position").collect()
    return LinearModel([r["feature_id"] for r in rows], [r["coefficient"] for r in rows], json.loads(rows[0]["settings"]) if rows else {})


# ---------------------------------------------------------------- R8
def linear_classifier(x_train: DataFrame, feature_cols: Sequence[str], c: float = 10.0, max_iter: int = 5000,
                      label_col: str = "label", tol: float = 1e-6):
    """Mean imputation -> standardisation (with mean) -> L2 logistic
    regression with ``regParam = 1 / (C * n)`` (the same optimum as an
    inverse-strength-C penalty).  Columns that are entirely missing are
    dropped first (the imputer cannot fill them)."""
    # written once: the imputer, the scaler and the regression read the matrix again and again
    x_train = written(x_train.select(*feature_cols, F.col(label_col).cast("double").alias(label_col)))
    # one pass for the columns that are present and the number of rows
    seen = x_train.agg(F.count(F.lit(1)), *[F.count(F.when(~F.isnan(F.col(c_)), 1)) for c_ in feature_cols]).first()
    n, cols = seen[0], [c_ for c_, k in zip(feature_cols, seen[1:], strict=True) if k > 0]
    imputed = [f"{c_}_imp" for c_ in cols]
    stages = [
        Imputer(inputCols=list(cols), outputCols=imputed, strategy="mean"),
        VectorAssembler(inputCols=imputed, outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
        LogisticRegression(featuresCol="_scaled", labelCol=label_col, regParam=1.0 / (c * max(n, 1)),
                           elasticNetParam=0.0, maxIter=max_iter, standardization=False, tol=tol),
    ]
    return Pipeline(stages=stages).fit(x_train), cols


def predict_classifier(model, x: DataFrame) -> DataFrame:
    out = model.transform(x)
    return out.withColumn("p1", vector_to_array("probability")[1])
