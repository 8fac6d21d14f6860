"""Dense matrices and feature statistics for a linear classifier."""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.config import EV_ACTION_PLAY, Cols
from rankfold.functions.labels import pattern_label_expr
from rankfold.functions.vectors import _valid_pairs, dense_vector, index_vector


def _pairs(df: DataFrame, features: str = Cols.FEATURES, need_value: bool = True) -> DataFrame:
    """Explode the sparse list to (id, value) for pairs with a numeric id
    (and, if ``need_value``, a numeric value).  Partial aggregation after this
    explode keeps one row per distinct id per task before the shuffle."""
    ex = df.select(F.explode(features).alias("_p"))
    fid = F.get("_p", 0).try_cast("double")
    val = F.get("_p", 1).try_cast("double")
    ok = (F.size("_p") >= 2) & fid.isNotNull()
    if need_value:
        ok = ok & val.isNotNull()
    return ex.where(ok).select(fid.try_cast("int").alias("feature_id"), val.alias("value")) \
             .where(F.col("feature_id").isNotNull())


def dense_matrix(df: DataFrame, num_features: int = 256, keep: Sequence[str] = (Cols.RID, Cols.POS),
                 features: str = Cols.FEATURES) -> DataFrame:
    """B1: ``features`` array<float> indexed by raw id (0 <= id < n), default 0.0."""
    return df.select(*keep, index_vector(features, num_features).alias("features"))


def matrix_health(matrix: DataFrame, num_features: int, features: str = "features") -> DataFrame:
    """B2: non-zero cells and share, used columns, the first 10 unused ids.
    One aggregate with a sum per column - no explode of the dense vectors."""
    sums = matrix.agg(F.count(F.lit(1)).alias("_rows"),
                      *[F.sum((F.col(features)[i] != 0).cast("long")).alias(f"_nz{i}") for i in range(num_features)])
    nz = F.array(*[F.coalesce(F.col(f"_nz{i}"), F.lit(0)) for i in range(num_features)])
    total = F.col("_rows") * F.lit(num_features)
    non_zero = F.aggregate(nz, F.lit(0).cast("long"), lambda a, b: a + b)
    unused = F.filter(F.sequence(F.lit(0), F.lit(num_features - 1)), lambda i: F.element_at(nz, i + 1) == 0)
    return sums.select(
        non_zero.alias("non_zero"), total.alias("total_cells"),
        F.when(total > 0, non_zero / total).otherwise(F.lit(0.0)).alias("non_zero_share"),
        F.size(F.filter(nz, lambda x: x > 0)).alias("used_features"),
        F.slice(unused, 1, 10).alias("unused_first10"))


def feature_profile(df: DataFrame, num_features: int = 256,
                    features: str = Cols.FEATURES) -> tuple[DataFrame, DataFrame]:
    """Totals (rows, all list entries, entries per row, max valid id) and
    per-id count / mean / population std / min / max for ids < n.  NaN values
    are counted separately (Spark orders NaN last, so min skips it)."""
    valid_ids = F.transform(_valid_pairs(features), lambda p: F.get(p, 0).try_cast("double").try_cast("int"))
    totals = df.agg(F.count(F.lit(1)).alias("total_rows"),
                    F.coalesce(F.sum(F.size(F.coalesce(F.col(features), F.array().cast("array<array<double>>")))),
                               F.lit(0)).cast("long").alias("total_feature_pairs"),
                    F.max(F.array_max(valid_ids)).alias("max_feature_index"))
    totals = totals.select(
        "total_rows", "total_feature_pairs",
        F.when(F.col("total_rows") > 0, F.col("total_feature_pairs") / F.col("total_rows")).otherwise(F.lit(0.0))
         .alias("avg_pairs_per_row"),
        F.coalesce("max_feature_index", F.lit(0)).alias("max_feature_index"))
    pairs = _pairs(df, features)
    per_id = pairs.where(F.col("feature_id") < num_features).groupBy("feature_id").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.count_if(F.isnan("value")).alias("nan_count"))
    return totals, per_id


def frequent_features(df: DataFrame, min_frequency: int = 10, max_features: Optional[int] = 500,
                      features: str = Cols.FEATURES) -> DataFrame:
    """B4 + B5: ids with at least ``min_frequency`` pairs (values not looked
    at), ascending; capped at the ``max_features`` lowest ids."""
    counts = _pairs(df, features, need_value=False).groupBy("feature_id").agg(F.count(F.lit(1)).alias("n"))
    freq = counts.where(F.col("n") >= min_frequency)
    if max_features is not None:
        # the vocabulary is small by construction (<= max_features rows)
        freq = freq.orderBy("feature_id").limit(int(max_features))
    return freq


def selected_matrix(df: DataFrame, feature_ids: Sequence[int], keep: Sequence[str] = (Cols.RID, Cols.POS),
                    features: str = Cols.FEATURES, wide: bool = True) -> DataFrame:
    """Matrix over the selected ids (default 0.0, last duplicate wins, no
    rounding); ``feat_<id>`` columns when ``wide`` else one array column."""
    vec = dense_vector(features, list(feature_ids), default=0.0, round_digits=None)
    out = df.select(*keep, vec.alias("features"), *[c for c in df.columns if c.startswith("label")])
    if not wide:
        return out
    return out.select(*keep, *[F.col("features")[i].alias(f"feat_{fid}") for i, fid in enumerate(feature_ids)],
                      *[c for c in out.columns if c.startswith("label")])


def vocabulary(df: DataFrame, min_frequency: int = 10, max_features: int = 500,
               features: str = Cols.FEATURES) -> list[int]:
    """B4/B5 as plan literals: at most ``max_features`` ids reach the driver."""
    return [int(r["feature_id"]) for r in
            frequent_features(df, min_frequency, max_features, features).orderBy("feature_id").collect()]


def xy_matrix(df: DataFrame, target_label: str = EV_ACTION_PLAY, view_time_threshold: Optional[float] = None,
              max_features: int = 500, min_frequency: int = 10, feature_ids: Optional[Sequence[int]] = None,
              keep: Sequence[str] = (Cols.RID, Cols.POS), wide: bool = True) -> tuple[DataFrame, list[int]]:
    """(X with label column, vocabulary).  The label is the event pattern
    label (L5)."""
    ids = list(feature_ids) if feature_ids is not None else vocabulary(df, min_frequency, max_features)
    labeled = df.withColumn("label", pattern_label_expr(target_label, view_time_threshold))
    return selected_matrix(labeled, ids, keep, wide=wide), ids


def train_test_split(train: DataFrame, test: DataFrame, target_label: str = EV_ACTION_PLAY,
                     max_features: int = 500, min_frequency: int = 10,
                     view_time_threshold: Optional[float] = None, wide: bool = True):
    """Fit the vocabulary on ``train`` and apply it to both (Dev 2.13-6)."""
    x_train, ids = xy_matrix(train, target_label, view_time_threshold, max_features, min_frequency, wide=wide)
    x_test, _ = xy_matrix(test, target_label, view_time_threshold, feature_ids=ids, wide=wide)
    return x_train, x_test, ids
