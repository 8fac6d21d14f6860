"""Training slice, graded targets and the feature table."""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankfold.config import (BIG_NEGATIVE, DEFAULT_RECOMMENDER_ID, DEFAULT_TYPE_ID, DEFAULT_USER_TYPE,
                             TRAIN_EVENTS, Cols)
from rankfold.functions.labels import has_any_event
from rankfold.functions.targets import consumption_time, dislike_target, label_value, like_target, targets_array
from rankfold.functions.vectors import dense_vector


def training_slice(df: DataFrame, type_id: int = DEFAULT_TYPE_ID, user_type: str = DEFAULT_USER_TYPE,
                   recommender_id: int = DEFAULT_RECOMMENDER_ID, events: str = Cols.EVENTS) -> DataFrame:
    """type / user type / recommender equality AND one of the training events."""
    return df.where((F.col(Cols.TYPE_ID) == F.lit(type_id)) & (F.col(Cols.USER_TYPE) == F.lit(user_type))
                    & (F.col(Cols.RECOMMENDER_ID) == F.lit(recommender_id))
                    & has_any_event(TRAIN_EVENTS, events))


def with_graded_targets(df: DataFrame) -> DataFrame:
    """T1-T4 as columns ``like_target``, ``dislike_target``,
    ``consumption_time_target`` and ``label_value``."""
    out = df.withColumns({
        "like_target": like_target(),
        "dislike_target": dislike_target(),
        "consumption_time_target": consumption_time(),
    })
    return out.withColumn("label_value", label_value())


def informative(df: DataFrame, targets: str = "targets") -> DataFrame:
    """Keep rows whose targets are not all equal (NaNs count as one value)."""
    return df.where(F.size(F.array_distinct(F.transform(F.col(targets), lambda t: t["target"]))) > 1)


def with_positions(df: DataFrame, session_col: str = Cols.RID, tiebreak: Sequence[str] = ()) -> DataFrame:
    """``pos`` = 0-based position inside the session by the caller's
    tie-break columns (falls back to an ``xxhash64`` of the row)."""
    if Cols.POS in df.columns:
        return df
    order = list(tiebreak) or [F.xxhash64(*[F.col(c) for c in df.columns])]
    w = Window.partitionBy(session_col).orderBy(*order)
    return df.withColumn(Cols.POS, F.row_number().over(w) - 1)


def feature_table(df: DataFrame, vocab: Sequence[int], like_weight: float, dislike_weight: float,
                  consumption_time_weight: float, type_id: int = DEFAULT_TYPE_ID,
                  user_type: str = DEFAULT_USER_TYPE, recommender_id: int = DEFAULT_RECOMMENDER_ID,
                  default: float = BIG_NEGATIVE, keep_informative_only: bool = True) -> DataFrame:
    """F2 -> T1..T5 -> X3 -> T6.  Output: rid, pos, features array<float>,
    targets array<struct<name,target,weight>>, label_value, plus the three
    target columns.  No global sort: rows stay hash-partitioned by session."""
    sliced = with_graded_targets(training_slice(df, type_id, user_type, recommender_id))
    out = sliced.select(
        Cols.RID, Cols.POS,
        dense_vector(Cols.FEATURES, vocab, default).alias("features"),
        targets_array(like_weight, dislike_weight, consumption_time_weight).alias("targets"),
        "label_value", "like_target", "dislike_target", "consumption_time_target")
    if not keep_informative_only:
        return out
    # the rule of informative() on the three columns themselves: equal with NULL and NaN as values
    like, dislike, time = F.col("like_target"), F.col("dislike_target"), F.col("consumption_time_target")
    return out.where(~(like.eqNullSafe(dislike) & dislike.eqNullSafe(time)))


# ---------------------------------------------------------------- X1 / X2 / S5
def read_feature_names(spark: SparkSession, path: str) -> DataFrame:
    """One name per line, stripped, file order kept -> (idx, feature_name).
    The file is small (a vocabulary), read whole so line order is exact."""
    raw = spark.read.text(path, wholetext=True)
    lines = raw.select(F.posexplode(F.split(F.col("value"), "\r?\n")).alias("idx", "feature_name"))
    lines = lines.select("idx", F.trim("feature_name").alias("feature_name")).where(F.col("feature_name") != "")
    return lines


def resolve_vocabulary(names: DataFrame, dictionary: DataFrame) -> DataFrame:
    """X1 + X2: names -> ids through the dictionary table, unknown names dropped,
    file order kept; one position per id (Dev 2.13-4: the last name wins).
    Output: (idx dense 0.., feature_name, feature_id)."""
    # no hint: the planner broadcasts a side only under its size threshold
    joined = names.join(dictionary.select("feature_name", "feature_id"), "feature_name", "inner")
    last = joined.groupBy("feature_id").agg(F.max_by("feature_name", "idx").alias("feature_name"),
                                           F.max("idx").alias("file_idx"))
    w = Window.orderBy("file_idx")  # vocabulary sized: a few hundred rows
    return last.select((F.row_number().over(w) - 1).alias("idx"), "feature_name", "feature_id")


def vocabulary_ids(vocab_df: DataFrame, limit: Optional[int] = 100_000) -> list[int]:
    """Bring the (small, checked) vocabulary to the driver for the plan literals."""
    n = vocab_df.count()
    if limit is not None and n > limit:
        raise ValueError(f"vocabulary has {n} ids, more than the {limit} allowed as plan literals")
    return [int(r["feature_id"]) for r in vocab_df.orderBy("idx").collect()]
