"""Impression readers, writers and slice extracts."""

from __future__ import annotations

import os
from typing import Callable, Iterable, Optional, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankfold.config import (CLI_PLATFORMS, DEFAULT_FORMULA_PATH, DEFAULT_RECOMMENDER_ID, DEFAULT_TYPE_ID,
                             DEFAULT_USER_TYPE, NAV_VIDEO_FOR_YOU, PLATFORM_VK_VIDEO_ANDROID, Cols)
from rankfold.operators.features import with_positions
from rankfold.operators.indexing import first_n, key_at
from rankfold.session import dealt

# Raw NDJSON schema: score and feature values as text, so every spelling of a
# non-finite number ("nan", "inf", "NaN", "-Infinity") survives and is
# converted with try_cast (Spark's JSON reader nulls some of them as double).
RAW_SCHEMA = T.StructType([
    T.StructField("rid", T.StringType()),
    T.StructField("score", T.StringType()),
    T.StructField("events", T.ArrayType(T.StringType())),
    T.StructField("viewTimeSec", T.LongType()),
    T.StructField("durationSeconds", T.LongType()),
    T.StructField("navScreen", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("formulaPath", T.StringType()),
    T.StructField("typeId", T.LongType()),
    T.StructField("userType", T.StringType()),
    T.StructField("recommenderId", T.LongType()),
    T.StructField("features", T.ArrayType(T.ArrayType(T.StringType()))),
])

EXTRACT_COLUMNS = ["typeId", "userType", "recommenderId", "navScreen", "features", "rid", "events",
                   "viewTimeSec", "platform", "score", "formulaPath", "durationSeconds"]
SLICE_COLUMNS = ["navScreen", "rid", "events", "viewTimeSec", "platform", "score", "formulaPath"]


def _to_double(c):
    """try_cast text -> double; also accepts lower-case nan / inf spellings."""
    low = F.lower(F.trim(c))
    return (F.when(low.isin("nan", "+nan", "-nan"), F.lit(float("nan")))
             .when(low.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf")))
             .when(low.isin("-inf", "-infinity"), F.lit(float("-inf")))
             .otherwise(c.try_cast("double")))


_FILE_ORDER = ["_file", "_block", "_line"]


def _file_below(df: DataFrame) -> Column:
    """The path of a row's file below the folder that all files of ``df`` share: the same order in less room."""
    folder = os.path.commonprefix(df.inputFiles()).rpartition("/")[0] + "/"
    path = F.col("_metadata.file_path")
    return F.when(path.startswith(folder), F.substr(path, F.lit(len(folder) + 1))).otherwise(path)


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _numbers_first(df: DataFrame, last: str) -> DataFrame:
    """Numbers side by side, texts and arrays behind them, each in their order, ``last`` at the end: rows in a row then have
    longer stretches in common, and their compressed shuffle blocks are smaller."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))}
    return df.select(*map(_named, sorted(df.columns, key=lambda n: (n == last, n in texts))))


def with_file_positions(df: DataFrame, where: Optional[Column] = None, session_col: str = Cols.RID,
                        prepare: Optional[Callable[[DataFrame], DataFrame]] = None, rows: Optional[int] = None) -> DataFrame:
    """``df``, read from files, with ``pos``: the place of a row among those of its session, in the order of the files and their lines.

    ``where`` is applied first, so it reaches the scan; only what it leaves is numbered.  A row without a session is one by
    itself.  ``prepare`` converts the rows or leaves columns out before they are dealt by session, so that they travel as
    narrow as they are asked for; it keeps the columns of ``_FILE_ORDER``.  ``rows`` is about their number, where it is known:
    the tasks that they are dealt over grow with it.
    """
    kept = df if where is None else df.where(where)
    tagged = kept.select("*", _file_below(df).alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                         F.monotonically_increasing_id().alias("_line"))
    tagged = tagged if prepare is None else prepare(tagged)
    names = [n for n in tagged.columns if n not in _FILE_ORDER]
    alone = F.when(F.col(session_col).isNull(), F.xxhash64(*_FILE_ORDER)).alias("_alone")
    tagged = _numbers_first(tagged.select(*_FILE_ORDER, alone, *map(_named, names)), session_col)
    if rows is not None:
        tagged = dealt(tagged, rows, session_col, "_alone")
    order = Window.partitionBy(session_col, "_alone").orderBy(*_FILE_ORDER)
    return tagged.withColumn(Cols.POS, F.row_number().over(order) - 1).select(*map(_named, dict.fromkeys([*names, Cols.POS])))


def read_impressions(spark: SparkSession, path: str, extra_columns: Optional[dict] = None,
                     score_columns: Iterable[str] = ("score",), malformed: str = "fail", where: Optional[Column] = None,
                     columns: Optional[Sequence[str | Column]] = None, rows: Optional[int] = None) -> DataFrame:
    """NDJSON impressions with an explicit schema; missing paths raise.
    A malformed line raises when it is read (``malformed="fail"``) or is left
    out (``"drop"``); it never counts as a row.  ``pos`` is the place of a row
    among those of its session, in the order of the files and their lines; with ``where``
    (a condition on the raw columns) among those that it leaves.
    ``extra_columns`` maps more column names to Spark types (e.g. a model score
    written by :func:`write_impressions`).  ``columns`` (names or expressions over the converted columns,
    ``rid`` among them) come out beside ``pos`` in place of all columns; they are made where the lines are read, and nothing else
    is moved to number the rows.  ``rows``, about how many there are, lets the tasks grow with them."""
    fields = list(RAW_SCHEMA.fields)
    for name, typ in (extra_columns or {}).items():
        fields.append(T.StructField(name, T.StringType() if name in score_columns else typ))
    schema = T.StructType(fields)
    mode = {"fail": "FAILFAST", "drop": "DROPMALFORMED"}[malformed]
    raw = spark.read.schema(schema).option("mode", mode).json(path)

    def prepare(lines: DataFrame) -> DataFrame:
        made = normalize_raw(lines, score_columns)
        return made if columns is None else made.select(*columns, *_FILE_ORDER)

    return with_file_positions(raw, where, prepare=prepare, rows=rows)


def normalize_raw(raw: DataFrame, score_columns: Iterable[str] = ("score",)) -> DataFrame:
    """Text scores and feature values -> doubles (batch and streaming ingest)."""
    feats = F.transform(F.col("features"), lambda f: F.transform(f, lambda x: _to_double(x)))
    cols = {c: _to_double(F.col(c)) for c in score_columns if c in raw.columns}
    cols["features"] = feats
    return raw.withColumns(cols)


def write_impressions(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """Write a (scored) impression table; NDJSON keeps the ingest format,
    Parquet is the working format."""
    df.write.mode(mode).format(fmt).save(path)


def extract_predicate(nav_screen: str = NAV_VIDEO_FOR_YOU, platforms: Iterable[str] = CLI_PLATFORMS,
                      formula_path: str = DEFAULT_FORMULA_PATH, type_id: int = DEFAULT_TYPE_ID,
                      user_type: str = DEFAULT_USER_TYPE, recommender_id: int = DEFAULT_RECOMMENDER_ID):
    """the evaluation-slice and training-slice equalities together."""
    return ((F.col(Cols.NAV_SCREEN) == nav_screen) & F.col(Cols.PLATFORM).isin(*platforms)
            & (F.col(Cols.FORMULA_PATH) == formula_path) & (F.col(Cols.TYPE_ID) == type_id)
            & (F.col(Cols.USER_TYPE) == user_type) & (F.col(Cols.RECOMMENDER_ID) == recommender_id))


def training_extract(df: DataFrame, limit: Optional[int] = 500_000, whole_sessions: bool = False,
                     tiebreak: str = Cols.POS, **predicate) -> DataFrame:
    """S3: project 12 columns, filter (F3), order by rid (+ tie-break), first
    ``limit`` rows.  The cut is distributed (range partitions + offsets), not
    one merge task.  ``whole_sessions`` keeps only sessions that fit entirely."""
    kept = df.where(extract_predicate(**predicate))
    # a table without positions gets them by a digest of the row, among the rows that stay
    sel = kept.select(*EXTRACT_COLUMNS, tiebreak) if tiebreak in df.columns else with_positions(kept.select(*EXTRACT_COLUMNS)).withColumnRenamed(Cols.POS, tiebreak)
    if limit is None:
        return sel
    if not whole_sessions:
        return first_n(sel, ["rid", tiebreak], limit)
    # a session fits when it ends before the session of the first row outside the cut begins
    cut = key_at(sel, ["rid", tiebreak], limit)
    if cut is None:
        return sel
    return sel.where(F.col("rid").isNull() | (F.col("rid") < F.lit(cut[0]))) if cut[0] is not None else sel.limit(0)


def slice_projection(df: DataFrame, platform: str = PLATFORM_VK_VIDEO_ANDROID,
                     nav_screen: str = NAV_VIDEO_FOR_YOU, formula_path: str = DEFAULT_FORMULA_PATH) -> DataFrame:
    """F4 + S4 (projection): three equalities, seven columns."""
    return df.where((F.col(Cols.PLATFORM) == platform) & (F.col(Cols.NAV_SCREEN) == nav_screen)
                    & (F.col(Cols.FORMULA_PATH) == formula_path)).select(*SLICE_COLUMNS)


def write_slice(df: DataFrame, path: str, overwrite: bool = True, fmt: str = "parquet", **kw) -> None:
    """Write the slice; ``overwrite=False`` leaves an existing output alone."""
    slice_projection(df, **kw).write.mode("overwrite" if overwrite else "ignore").format(fmt).save(path)
