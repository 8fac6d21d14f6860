"""Entry C: the metric API over a stored slice, as one Spark job per output."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame

from rankfold.config import CLI_PLATFORMS, DEFAULT_FORMULA_PATH, DEFAULT_TARGETS, NAV_VIDEO_FOR_YOU, Cols
from rankfold.operators import metrics as M


def evaluate(df: DataFrame, target_configs=None, score_col: str = Cols.SCORE, session_col: str = Cols.RID,
             sliced: bool = False, platforms=CLI_PLATFORMS, nav_screen: Optional[str] = NAV_VIDEO_FOR_YOU,
             formula_path: Optional[str] = DEFAULT_FORMULA_PATH, details_only: bool = False,
             **kw) -> dict[str, DataFrame]:
    """Return ``metrics``, ``group_details``, ``compare``, ``summary`` and
    ``target_details`` DataFrames for the impression table ``df`` (only
    ``group_details`` when ``details_only``)."""
    targets = target_configs if target_configs is not None else DEFAULT_TARGETS
    if sliced:
        metrics, details = M.gauc(df, targets, session_col, score_col, platforms=platforms,
                                  nav_screen=nav_screen, formula_path=formula_path, details_only=details_only, **kw)
    else:
        metrics, details = M.gauc(df, targets, session_col, score_col, details_only=details_only, **kw)
    if details_only:
        return {"group_details": details}
    # one row per target: a single small result, computed once so that
    # compare / summary / target_details do not re-run the metric job
    metrics = df.sparkSession.createDataFrame(metrics.collect(), metrics.schema)
    one, target_details = M.summary(metrics)
    return {"metrics": metrics, "group_details": details, "compare": M.compare_auc_gauc(metrics),
            "summary": one, "target_details": target_details}
