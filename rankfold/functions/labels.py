"""Event tests and binary labels (F5, F6, L1, L5) plus score cleaning."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfold.config import Cols, TargetConfig


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def has_event(name: str, events: str | Column = Cols.EVENTS) -> Column:
    """Null-safe membership test: false for a null list and for a list that holds
    NULL without a match (``array_contains`` would return NULL there)."""
    return F.coalesce(F.array_contains(_c(events), F.lit(name)), F.lit(False))


def has_any_event(names, events: str | Column = Cols.EVENTS) -> Column:
    """True if at least one of ``names`` is in the list (null-safe)."""
    wanted = F.array(*[F.lit(n) for n in names])
    return F.coalesce(F.arrays_overlap(_c(events), wanted), F.lit(False))


def has_event_matching(pattern: str, events: str | Column = Cols.EVENTS) -> Column:
    """True if any event matches the (unanchored) regular expression."""
    return F.coalesce(
        F.exists(_c(events), lambda e: F.coalesce(e.rlike(pattern), F.lit(False))),
        F.lit(False),
    )


def label_expr(cfg: TargetConfig, df: Optional[DataFrame] = None,
               events: str = Cols.EVENTS, view_time: str = Cols.VIEW_TIME) -> Column:
    """L1: 1 when the event is present (and watch time >= threshold and the
    optional condition holds), else 0.  NULL conditions count as false."""
    cond = has_event(cfg.event_name, events)
    if cfg.view_threshold_sec is not None:
        cond = cond & (F.col(view_time) >= F.lit(float(cfg.view_threshold_sec)))
    if cfg.condition is not None and df is not None:
        cond = cond & cfg.condition(df)
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def pattern_label_expr(pattern: str, view_time_threshold: Optional[float] = None,
                       events: str = Cols.EVENTS, view_time: str = Cols.VIEW_TIME) -> Column:
    """Matrix label = any event matches ``pattern`` AND watch time >= t."""
    cond = has_event_matching(pattern, events)
    if view_time_threshold is not None:
        cond = cond & F.coalesce(F.col(view_time) >= F.lit(float(view_time_threshold)), F.lit(False))
    return cond.cast("int")


def clean_score(score: str | Column) -> Column:
    """NaN and NULL scores count as 0.0 (``nanvl(NULL, 0)`` is NULL, so both)."""
    s = _c(score).cast("double")
    return F.coalesce(F.nanvl(s, F.lit(0.0)), F.lit(0.0))
