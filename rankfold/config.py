"""Column names, vocabularies, default parameters and label targets."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Optional

from pyspark.sql import Column, DataFrame


class Cols:
    """Default column names of the impression table (overridable per call)."""

    RID = "rid"
    POS = "pos"
    SCORE = "score"
    MODEL_SCORE = "model_score"
    EVENTS = "events"
    VIEW_TIME = "viewTimeSec"
    DURATION = "durationSeconds"
    NAV_SCREEN = "navScreen"
    PLATFORM = "platform"
    FORMULA_PATH = "formulaPath"
    FEATURES = "features"
    TYPE_ID = "typeId"
    USER_TYPE = "userType"
    RECOMMENDER_ID = "recommenderId"


# --- fixed values: these must equal the reference's for the same results ---
# Event names used by labels, targets and the training-slice filter.
EV_ACTION_PLAY = "actionPlay"
EV_LIKE = "actionLike"
EV_DISLIKE = "actionDislike"
EV_WATCH_COVERAGE = "watchCoverageRecord"
EV_FIRST_FRAME = "firstFrame"
EV_CARD_VIEW = "card_view"
EV_UNLIKE = "actionUnlike"
EV_UNDISLIKE = "actionUndislike"
# Events that admit a row to the training slice (any one of them).
TRAIN_EVENTS = ("actionDislike", "actionLike", "watchCoverageRecord", "card_view")
# Platforms, nav screen and formula path of the evaluation slice.
PLATFORM_ANDROID = "android"
PLATFORM_VK_VIDEO_ANDROID = "vk_video_android"
NAV_VIDEO_FOR_YOU = "video_for_you"
DEFAULT_FORMULA_PATH = "fstorage:vk_video_266_1769078359_f"
CLI_PLATFORMS = ("android", "vk_video_android")
METRIC_API_PLATFORMS = ("vk_video_android",)
# Training-slice constants.
DEFAULT_TYPE_ID = 1776
DEFAULT_USER_TYPE = "vk"
DEFAULT_RECOMMENDER_ID = 200
# Sentinel for a missing feature and for a NaN prediction.
BIG_NEGATIVE = -3.4e38
# Pairs whose |weight| is below this are dropped.
MIN_PAIR_WEIGHT = 1e-8
# Weight-search ranges (like, dislike, consumption time).
WEIGHT_RANGES = {"like_weight": (0.0, 1000.0), "dislike_weight": (0.0, 1000.0),
                 "consumption_time_weight": (0.0, 100.0)}
# Summary field names (the run-log lookup accepts only these).
SUMMARY_FIELDS = ("GAUCSimple", "GAUCWeighted", "n_groups", "std", "min", "max",
                  "median", "group_details", "target_details", "GAUC_valid")
# Names of the three graded targets, in this order.
GRADED_TARGET_NAMES = ("like", "dislike", "consumption_time")
# --- end of fixed values ---


@dataclass(frozen=True)
class TargetConfig:
    """A binary label: event present, optionally watch time >= threshold and a
    caller-given extra condition (``Callable[[DataFrame], Column]``)."""

    target_name: str
    event_name: str
    view_threshold_sec: Optional[float] = None
    condition: Optional[Callable[[DataFrame], Column]] = field(default=None, compare=False)


# --- fixed values: the built-in target catalogue ---
DEFAULT_TARGETS = {
    "action_play": TargetConfig("action_play", "actionPlay"),
    "watch_coverage_30s": TargetConfig("watch_coverage_30s", "watchCoverageRecord", 30.0),
    "watch_coverage_60s": TargetConfig("watch_coverage_60s", "watchCoverageRecord", 60.0),
    "first_frame": TargetConfig("first_frame", "firstFrame"),
}
# --- end of fixed values ---


def resolve_targets(target_configs) -> list[tuple[str, TargetConfig]]:
    """Normalise dict / list[TargetConfig] / list[str] to ``[(name, config)]``.

    The dict key is the label name (the reference aliases by ``target_name`` but
    looks results up by key; here both are the key).  Mixed lists and other
    types raise ``TypeError``; an empty list yields no targets.
    """
    if isinstance(target_configs, dict):
        out = []
        for key, cfg in target_configs.items():
            if not isinstance(cfg, TargetConfig):
                raise TypeError(f"dict values must be TargetConfig, got {type(cfg)}")
            out.append((str(key), cfg))
        return out
    if isinstance(target_configs, (list, tuple)):
        items = list(target_configs)
        if not items:
            return []
        if all(isinstance(x, str) for x in items):
            return [(x, DEFAULT_TARGETS[x]) for x in items]
        if all(isinstance(x, TargetConfig) for x in items):
            return [(x.target_name, x) for x in items]
        kinds = {type(x).__name__ for x in items}
        if kinds <= {"str", "TargetConfig"}:
            raise TypeError("Mixed types in target_configs list: all str or all TargetConfig")
        raise TypeError(f"Unsupported element type(s) in target_configs: {sorted(kinds)}")
    raise TypeError(f"Unsupported target_configs type: {type(target_configs)}")
