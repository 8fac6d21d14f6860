"""Column expressions: everything here returns a ``pyspark.sql.Column``."""

from rankfold.functions.labels import (  # noqa: F401
    has_event, has_event_matching, label_expr, pattern_label_expr, clean_score,
)
from rankfold.functions.targets import (  # noqa: F401
    like_target, dislike_target, consumption_time, label_value, targets_array,
)
