"""rankfold: ranking evaluation and target-weight tuning as Spark DataFrame jobs.

Sub-packages
------------
functions   Column expressions (labels, graded targets, vector helpers).
operators   DataFrame -> DataFrame operators (metrics, pairs, features, matrices,
            ranker, tuning, run logs).
sources     Readers and writers (NDJSON impressions, extracts, name files, run
            logs) and the adapter that derives impressions from the test tables.
plans       End-to-end jobs built from the operators (evaluate, tune, score,
            matrices, extract).
streaming   Incremental ingest of impression files with Structured Streaming.
"""

from rankfold.config import Cols, TargetConfig, DEFAULT_TARGETS  # noqa: F401
from rankfold.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["Cols", "TargetConfig", "DEFAULT_TARGETS", "get_spark", "checkpoint_dir"]

import sys  # noqa: E402

from pyspark import cloudpickle  # noqa: E402

# functions that run in tasks travel with the job, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
