"""Spark session helpers.

Library code never creates machine-local scratch space: lineage is cut with
``DataFrame.checkpoint()`` into the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (tests, local runs)
do we set one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
}


def get_spark(master: str | None = None, app: str = "rankfold", **conf: str) -> SparkSession:
    """Return the active session or build a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = dict(_LOCAL_CONF)
    merged.update(conf)
    for k, v in merged.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def written(df):
    """``df`` as a Parquet table of the shared checkpoint folder: read by column as often as needed, and no executor's loss undoes it."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a task orders at a time where a large table is dealt by key.
TASK_ROWS = 1_000_000
#: Tasks up to which rows are dealt as they come (Spark's default of spark.shuffle.sort.bypassMergeThreshold); for more the
#: dealing task first holds its rows to sort them by task, and spills them when it has read many.
UNSORTED_TASKS = 200


def tasks_for(spark, rows: int) -> int | None:
    """Number of tasks for ``rows`` rows; None while the session's shuffle partitions are enough for them.

    A task has up to a quarter more rows than ``TASK_ROWS`` where that keeps to ``UNSORTED_TASKS``."""
    tasks = -(-int(rows) // TASK_ROWS)
    if UNSORTED_TASKS < tasks <= UNSORTED_TASKS * 5 // 4:
        tasks = UNSORTED_TASKS
    return tasks if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def dealt(df, rows: int, *keys: str):
    """``df``, of about ``rows`` rows, dealt by ``keys`` over tasks whose number grows with the rows."""
    tasks = tasks_for(df.sparkSession, rows)
    return df.repartition(tasks, *keys) if tasks else df.repartition(*keys)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """What an execution inside shuffles is deleted when it ends, as nothing reads it again; else it stays on the disks until
    the driver's garbage collection finds it."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        # one process with threads only; several executors need a folder that all of them see
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = os.environ.get("RANKFOLD_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="rankfold-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def reliable_checkpoint(df):
    """Materialise ``df`` into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
