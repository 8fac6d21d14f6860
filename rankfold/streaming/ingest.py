"""Incremental ingest of impression NDJSON files with Structured Streaming.

New files landing in ``source_dir`` are read with the explicit raw schema,
normalised (text scores and feature values -> doubles), optionally cut to an
evaluation slice, and appended to a Parquet table partitioned by a column of
the caller's choice.  Progress lives in ``checkpoint_location`` (a shared
path), so a restarted or failed job neither loses nor duplicates files.
``available_now=True`` processes the current backlog and stops (a
scheduled batch job); ``False`` keeps running.
"""

from __future__ import annotations

from typing import Iterable, Optional

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from rankfold.operators.metrics import eval_slice
from rankfold.sources.extracts import RAW_SCHEMA, normalize_raw


def ingest_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_location: str,
                  nav_screen: Optional[str] = None, platforms: Optional[Iterable[str]] = None,
                  formula_path: Optional[str] = None, partition_by: Optional[str] = None,
                  max_files_per_trigger: Optional[int] = None, available_now: bool = True) -> StreamingQuery:
    reader = spark.readStream.schema(RAW_SCHEMA).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = normalize_raw(reader.json(source_dir))
    stream = eval_slice(stream, nav_screen, platforms, formula_path)
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", sink_dir).option("checkpointLocation", checkpoint_location))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
