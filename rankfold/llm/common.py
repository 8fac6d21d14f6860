"""Helpers that several operators share: checkpoints, connected components, Arrow text chunks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.session import checkpoint_dir

#: A word is a run of bytes other than space and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: str) -> list[str]:
    """The words of ``WORD``, in order."""
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns of these names, in any case, as Spark compares names."""
    away = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in away])


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder of its own only for local sessions without one."""
    return checkpoint_dir(spark)


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read again.

    It survives lost executors, cuts the lineage, and tells the planner its true size.
    """
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a checkpointed table that no later step reads."""
    spark = df.sparkSession
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list: ``(node, component)``, component = smallest node.

    Alternating large-star and small-star rounds.  Every round is one min-aggregate per node
    (combined before the shuffle) and one inner join that AQE can split, so a hub with a third of all
    edges is no single task, and nothing is collected but two numbers per round.  Rounds end when
    the edge list, already a forest of stars, no longer changes.  Nodes without an edge are absent;
    self loops and null ends add no edge.
    """
    pairs = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    pairs, before = checkpoint(pairs), None

    def two(x: str, y: str, s: str, t: str) -> Column:
        return F.inline(F.array(F.struct(F.col(x).alias("u"), F.col(y).alias("v")), F.struct(F.col(s).alias("u"), F.col(t).alias("v"))))

    while True:
        both = pairs.select(two("u", "v", "v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        after = checkpoint(large.join(low, "u").select(two("v", "m", "u", "m")).where("u != v").distinct())
        discard(pairs)
        pairs = after
        now = pairs.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if before is not None and tuple(now) == tuple(before):
            break
        before = now
    return pairs.select(two("u", "v", "v", "v")).toDF("node", "component").distinct()


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a chunk holds about ``limit`` bytes of text, or one longer text."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        _, ends = text_bytes(texts)
        start, n = 0, batch.num_rows
        while start < n:
            stop = int(np.searchsorted(ends, ends[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), n)
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the n + 1 offsets into them (a null text is empty)."""
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    ends = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply-xorshift rounds) over uint64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def hex_unit(digest: Column) -> Column:
    """The first 13 hex digits (52 bits) of a digest as a double strictly between 0 and 1."""
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def share_of(hash64: Column) -> Column:
    """A 64-bit hash as a double in [0, 1)."""
    return F.shiftrightunsigned(hash64, 11).cast("double") / F.lit(float(1 << 53))


def hash_sample(df: DataFrame, hash64: Column, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df``, those whose hash is least: a filter in every task, not a sort of them all."""
    n = df.count()
    return df.where(share_of(hash64) < F.lit(min(1.0, rows / max(n, 1))))
