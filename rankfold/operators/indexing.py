"""Dense global row numbers over a total order without an un-partitioned window.

``repartitionByRange`` + ``sortWithinPartitions`` gives globally ordered
partitions; the result is checkpointed into the shared checkpoint folder so a
recompute (executor loss) cannot re-sample different range bounds.  Then
``monotonically_increasing_id`` yields (partition, local index); partition
sizes (one row per partition) give the offsets, which are joined back with a
broadcast whose size is the partition count.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.session import reliable_checkpoint

_LOW_BITS = (1 << 33) - 1


def with_global_index(df: DataFrame, order_cols: Sequence[str], index_col: str = "row_index",
                      num_partitions: Optional[int] = None) -> DataFrame:
    """Add a 0-based dense ``index_col`` following ``order_cols`` (which must be
    a unique key for a deterministic index)."""
    # Without an explicit count AQE may coalesce the range partitions to the
    # data size; numbering happens after the checkpoint, so any layout works.
    ordered = (df.repartitionByRange(num_partitions, *order_cols) if num_partitions
               else df.repartitionByRange(*order_cols)).sortWithinPartitions(*order_cols)
    return _numbered(reliable_checkpoint(ordered), index_col)


def _numbered(stored: DataFrame, index_col: str) -> DataFrame:
    """A checkpointed frame with the rows numbered where they lie."""
    tagged = stored.withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumns({"_pid": F.shiftright("_mid", 33), "_local": F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))})
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per partition: the window over it is tiny
    offsets = sizes.select("_pid", (F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt")).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(index_col, F.col("_off") + F.col("_local")).drop("_mid", "_pid", "_local", "_off")


def key_at(df: DataFrame, order_cols: Sequence[str], index: int, num_partitions: Optional[int] = None):
    """The order columns of the row at ``index`` of the total order, or None; only the keys are sorted."""
    idx = with_global_index(df.select(*order_cols), order_cols, "_gidx", num_partitions)
    return idx.where(F.col("_gidx") == F.lit(int(index))).select(*order_cols).first()


def first_n(df: DataFrame, order_cols: Sequence[str], n: int, num_partitions: Optional[int] = None) -> DataFrame:
    """The first ``n`` rows in ``order_cols`` order: the key of the first row outside is looked up, then the
    full rows are filtered by it where they lie.  Of rows that tie with it as many come out as are missing."""
    idx = with_global_index(df.select(*order_cols), order_cols, "_gidx", num_partitions)
    ends = {r["_gidx"]: r[:-1] for r in idx.where(F.col("_gidx").isin(int(n) - 1, int(n))).select(*order_cols, "_gidx").collect()}
    if n not in ends:
        return df
    schema = df.select(*order_cols).schema
    last = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(ends[n], schema.fields)])
    below = df.where(F.struct(*order_cols) < last)
    if n - 1 not in ends or not all(a == b or (a != a and b != b) for a, b in zip(ends[n - 1], ends[n])):
        return below
    tied = _numbered(reliable_checkpoint(df.where(F.struct(*order_cols).eqNullSafe(last))), "_gidx")
    return below.union(tied.where(F.col("_gidx") < F.lit(n - below.count())).select(*df.columns))
