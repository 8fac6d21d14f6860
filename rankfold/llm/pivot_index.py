"""Embedding near-duplicates through a pivot-permutation index.

A vector is described by its ``nearest`` most similar pivots.  Inverted lists from pivot to vector retrieve the
pairs that share at least ``shared`` pivots: as two such vectors must meet in the lists of their
``nearest - shared + 1`` rarest pivots, only those lists are built.  Retrieved pairs are verified by the cosine of
the full vectors in double precision.

A list is read in blocks of ``block_rows`` vectors, every two blocks in a group of their own, so a list that
holds a third of all vectors is many small groups.  A pair counts in the first list that it shares, so no
pairs are shuffled: a group returns the number of links of each vector and a spanning forest of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm.common import checkpoint, components, hash_sample

#: Pivots of one dimension and their order, rarest first.
Pivots = dict[int, np.ndarray]


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def choose_pivots(classes: DataFrame, pivots: int, sample: int, apart: float) -> Pivots:
    """Pivots of each dimension from at most ``sample`` distinct vectors, chosen by their hash (a bound on what the driver sees).

    A vector closer than ``apart`` to a chosen pivot is passed over, so a large group of near copies gives one
    pivot; if the sample runs out, seeded random directions fill up.  Pivots are ordered by how few
    sample vectors have them among their nearest.
    """
    rows = hash_sample(classes, F.col("d1"), sample).orderBy("d1", "d2").limit(sample).select("embedding").collect()
    by_size: dict[int, list] = {}
    for row in rows:
        by_size.setdefault(len(row[0]), []).append(row[0])
    out = {}
    for size, vectors in by_size.items():
        seen = unit(np.array(vectors, np.float64))
        chosen: list[np.ndarray] = []
        for v in seen:
            if len(chosen) < pivots and (not chosen or (np.array(chosen) @ v).max() < apart):
                chosen.append(v)
        if more := pivots - len(chosen):
            chosen += list(unit(np.random.default_rng(size).standard_normal((more, size))))
        table = np.array(chosen)
        near = np.argsort(-(seen @ table.T), axis=1, kind="stable")[:, :8]
        out[size] = table[np.argsort(np.bincount(near.ravel(), minlength=len(table)), kind="stable")]
    return out


def nearest_pivots(vectors: np.ndarray, table: np.ndarray, nearest: int) -> np.ndarray:
    """Indices of each vector's nearest pivots in ascending order, that is rarest first."""
    likeness = unit(vectors) @ table.T
    top = np.argpartition(-likeness, min(nearest, likeness.shape[1]) - 1, axis=1)[:, :nearest]
    return np.sort(top, axis=1)


def block_links(one: tuple, two: tuple | None, pivot: int, lists: int, shared: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """``(x, y)`` of the linked rows of two blocks (or of one with itself) whose first shared list is ``pivot``."""
    (u, p), (v, q) = one, two or one
    x, y = np.nonzero(u @ v.T >= cosine)
    if two is None:
        x, y = x[x < y], y[x < y]
    keep = np.zeros(len(x), bool)
    for s in range(0, len(x), 1 << 17):
        a, b = p[x[s : s + (1 << 17)]], q[y[s : s + (1 << 17)]]
        same = a[:, :, None] == b[:, None, :]
        first = np.where(same[:, :lists, :lists].any(2), a[:, :lists], np.iinfo(np.int64).max).min(1)
        keep[s : s + (1 << 17)] = (same.sum((1, 2)) >= shared) & (first == pivot)
    return x[keep], y[keep]


def forest(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """The least row that each of ``n`` rows is connected with."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, x, label[y])
        np.minimum.at(low, y, label[x])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.9,
    pivots: int = 512,
    nearest: int = 10,
    shared: int = 2,
    sample: int = 4096,
    apart: float = 0.6,
    block_rows: int = 1024,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors`` (``vec_id, embedding``).

    Linked are retrieved pairs with ``cosine`` or more; equal vectors always are.  A null or zero vector, or one
    with a null or non-finite component, links with nothing and is its own component; vectors of different
    length link with each other neither.  ``component_id`` is the least vec_id reachable.  Repeated rows count as
    rows; an empty table gives an empty result.
    """
    e = F.col("embedding")
    largest = F.array_max(F.transform(e, lambda v: F.abs(v)))
    whole = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    good = F.coalesce(whole & (F.size(e) > 0) & (largest > 0), F.lit(False))
    same = F.transform(e, lambda v: v + F.lit(0).cast(vectors.schema["embedding"].dataType.elementType))
    rows = vectors.select("vec_id", same.alias("embedding"), good.alias("good"))
    rows = rows.withColumns({"d1": F.xxhash64("embedding"), "d2": F.xxhash64("embedding", F.lit(1))})
    classes = rows.where("good").groupBy("d1", "d2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("embedding").alias("embedding"))
    classes = checkpoint(classes.withColumn("cid", F.monotonically_increasing_id()))
    tables = choose_pivots(classes, pivots, sample, apart)
    lists = nearest - shared + 1

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, flat = batch.column(1).offsets.to_numpy(), batch.column(1).flatten().to_numpy().astype(np.float64)
            sizes, ends = np.diff(ends), ends - ends[0]
            near = np.zeros((batch.num_rows, nearest), np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                table = tables.get(int(size))
                if table is None:
                    table = unit(np.random.default_rng(int(size)).standard_normal((pivots, int(size))))
                near[at] = nearest_pivots(flat[ends[at][:, None] + np.arange(size)], table, nearest)
            made = pa.ListArray.from_arrays(np.arange(0, near.size + 1, nearest, dtype=np.int32), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), made], ["cid", "near"])

    near = classes.select("cid", "embedding").mapInArrow(describe, "cid long, near array<long>")
    described = checkpoint(classes.select("cid", "n", "embedding").join(near, "cid"))
    posted = described.select("cid", "n", "embedding", "near", F.size("embedding").alias("size"), F.explode(F.slice("near", 1, lists)).alias("pivot"))
    counts = posted.groupBy("size", "pivot").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("parts"), F.count("*").alias("c")).where("c > 1").drop("c")
    dealt = posted.join(counts, ["size", "pivot"]).withColumn("mine", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("size", "pivot", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "cid", "n", "near", "embedding")
    dealt = dealt.repartition("size", "pivot", "i", "j").sortWithinPartitions("size", "pivot", "i", "j")

    def links(key: tuple, ids: np.ndarray, n: np.ndarray, mine: np.ndarray, near: np.ndarray, flat: np.ndarray) -> list[pa.RecordBatch]:
        u = unit(flat)
        one = np.flatnonzero(mine == key[2])
        two = one if key[2] == key[3] else np.flatnonzero(mine == key[3])
        if not len(one) or not len(two):
            return []
        x, y = block_links((u[one], near[one]), None if two is one else (u[two], near[two]), key[1], lists, shared, cosine)
        x, y = one[x], two[y]
        if not len(x):
            return []
        found = np.bincount(x, n[y], len(ids)) + np.bincount(y, n[x], len(ids))
        low = forest(x, y, len(ids))
        rows = np.flatnonzero(found)
        return [pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(ids[low[rows]]), pa.array(found[rows].astype(np.int64))], ["a", "b", "n"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("size", "pivot", "i", "j")], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for s, t in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                part = batch.slice(int(s), int(t - s))
                if part.num_rows and (mine := tuple(keys[s].tolist())) != key:
                    yield from group(key, held)
                    key, held = mine, []
                held.append(part)
        yield from group(key, held)

    def group(key: tuple | None, held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        if key is None or not held:
            return []
        table = pa.Table.from_batches(held).combine_chunks()
        column = lambda c: table.column(c).combine_chunks()
        flat = column("embedding").flatten().to_numpy().astype(np.float64).reshape(-1, key[0])
        return links(key, column("cid").to_numpy(), column("n").to_numpy(), column("mine").to_numpy(), column("near").flatten().to_numpy().reshape(-1, nearest), flat)

    found = checkpoint(dealt.mapInArrow(run, "a long, b long, n long"))
    counted = found.groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("links"))
    label = components(found.select("a", "b")).toDF("cid", "label")
    done = classes.select("cid", "d1", "d2", "rep", "n").join(label, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    least = done.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_class = done.join(least, "label").join(counted, "cid", "left")
    of_class = of_class.select("d1", "d2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    plain = rows.where("good").select("vec_id", "d1", "d2").join(of_class, ["d1", "d2"]).select("vec_id", "n_links", "component_id")
    lone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return plain.union(lone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
