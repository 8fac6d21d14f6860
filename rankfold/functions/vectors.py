"""Sparse ``[[id, value], ...]`` lists to dense ``array<float>``
and the tab-separated text form (X6, X7).

Dense vectors are made by an Arrow function that works on the list buffers of a whole batch of rows; the rest are
higher-order functions."""

from __future__ import annotations

from typing import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from rankfold.config import BIG_NEGATIVE, Cols


def _valid_pairs(features: str | Column) -> Column:
    """Pairs with >= 2 entries, a numeric id and a non-NULL value."""
    col = F.col(features) if isinstance(features, str) else features
    return F.filter(col, lambda f: (F.size(f) >= 2)
                    & F.get(f, 0).try_cast("double").isNotNull()
                    & F.get(f, 1).try_cast("double").isNotNull())


def feature_map(features: str | Column = Cols.FEATURES, round_digits: int | None = 8) -> Column:
    """``map<int, double>`` of the valid pairs.  Ids are truncated to int
    like ``int(x)``; for a repeated id the last pair wins: entries are sorted
    by (id, position) and only the last entry of each id run is kept, so the
    map never sees a duplicate key (O(L log L) per row, no session setting)."""
    def entry(f, i):
        v = F.get(f, 1).try_cast("double")
        if round_digits is not None:
            v = F.round(v, round_digits)
        return F.struct(F.get(f, 0).try_cast("double").try_cast("int").alias("k"), i.alias("i"), v.alias("v"))
    entries = F.filter(F.transform(_valid_pairs(features), entry), lambda e: e["k"].isNotNull())
    srt = F.array_sort(entries)
    nxt = F.slice(srt, 2, F.greatest(F.size(srt) - 1, F.lit(0)))
    last = F.zip_with(srt, nxt, lambda a, b: F.when(b.isNull() | (b["k"] != a["k"]), a))
    kept = F.filter(last, lambda e: e.isNotNull())
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v"))))


def _numbers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of an array and which of them are there; text that is no number is missing, as with ``try_cast``."""
    if pa.types.is_null(values.type):
        return np.zeros(len(values)), np.zeros(len(values), bool)
    if not (pa.types.is_floating(values.type) or pa.types.is_integer(values.type)):
        def number(v):
            try:
                return float(v)
            except (TypeError, ValueError):
                return None
        values = pa.array([number(v) for v in values.to_pylist()], pa.float64())
    there = values.is_valid().to_numpy(zero_copy_only=False)
    return values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64), there


def scatter(features: pa.Array, vocab: Sequence[int], default: float, round_digits: int | None) -> pa.Array:
    """The dense vectors of a batch of ``[[id, value], ...]`` lists.

    Ids are truncated to integers and looked up in the sorted vocabulary, all pairs of the batch at once; what is found is
    written to its place, later pairs over earlier ones.  Values are rounded half away from zero.
    """
    n, width = len(features), len(vocab)
    rows = np.repeat(np.arange(n), features.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    pairs = features.flatten()
    sizes = pairs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat, there = _numbers(pairs.flatten())
    starts = np.cumsum(sizes) - sizes
    at = np.flatnonzero(sizes >= 2)
    at = at[there[starts[at]] & there[starts[at] + 1]]
    ids, values = flat[starts[at]], flat[starts[at] + 1]
    order = np.argsort(vocab, kind="stable")
    known = np.asarray(vocab, np.float64)[order]
    whole = np.trunc(ids)  # NaN and infinite ids are found nowhere
    place = np.minimum(np.searchsorted(known, whole), width - 1)
    hit = known[place] == whole
    values = values[hit]
    if round_digits is not None:
        unit = 10.0**round_digits
        small = np.abs(values) < 2.0**52 / unit
        values = np.where(small, np.copysign(np.floor(np.abs(values) * unit + 0.5) / unit, values), values)
    out = np.full(n * width, default, np.float32)
    with np.errstate(over="ignore"):
        out[rows[at[hit]] * width + order[place[hit]]] = values.astype(np.float32)
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(out))


def dense_vector(features: str | Column, vocab: Sequence[int], default: float = BIG_NEGATIVE,
                 round_digits: int | None = 8) -> Column:
    """``array<float>`` in vocabulary order; missing ids -> ``default``;
    for a repeated id the last pair wins.

    One :func:`scatter` per Arrow batch: O(L log V) per row of L pairs.
    """
    vocab = [int(i) for i in vocab]
    if len(set(vocab)) != len(vocab):
        raise ValueError("vocabulary ids must be unique (one position per id)")
    if not vocab:
        return F.array().cast("array<float>")

    @F.arrow_udf("array<float>")
    def dense(batch: pa.Array) -> pa.Array:
        return scatter(batch, vocab, default, round_digits)

    return dense(F.col(features) if isinstance(features, str) else features)


def index_vector(features: str | Column, num_features: int) -> Column:
    """B1: dense by raw id, 0 <= id < n, default 0.0, no rounding."""
    return dense_vector(features, list(range(num_features)), default=0.0, round_digits=None)


def vector_to_text(label: str | Column, features: str | Column) -> Column:
    """``label \\t 1 \\t f0 \\t f1 ...``; shortest round-trip decimal text."""
    lab = F.col(label) if isinstance(label, str) else label
    feats = F.col(features) if isinstance(features, str) else features
    return F.concat_ws("\t", lab.cast("string"), F.lit("1"),
                       F.array_join(F.transform(feats, lambda x: x.cast("string")), "\t"))


def text_to_vector(value: str | Column, n_features: int) -> Column:
    """Drop the first two fields; unparsable -> NaN; pad with 0.0 to ``n``;
    rows with fewer than three fields -> all 0.0."""
    v = F.col(value) if isinstance(value, str) else value
    parts = F.split(v, "\t")
    body = F.slice(parts, 3, n_features)
    parsed = F.transform(body, lambda x: F.coalesce(x.try_cast("float"), F.lit(float("nan")).cast("float")))
    pad = F.array_repeat(F.lit(0.0).cast("float"), F.greatest(F.lit(n_features) - F.size(parsed), F.lit(0)))
    return F.when(F.size(parts) < 3, F.array_repeat(F.lit(0.0).cast("float"), n_features)) \
            .otherwise(F.concat(parsed, pad))


def text_width(value: str | Column) -> Column:
    """Number of feature fields in one text row."""
    v = F.col(value) if isinstance(value, str) else value
    return F.size(F.split(v, "\t")) - 2


#: Entries up to which a linear score is written out term by term, which Spark compiles.
UNROLLED = 64


def dot(features: str | Column, coefficients: Sequence[float], value: Callable[[Column], Column] = lambda x: x.cast("double")) -> Column:
    """Linear score: sum_i value(x_i) * c_i, left to right; NULL where a vector has another length."""
    feats = F.col(features) if isinstance(features, str) else features
    if len(coefficients) <= UNROLLED:
        total = F.lit(0.0)
        for i, c in enumerate(coefficients):
            total = total + value(F.get(feats, F.lit(i))) * F.lit(float(c))
        return F.when(F.size(feats) == len(coefficients), total)
    coef = F.array(*[F.lit(float(c)) for c in coefficients])
    return F.aggregate(F.zip_with(feats, coef, lambda x, c: value(x) * c), F.lit(0.0), lambda a, b: a + b)
