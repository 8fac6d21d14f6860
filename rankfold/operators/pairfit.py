"""Pairwise-logit fit of linear rankers over sessions (R1, R2), several at a time.

The loss of a pair (winner i, loser j) with weight p is ``p * log(1 + exp(-(s_i - s_j)))`` with ``s = x . beta``.  Its gradient
is a sum over rows, not pairs: each pair adds one number to the weight of its winner and takes it from that of its loser, and the
row's vector is multiplied once by the sum.  So no pair has a vector, and no pair is stored.  A table of session
blocks holds the rows; a pass over it forms the pairs of a session as matrices, for all fits at once, and returns their
losses and gradients, summed by Spark.  L-BFGS steps on the driver see only those.

A session of more than ``BLOCK_ROWS`` rows has several blocks.  Scores and targets of its blocks (no vectors) meet in a join by
pairs of blocks, the row weights are summed by block, and each block's vectors are multiplied by them, so a
hot session is spread over as many tasks as it has pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.config import BIG_NEGATIVE, GRADED_TARGET_NAMES, MIN_PAIR_WEIGHT, Cols
from rankfold.operators.sessions import whole_sessions
from rankfold.session import dealt, written

BLOCK_ROWS = 2048
#: Cells of the pair matrices that a task works on at a time.
CELLS = 1 << 21


@dataclass
class Fit:
    """A fitted ranker: coefficients, objective value, greatest standardised gradient entry, number of pairs, passes made."""

    coefficients: list[float]
    loss: float
    residual: float
    n_pairs: int
    passes: int


def session_blocks(features: DataFrame, block_rows: int = BLOCK_ROWS, session_col: str = Cols.RID) -> DataFrame:
    """``rid, block, blocks, x, t``: the vectors and graded targets of up to about ``block_rows`` rows of a session, one behind the other.

    ``features`` has ``features`` and ``targets`` as :func:`feature_table` gives them.  Missing vector entries count as 0.  Rows
    without a session are left out, as they form no pairs.
    """
    rows = features.where(F.col(session_col).isNotNull()).select(
        F.col(session_col).alias("rid"), F.col(Cols.POS).alias("pos"), F.col("features").alias("x"),
        F.col("targets").getField("target").cast("array<double>").alias("t"))
    rows = written(rows)  # read for the sizes of the sessions and for their blocks
    # only sessions of several blocks: at most rows / block_rows of them; the planner broadcasts them while they are few
    large = rows.groupBy("rid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_rows)
    large = large.select("rid", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
    if large.count():
        parts = rows.join(large, "rid", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        parts = parts.withColumn("block", F.pmod(F.xxhash64("pos", "x", "t"), F.col("blocks")).cast("int"))
    else:  # nothing to join
        parts = rows.select("*", F.lit(1).alias("blocks"), F.lit(0).alias("block"))
    parts = dealt(parts.select("rid", "block", "blocks", "pos", "x", "t"), rows.count(), "rid", "block")
    key = rows.schema["rid"].dataType.simpleString()
    return parts.sortWithinPartitions("rid", "block", "pos", "x", "t").mapInArrow(_pack, f"rid {key}, block int, blocks int, x array<double>, t array<double>")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block: its rows' vectors and targets one behind the other."""
    for batch, starts in whole_sessions(batches, 2):
        lists = []
        for column in (batch.column(4), batch.column(5)):
            ends = column.offsets.to_numpy()[np.append(starts, batch.num_rows)]
            values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            if not lists:
                values = np.where(np.isnan(values) | (values <= BIG_NEGATIVE / 2), 0.0, values)
            lists.append(pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), pa.array(values)))
        keys = [batch.column(k).take(pa.array(starts)) for k in range(3)]
        yield pa.RecordBatch.from_arrays([*keys, *lists], ["rid", "block", "blocks", "x", "t"])


def _flat(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column as ``(rows, width)``, and the number of rows of each list."""
    sizes = np.diff(column.offsets.to_numpy()) // max(width, 1)
    return np.nan_to_num(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), nan=np.nan).reshape(-1, max(width, 1)), sizes


def _pairs(ti: np.ndarray, tj: np.ndarray, weights: np.ndarray, least: float) -> np.ndarray:
    """Weights of i as winner over j, summed over the targets (last axis), and how many of them count, as ``(2, ..., i, j)``."""
    total, many = 0.0, 0
    for k, w in enumerate(weights):
        gap = ti[..., :, None, k] - tj[..., None, :, k]
        with np.errstate(invalid="ignore"):
            counts = (gap > 0) & (np.abs(w * gap) >= least)
        total = total + np.where(counts, w * gap, 0.0)
        many = many + counts
    return np.stack([total, many])


def _loss(si: np.ndarray, sj: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss of each pair and its derivative by the winner's score."""
    d = si[..., :, None] - sj[..., None, :]
    e = np.exp(-np.abs(d))
    return w * (np.log1p(e) + np.maximum(-d, 0.0)), -w * np.where(d >= 0, e, 1.0) / (1.0 + e)


#: Numbers that tasks may send to the driver at once; beyond, Spark adds them up first.
DRIVER_NUMBERS = 1 << 20


def _summed(parts: DataFrame, size: int, tasks: int | None = None) -> np.ndarray:
    """Sum of the vectors that tasks give as rows ``i, v``; ``tasks`` is the number of them, where it is known."""
    if tasks is None or tasks * size > DRIVER_NUMBERS:
        parts = parts.groupBy("i").agg(F.sum("v").alias("v"))
    table = parts.toArrow()
    return np.bincount(table.column("i").to_numpy(), table.column("v").to_numpy(), size)


def _rows(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total.ravel()[at])], ["i", "v"])


def _moments(blocks: DataFrame, width: int) -> tuple[np.ndarray, bool]:
    """Population standard deviation of each vector entry (1 where it is constant), and whether a session has several blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * width + 2)
        for batch in batches:
            x, sizes = _flat(batch.column(0), width)
            total[:width] += x.sum(0)
            total[width : 2 * width] += (x * x).sum(0)
            total[-2] += len(x)
            total[-1] += np.count_nonzero(batch.column(1).to_numpy() > 1)
        yield _rows(total)

    total = _summed(blocks.select("x", "blocks").mapInArrow(run, "i int, v double"), 2 * width + 2)
    n = max(total[-2], 1.0)
    variance = total[width : 2 * width] / n - (total[:width] / n) ** 2
    return np.where(variance > 1e-12 * np.maximum(total[width : 2 * width] / n, 1e-300), np.sqrt(np.maximum(variance, 0.0)), 1.0), total[-1] > 0


def _add_pairs(rows: np.ndarray, left: np.ndarray, right: np.ndarray, s: np.ndarray, t: np.ndarray, weights: np.ndarray, least: float,
               total: np.ndarray, g: np.ndarray) -> None:
    """Add to ``total`` and to the row weights ``g`` what the places ``left`` and ``right`` of each session give with each other, the
    winner being either of them; ``rows`` has a line for each session, its rows.

    With p and q the weights of a over b and of b over a, and d the difference of their scores, the loss of both is
    ``(p + q) * log(1 + exp(-d)) + q * d``, so each two rows are looked at once.
    """
    a, b = rows[:, left], rows[:, right]
    place = np.arange(rows.size).reshape(rows.shape)
    place_a, place_b = place[:, left].ravel(), place[:, right].ravel()
    with np.errstate(invalid="ignore"):
        gaps = [t[a, k] - t[b, k] for k in range(t.shape[1])]
    sizes = [np.abs(gap) for gap in gaps]
    for f in range(len(weights)):
        both, back = np.zeros(a.shape), np.zeros(a.shape)
        for w, gap, size in zip(weights[f], gaps, sizes, strict=True):
            p = w * size
            with np.errstate(invalid="ignore"):
                counts = (size > 0) & (np.abs(p) >= least)
            p = np.where(counts, p, 0.0)
            both += p
            back += np.where(gap < 0, p, 0.0)
            total[f, 2] += np.count_nonzero(counts)
        d = s[a, f] - s[b, f]
        e = np.exp(-np.abs(d))
        total[f, 0] += (both * (np.log1p(e) + np.maximum(-d, 0.0)) + back * d).sum()
        total[f, 1] += both.sum()
        slope = (back - both * np.where(d >= 0, e, 1.0) / (1.0 + e)).ravel()
        g[f, rows] += (np.bincount(place_a, slope, rows.size) - np.bincount(place_b, slope, rows.size)).reshape(rows.shape)


def _one_block_pass(blocks: DataFrame, beta: np.ndarray, weights: np.ndarray, least: float) -> DataFrame:
    """Rows ``i, v`` of ``(fits, 3 + width)``: loss, weight, pairs and gradient of the sessions of one block."""
    fits, width, kinds = len(beta), beta.shape[1], weights.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((fits, 3 + width))
        for batch in batches:
            x, sizes = _flat(batch.column(0), width)
            t, _ = _flat(batch.column(1), kinds)
            starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
            g = np.zeros((fits, len(x)))
            s = x @ beta.T
            for n in np.unique(sizes[sizes > 1]):
                same = starts[sizes == n]
                i, j = np.triu_indices(n, 1)
                # a session of many rows has its pairs one stretch at a time
                for part in range(0, len(i), CELLS):
                    left, right = i[part : part + CELLS], j[part : part + CELLS]
                    step = max(1, CELLS // len(left))
                    for k in range(0, len(same), step):
                        _add_pairs(same[k : k + step, None] + np.arange(n), left, right, s, t, weights, least, total, g)
            total[:, 3:] += g @ x
        yield _rows(total)

    return blocks.where("blocks = 1").select("x", "t").mapInArrow(run, "i int, v double")


def _many_block_pass(blocks: DataFrame, beta: np.ndarray, weights: np.ndarray, least: float) -> DataFrame:
    """As :func:`_one_block_pass`, for the sessions of several blocks."""
    fits, width, kinds = len(beta), beta.shape[1], weights.shape[1]
    key = blocks.schema["rid"].dataType.simpleString()
    many = blocks.where("blocks > 1")

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, sizes = _flat(batch.column(2), width)
            ends = np.concatenate(([0], np.cumsum(sizes))) * fits
            s = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((x @ beta.T).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), s, batch.column(3)], ["rid", "block", "s", "t"])

    scored = many.select("rid", "block", "x", "t").mapInArrow(scores, f"rid {key}, block int, s array<double>, t array<double>")
    a, b = scored.alias("a"), scored.alias("b")
    units = a.join(b, (F.col("a.rid") == F.col("b.rid")) & (F.col("a.block") <= F.col("b.block")))
    units = units.select(F.col("a.rid").alias("rid"), F.col("a.block").alias("a"), F.col("b.block").alias("b"), "a.s", "a.t", F.col("b.s").alias("s2"), F.col("b.t").alias("t2"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (s, n), (t, _), (s2, n2), (t2, _) = (_flat(batch.column(k), w) for k, w in ((3, fits), (4, kinds), (5, fits), (6, kinds)))
            alone = batch.column(1).to_numpy() == batch.column(2).to_numpy()
            first, first2 = np.cumsum(n) - n, np.cumsum(n2) - n2
            ga, gb, head = np.zeros((len(s), fits)), np.zeros((len(s2), fits)), np.zeros((batch.num_rows, fits, 3))
            # units of equal shape together, and of a large one some rows at a time
            for rows, rows2, one in sorted(set(zip(n.tolist(), n2.tolist(), alone.tolist()))):
                same = np.flatnonzero((n == rows) & (n2 == rows2) & (alone == one))
                step, many_rows = max(1, CELLS // max(rows * rows2, 1)), max(1, CELLS // max(rows2, 1))
                for u in (same[k : k + step] for k in range(0, len(same), step)):
                    right = first2[u, None] + np.arange(rows2)
                    for k in range(0, rows, many_rows):
                        left = first[u, None] + np.arange(k, min(k + many_rows, rows))
                        for f in range(fits):
                            sides = ((s, t, left, ga, s2, t2, right, gb), (s2, t2, right, gb, s, t, left, ga))
                            for si, ti, i, gi, sj, tj, j, gj in sides[: 1 if one else 2]:
                                w, counts = _pairs(ti[i], tj[j], weights[f], least)
                                loss, slope = _loss(si[i, f], sj[j, f], w)
                                head[u, f] += np.stack([loss.sum((1, 2)), w.sum((1, 2)), counts.sum((1, 2))], 1)
                                gi[i, f] += slope.sum(2)
                                gj[j, f] -= slope.sum(1)
                if one:  # both sides are the same rows
                    left, right = first[same, None] + np.arange(rows), first2[same, None] + np.arange(rows)
                    ga[left] += gb[right]

            def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(values.ravel()))

            names, sums = ["rid", "block", "g", "h"], lists(head, np.full(batch.num_rows, 3 * fits))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists(ga, n * fits), sums], names)
            none = lists(np.zeros(head.size), np.full(batch.num_rows, 3 * fits))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists(gb, n2 * fits), none], names).filter(pa.array(~alone))

    weighed = units.mapInArrow(meet, f"rid {key}, block int, g array<double>, h array<double>")

    sums = weighed.groupBy("rid", "block").agg(F.collect_list("g").alias("g"), F.collect_list("h").alias("h"))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The vectors of each block by the sum of its row weights over the units it was in."""
        total = np.zeros((fits, 3 + width))
        for batch in batches:
            x, n = _flat(batch.column(0), width)
            units = batch.column(1).value_lengths().to_numpy()  # lists of row weights of each block
            start, size = np.repeat((np.cumsum(n) - n) * fits, units), np.repeat(n * fits, units)
            place = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
            g = np.bincount(place, batch.column(1).flatten().flatten().to_numpy(), len(x) * fits).reshape(-1, fits)
            total[:, :3] += batch.column(2).flatten().flatten().to_numpy().reshape(-1, fits, 3).sum(0)
            total[:, 3:] += g.T @ x
        yield _rows(total)

    return many.join(sums, ["rid", "block"]).select("x", "g", "h").mapInArrow(multiply, "i int, v double")


def losses(blocks: DataFrame, beta: np.ndarray, weights: np.ndarray, several: bool, least: float = MIN_PAIR_WEIGHT, tasks: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each fit (row of ``beta`` and ``weights``): summed loss, summed pair weight, number of pairs, and the gradient of the loss."""
    beta, weights = np.atleast_2d(np.asarray(beta, float)), np.atleast_2d(np.asarray(weights, float))
    parts = _one_block_pass(blocks, beta, weights, least)
    if several:
        parts = parts.union(_many_block_pass(blocks, beta, weights, least))
    total = _summed(parts, beta.size + 3 * len(beta), None if several else tasks).reshape(len(beta), -1)
    return total[:, 0], total[:, 1], total[:, 2].astype(int), total[:, 3:]


def _direction(gradient: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Two-loop recursion of L-BFGS over the last ``(step, change of gradient)``."""
    q, rates = gradient.copy(), []
    for s, y in reversed(steps):
        rates.append((s @ q) / (s @ y))
        q -= rates[-1] * y
    if steps:
        s, y = steps[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), rate in zip(steps, reversed(rates), strict=True):
        q += (rate - (y @ q) / (s @ y)) * s
    return -q


def fit_rankers(blocks: DataFrame, weights: Sequence[Sequence[float]], width: int, max_iter: int = 150, reg_param: float = 1e-3,
                tol: float = 1e-6, memory: int = 10) -> list[Fit]:
    """One :class:`Fit` for each row of ``weights`` (a weight per target); all are fitted in the same passes over ``blocks``.

    The objective is the mean weighted loss plus ``reg_param / 2 * sum (sd_j * beta_j)**2``, with the standard deviation of entry j
    over the rows.  A fit ends when its standardised gradient is at most ``tol`` everywhere; ``max_iter`` bounds the passes.  Every pass
    reads ``blocks``, so keep it (a written or persisted table) before the call.  No pairs, or no vector entries: zero coefficients.
    """
    weights = np.asarray(weights, float).reshape(-1, len(GRADED_TARGET_NAMES))
    k = len(weights)
    if not width:
        return [Fit([], 0.0, 0.0, 0, 0) for _ in range(k)]
    scale, several = _moments(blocks, width)
    tasks = blocks.rdd.getNumPartitions() if blocks.is_cached else None

    def at(z: np.ndarray, which: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        loss, weight, pairs, slope = losses(blocks, z / scale, weights[which], several, tasks=tasks)
        weight = np.where(weight > 0, weight, 1.0)
        return loss / weight + 0.5 * reg_param * (z * z).sum(1), slope / scale / weight[:, None] + reg_param * z, pairs

    z = np.zeros((k, width))
    value, gradient, pairs = at(z, list(range(k)))
    passes, steps = np.ones(k, int), [[] for _ in range(k)]
    way, rate = np.zeros_like(z), np.zeros(k)
    open_fits = [f for f in range(k) if np.abs(gradient[f]).max() > tol]
    for f in open_fits:
        way[f] = -gradient[f]
        rate[f] = 1.0 / max(1.0, np.linalg.norm(gradient[f]))
    for _ in range(max_iter):
        if not open_fits:
            break
        tried = np.array([z[f] + rate[f] * way[f] for f in open_fits])
        new_value, new_gradient, _ = at(tried, open_fits)
        ended = []
        for i, f in enumerate(open_fits):
            passes[f] += 1
            if not new_value[i] <= value[f] + 1e-4 * rate[f] * (gradient[f] @ way[f]) + 1e-15:
                rate[f] *= 0.5  # too far
                if rate[f] < 1e-12:
                    ended.append(f)
                continue
            s, y = tried[i] - z[f], new_gradient[i] - gradient[f]
            if s @ y > 1e-14 * (y @ y):
                steps[f] = [*steps[f], (s, y)][-memory:]
            z[f], value[f], gradient[f] = tried[i], new_value[i], new_gradient[i]
            if np.abs(gradient[f]).max() <= tol:
                ended.append(f)
            way[f], rate[f] = _direction(gradient[f], steps[f]), 1.0
        open_fits = [f for f in open_fits if f not in ended]
    return [Fit((z[f] / scale).tolist(), float(value[f]), float(np.abs(gradient[f]).max()), int(pairs[f]), int(passes[f])) for f in range(k)]
