"""Periodic runs of words: maximal stretches that repeat themselves with a smallest period.

Scale-tiled distribution.  A document's words are cut into tiles, one set of overlapping tiles for each octave of
periods ``[P, 2P)``; the first octave has all periods below 2P, with 2P the least length of a run.  Within a tile, every multiple ``b`` of P is a boundary; two Z-functions, forwards and
backwards from ``b``, give how far the words at ``b`` agree with those ``q`` further on, for every q of the octave
in time linear in the octave.  As the words of a run of period q agree with those q further on over at least P words, one of
them is at a boundary, so no run is missed.  A boundary sees a few periods to either side; what it finds there is a fragment.  The
fragments of all tiles are shuffled by document and period, and touching ones are stitched to runs.

A tile is solved by itself.  Those of short documents are solved where the document is read; those of
documents above ``spread_words`` words travel as rows, dealt over all tasks, so no task holds more
than a document's words and its own tiles.  Both go through the same ``tiles`` and ``solve``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from rankfold.llm.common import checkpoint, drop_columns, text_chunks, words_of

#: Agreeing words that the first look at all pairs of an octave follows in each direction.
LOOK = 16

RUNS = "array<struct<start: long, length: long, period: long>>"


def first_octave(shortest: int) -> int:
    return max(1, -(-shortest // 2))


def periods(octave: int, shortest: int) -> tuple[int, int]:
    """The periods that the boundaries at multiples of ``octave`` are for, the upper one exclusive."""
    return (1 if octave == first_octave(shortest) else octave), 2 * octave


def reach(octave: int, shortest: int) -> int:
    """Words that a boundary sees to the left, and beyond ``2 * octave`` to the right."""
    return max(2 * octave, shortest, LOOK)


def tiles(n: int, longest: int, shortest: int, core: int = 1 << 16) -> Iterator[tuple[int, int, int, int, int]]:
    """``(octave, first, last, lo, hi)``: boundaries ``first, first + octave, ..`` below ``last`` and the words ``lo:hi`` they see.

    ``n`` words, of documents of at most ``longest`` words.
    """
    octave = first_octave(shortest)
    while longest >= shortest and 2 * periods(octave, shortest)[0] <= longest:
        wide, step = reach(octave, shortest), max(core // octave, 16) * octave
        for first in range(0, n, step):
            last = min(first + step, n)
            yield octave, first, last, max(0, first - wide), min(n, last + 2 * octave + wide)
        octave *= 2


def z_function(s: list) -> list[int]:
    """For each position the length of the longest common prefix of ``s`` and its rest from there."""
    n, out, left, right = len(s), [0] * len(s), 0, 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = out[i - left]
            if k < right - i:
                out[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if k:
            out[i], left, right = k, i, i + k
    return out


def _primitive(q: int, z: list[int]) -> bool:
    """Whether the first q elements are no power of a shorter block (``z``: the Z-function from their start)."""
    rest, f = q, 2
    while rest > 1:
        if f * f > rest:
            f = rest
        if rest % f == 0:
            if z[q // f] >= q - q // f:
                return False
            while rest % f == 0:
                rest //= f
        f += 1
    return True


def _grams(ids: np.ndarray, shortest: int) -> tuple[np.ndarray, int]:
    """A number for the ``size`` words from each position (those that pass the end: all different), and ``size``.

    An agreement of a run has ``shortest / 2`` words or more, so half of that on one side of its boundary.
    """
    top, size = int(ids.max()) + 1, max(1, -(-shortest // 4))
    while top**size >= 1 << 62:
        size -= 1
    n = len(ids)
    out = ids.astype(np.int64)
    for k in range(1, size):
        out[: n - k] = out[: n - k] * top + ids[k:]
    out[n - size + 1 :] = -1 - np.arange(size - 1)
    return out, size


def _suspects(ids: np.ndarray, octave: int, at: np.ndarray, shortest: int) -> np.ndarray:
    """Boundaries (of ``at``) with a period whose agreement is long enough, or too long to tell after ``LOOK`` words."""
    n, (low, high) = len(ids), periods(octave, shortest)
    grams, size = _grams(ids, shortest)
    rows, columns = [], []
    whole, rest = at[at + 2 * octave <= n], at[at + 2 * octave > n]
    if len(whole):
        view = np.lib.stride_tricks.sliding_window_view(grams, high - low)
        same = view[whole + low] == grams[whole][:, None]
        skip = int(np.searchsorted(whole, size))
        left = whole[skip:] - size
        same[skip:] |= view[left + low] == grams[left][:, None]
        r, c = np.nonzero(same)
        rows.append(whole[r])
        columns.append(c + low)
    for b in rest.tolist():
        c = np.arange(low, n - b + (b > 0))
        rows.append(np.full(len(c), b))
        columns.append(c)
    b, q = np.concatenate([*rows, at[:0]]), np.concatenate([*columns, at[:0]])
    seen, far = np.zeros(len(b), np.int64), np.zeros(len(b), bool)
    for sign in (1, -1):
        active = np.arange(len(b))
        for t in range(LOOK):
            i = b[active] + (t if sign > 0 else -t - 1)
            j = i + q[active]
            inside = (i >= 0) & (j < n)
            active, i, j = active[inside], i[inside], j[inside]
            active = active[ids[i] == ids[j]]
            if not len(active):
                break
            seen[active] += 1
        far[active] = True
    return np.unique(b[far | (seen >= np.maximum(q, shortest - q))])


def solve(ids: np.ndarray, octave: int, first: int, last: int, shortest: int) -> list[tuple[int, int, int]]:
    """``(period, x, y)``, positions in ``ids``: words i in x..y-1 equal words i + period, found from the boundaries first..last-1.

    Only agreements of ``max(period, shortest - period)`` words or more, touching ones of a period already joined; periods
    whose block is a power of a shorter one are left out, as the shorter period has the same run.
    """
    n, wide, (low, high) = len(ids), reach(octave, shortest), periods(octave, shortest)
    found: dict[int, list[list[int]]] = {}
    for b in _suspects(ids, octave, np.arange(first, last, octave), shortest).tolist():
        lo, end, top = max(0, b - wide), min(b + high, n), min(high, n - b + 1)
        window = ids[lo : b + high + wide].tolist()
        ahead = [*z_function(window[b - lo :]), 0]
        # backwards from b: the words before b, then all up to the last that a period leads to
        behind = z_function([*window[: b - lo][::-1], -1, *window[: end - lo][::-1]])
        # word b + q - 1 is at place k - q there
        k = b - lo + 1 + end - b
        for q, f, g in zip(range(low, top), ahead[low:top], behind[k - top + 1 : k - low + 1][::-1]):
            if f + g >= q and f + g >= shortest - q and _primitive(q, ahead):
                parts = found.setdefault(q, [])
                if parts and b - g <= parts[-1][1]:
                    parts[-1][1] = max(parts[-1][1], b + f)
                else:
                    parts.append([b - g, b + f])
    return [(q, x, y) for q, parts in found.items() for x, y in parts]


def word_ids(words: list[str]) -> np.ndarray:
    """Words as numbers, equal words by equal numbers."""
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int32, len(words))


_FRAGMENT = pa.list_(pa.struct([("q", pa.int64()), ("x", pa.int64()), ("y", pa.int64())]))


def _read(docs: DataFrame, shortest: int, spread_words: int) -> DataFrame:
    """``docs`` with words joined by one space, the fragments (null: a long document, or one without any) and whether it is long."""
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            texts, fragments, long, solved, ids = [], [], [], [], []
            for r, text in enumerate(batch.column(at).to_pylist()):
                words = words_of(text) if text is not None else []
                texts.append(" ".join(words) if text is not None else None)
                fragments.append(None)
                long.append(len(words) > spread_words)
                if shortest <= len(words) <= spread_words:
                    solved.append(r)
                    ids.append(word_ids(words))
            # the short documents one behind the other, none with a number of another
            ends = np.cumsum([0, *map(len, ids)])
            above = np.cumsum([0, *(int(x.max()) + 1 for x in ids)])
            line = np.concatenate([x + k for x, k in zip(ids, above)]) if ids else np.zeros(0, np.int64)
            for octave, first, last, lo, hi in tiles(len(line), max(map(len, ids), default=0), shortest):
                for q, x, y in solve(line[lo:hi], octave, first - lo, last - lo, shortest):
                    k = int(np.searchsorted(ends, x + lo, "right")) - 1
                    start = lo - int(ends[k])
                    fragments[solved[k]] = [*(fragments[solved[k]] or ()), {"q": q, "x": x + start, "y": y + start}]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(fragments, _FRAGMENT), pa.array(long, pa.bool_())], [*names, "_pr_parts", "_pr_long"])

    schema = StructType(docs.schema.fields[:]).add("_pr_parts", ArrayType(StructType().add("q", "long").add("x", "long").add("y", "long"))).add("_pr_long", "boolean")
    return docs.mapInArrow(run, schema)


def _tile_rows(long_docs: DataFrame, shortest: int, core: int) -> DataFrame:
    """A row for each tile of ``_pr_row, text``, with the numbers of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = word_ids(text.split(" "))
                for octave, first, last, lo, hi in tiles(len(ids), len(ids), shortest, core):
                    cells = [[row], [octave], [lo], [first - lo], [last - lo], [ids[lo:hi].tobytes()]]
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], ["_pr_row", "octave", "lo", "first", "last", "ids"])

    return long_docs.select("_pr_row", "text").mapInArrow(run, "_pr_row long, octave long, lo long, first long, last long, ids binary")


def _solved(tile_rows: DataFrame, shortest: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile in batch.to_pylist():
                ids = np.frombuffer(tile["ids"], np.int32)
                found = solve(ids, tile["octave"], tile["first"], tile["last"], shortest)
                q, x, y = (np.array([f[k] for f in found], np.int64) for k in range(3))
                row = np.full(len(found), tile["_pr_row"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(q), pa.array(x + tile["lo"]), pa.array(y + tile["lo"])], ["_pr_row", "q", "x", "y"])

    return tile_rows.mapInArrow(run, "_pr_row long, q long, x long, y long")


def stitch(fragments: DataFrame, shortest: int) -> DataFrame:
    """``_pr_row, start, length, period`` of the runs; fragments of one document and period that touch are one run."""
    ordered = Window.partitionBy("_pr_row", "q").orderBy("x", "y")
    opens = F.coalesce(F.col("x") > F.max("y").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    numbered = fragments.withColumn("o", opens.cast("int")).withColumn("g", F.sum("o").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    joined = numbered.groupBy("_pr_row", "q", "g").agg(F.min("x").alias("start"), F.max("y").alias("y"))
    length = F.col("y") - F.col("start") + F.col("q")
    return joined.select("_pr_row", "start", length.alias("length"), F.col("q").alias("period")).where(length >= F.greatest(F.lit(shortest), 2 * F.col("q")))


def _collapsed(docs: DataFrame) -> DataFrame:
    """``text`` without the words that a run holds after its first period."""
    names = docs.columns
    at, runs_at = names.index("text"), names.index("runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            texts = []
            for text, runs in zip(batch.column(at).to_pylist(), batch.column(runs_at).to_pylist(), strict=True):
                words = text.split(" ")
                change = np.zeros(len(words) + 1, np.int64)
                for r in runs:
                    change[r["start"] + r["period"]] += 1
                    change[r["start"] + r["length"]] -= 1
                texts.append(" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]))
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)


def collapse_runs(docs: DataFrame, shortest: int = 12, spread_words: int = 1 << 18, core: int = 1 << 16) -> DataFrame:
    """``docs`` (``text`` and more) with repeated periods taken out of ``text``, plus ``n_runs`` and ``runs``.

    ``runs`` has start, length and period in words of each maximal run of at least ``max(shortest, 2 * period)``
    words, by start, then period.  Words are separated by space and 0x09-0x0D, and joined by one space in the result.  A null
    text stays null, an empty one empty, both without runs; rows that repeat come out alike.  Columns
    ``n_runs`` and ``runs`` of the input, in any case, are replaced; all others stay.
    """
    docs = drop_columns(docs, ["n_runs", "runs", "_pr_parts", "_pr_long", "_pr_row"])
    names = docs.columns
    read = checkpoint(_read(docs, shortest, spread_words).withColumn("_pr_row", F.monotonically_increasing_id()))
    short = read.where("_pr_parts is not null").select("_pr_row", F.inline("_pr_parts"))
    dealt = _tile_rows(read.where("_pr_long"), shortest, core).repartition("_pr_row", "octave", "lo")
    runs = stitch(short.union(_solved(dealt, shortest)), shortest)
    listed = runs.groupBy("_pr_row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("_pr_runs"))
    listed = listed.withColumn("_pr_runs", F.transform("_pr_runs", lambda r: F.struct(r.start, r.length, r.period)))
    some = read.where("_pr_parts is not null or _pr_long").join(listed, "_pr_row", "left")
    some = some.select(*names, F.size(F.coalesce("_pr_runs", F.array())).cast("long").alias("n_runs"), F.coalesce("_pr_runs", F.array().cast(RUNS)).alias("runs"))
    none = read.where("_pr_parts is null and not _pr_long").select(*names, F.lit(0).cast("long").alias("n_runs"), F.array().cast(RUNS).alias("runs"))
    return _collapsed(some).union(none)
