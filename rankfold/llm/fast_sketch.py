"""MinHash near-duplicates by fast similarity sketching.

A document is its set of distinct word shingles.  The sketch has ``t`` coordinates.  In round
``r < t`` every shingle is thrown into one hashed bin with value ``r + fraction``; a bin keeps its least
value, and a document stops once all its bins are full.  Should bins stay empty, rounds ``t`` to
``2t - 1`` throw all shingles into bin ``r - t``, so every coordinate is filled; all coordinates are
equal with probability J and concentrate as independent ones do.  ``bands`` hashes of ``rows``
coordinates give candidate pairs; shared full shingle sets confirm them.

Documents with equal sets are one class, so copies never meet in pairs.  In a bucket every class is
first compared with the bucket's leader.  In buckets that then still hold different components all
classes meet in blocks of bounded size, whose shared shingles are counted by matrix products and which
return one link for each two components.  No partner is left out and no bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.common import checkpoint, components, mix64, text_bytes, text_chunks

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SYMBOL = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[_LOWER]
_BASE = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate(([np.uint64(1)], np.full(max(n - 1, 0), _BASE, np.uint64))), dtype=np.uint64)


def word_hashes(data: np.ndarray, ends: np.ndarray, piece: int = 2 << 20) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and document index of every word, in order; bytes are taken in pieces cut between words."""
    hashes, docs = [], []
    first = np.zeros(len(data) + 1, bool)
    first[ends] = True
    at = 0
    while at < len(data):
        stop = min(at + piece, len(data))
        while stop < len(data) and not (_SEPARATOR[data[stop]] or first[stop]):
            stop += 1
        part = data[at:stop]
        inside = ~_SEPARATOR[part]
        begins, closes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | first[at + 1 : stop]
        closes[:-1] &= ~inside[1:] | first[at + 1 : stop]
        start, stop_ = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        if len(start):
            length = stop_ - start
            letters = part[inside]
            heads = np.cumsum(length) - length
            place = np.arange(len(letters)) - np.repeat(heads, length)
            value = _SYMBOL[letters] * _powers(int(length.max()))[place]
            hashes.append(mix64(np.add.reduceat(value, heads) + length.astype(np.uint64) * _STEP))
            docs.append(np.searchsorted(ends, start + at, "right") - 1)
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(docs)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their document index, sorted by document, then hash.

    Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased.  A document with fewer than
    ``width`` words has its whole sequence as one shingle; without words it has none.
    """
    word, doc = word_hashes(*text_bytes(texts))
    if not len(word):
        return word, doc
    chain, chains = word.copy(), [word.copy()]
    for j in range(1, width):
        nxt = np.zeros_like(word)
        nxt[:-j] = word[j:]
        chain = mix64(chain * _STEP + nxt + np.uint64(j))
        chains.append(chain)
    counts = np.bincount(doc, minlength=len(texts))
    heads = np.cumsum(counts) - counts
    whole = np.zeros(len(word), bool)
    if len(word) >= width:
        whole[: len(word) - width + 1] = doc[: len(word) - width + 1] == doc[width - 1 :]
    got_h, got_d = [chains[-1][whole]], [doc[whole]]
    for n in range(1, width):
        short = np.flatnonzero(counts == n)
        got_h.append(mix64(chains[n - 1][heads[short]] ^ np.uint64(n)))
        got_d.append(short)
    h, d = np.concatenate(got_h), np.concatenate(got_d)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], d[new]


def fast_similarity_sketch(h: np.ndarray, d: np.ndarray, n: int, t: int, seed: int = 0) -> np.ndarray:
    """``(n, t)`` sketch values; a document without shingles keeps the all-ones value."""
    sketch = np.full(n * t, _EMPTY, np.uint64)
    for r in range(2 * t):
        x = mix64(h ^ mix64(np.uint64([(seed << 20) + r + 1]) * _STEP))
        bins = ((x >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if r < t else r - t
        value = (np.uint64(r) << np.uint64(54)) | (mix64(x) >> np.uint64(10))
        np.minimum.at(sketch, d * t + bins, value)
        open_ = (sketch.reshape(n, t) == _EMPTY).any(1)
        left = open_[d]
        if not left.all():
            h, d = h[left], d[left]
        if not len(h):
            break
    return sketch.reshape(n, t)


def _reduce(values: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    np.add.at(out, d, values)
    return out


def sketches(
    docs: DataFrame, width: int = 5, bands: int = 32, rows: int = 5, seed: int = 0, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, bands`` per document; ``(d1, d2)`` is a digest of the whole shingle set."""
    t = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            n = batch.num_rows
            h, d = shingle_sets(batch.column(1), width)
            sizes = np.bincount(d, minlength=n).astype(np.int64)
            sig = fast_similarity_sketch(h, d, n, t, seed).reshape(n, bands, rows)
            key = np.full((n, bands), np.uint64(seed + 1), np.uint64)
            for r in range(rows):
                key = mix64(key * _STEP + sig[:, :, r])
            lists = pa.ListArray.from_arrays(np.arange(0, n * bands + 1, bands, dtype=np.int32), pa.array(key.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(_reduce(mix64(h), d, n).view(np.int64)),
                 pa.array(_reduce(mix64(h ^ _BASE), d, n).view(np.int64)), lists],
                ["doc_id", "n_shingles", "d1", "d2", "bands"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_shingles long, d1 long, d2 long, bands array<long>"
    )


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, d1, d2, shingles`` with the sorted shingle hashes of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text", 1 << 20):
            n = batch.num_rows
            h, d = shingle_sets(batch.column(1), width)
            stops = np.concatenate(([0], np.cumsum(np.bincount(d, minlength=n)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_reduce(mix64(h), d, n).view(np.int64)), pa.array(_reduce(mix64(h ^ _BASE), d, n).view(np.int64)),
                 pa.ListArray.from_arrays(stops, pa.array(h.view(np.int64)))],
                ["doc_id", "d1", "d2", "shingles"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, d1 long, d2 long, shingles array<long>")


def _shared_counts(one: list[np.ndarray], two: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Intersection sizes of every set of ``one`` with every set of ``two``."""
    parts = [*one, *two]
    lengths = [len(x) for x in parts]
    values, column, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    place = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)[column]
    row = np.repeat(np.arange(len(parts)), lengths)[place >= 0]
    place = place[place >= 0]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    out = np.zeros((len(one), len(two)), np.float32)
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, columns):
        lo, hi = np.searchsorted(place, (start, start + columns))
        hot = np.zeros((len(parts), min(columns, int(place[-1]) + 1 - start)), np.float32)
        hot[row[lo:hi], place[lo:hi] - start] = 1
        out += hot[: len(one)] @ hot[len(one) :].T
    return out


def block_links(members: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between components of a bucket, one for each two components and pair of blocks.

    ``members``: ``bucket, cid, label, parts, shingles``.  A bucket's rows are dealt by hash to ``parts`` blocks and
    every two blocks meet in a group of their own, so a task holds two blocks whatever the bucket's size.
    """
    mine = F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = members.withColumn("mine", mine).select("bucket", "cid", "label", "shingles", "mine", other.alias("other"))
    rows = rows.select("bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "cid", "label", "shingles")
    rows = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def links(key: tuple, group: list[tuple]) -> list[tuple[int, int]]:
        one = [x for x in group if x[0] == key[1]]
        two = [x for x in group if x[0] == key[2]]
        if not one or not two:
            return []
        both = _shared_counts([x[3] for x in one], [x[3] for x in two])
        n1, n2 = (np.array([len(x[3]) for x in side], np.float64) for side in (one, two))
        l1, l2 = (np.array([x[2] for x in side]) for side in (one, two))
        near = (100 * both >= percent * (n1[:, None] + n2 - both)) & (l1[:, None] != l2)
        x, y = np.nonzero(near)
        return list({(min(p), max(p)) for p in zip(l1[x].tolist(), l2[y].tolist(), strict=True)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, found = None, [], []
        for batch in batches:
            ends = batch.column("shingles").offsets.to_numpy()
            flat = batch.column("shingles").values.to_numpy()
            columns = [batch.column(c).to_pylist() for c in ("bucket", "i", "j", "mine", "cid", "label")]
            for r, (bucket, i, j, mine_, cid, label) in enumerate(zip(*columns, strict=True)):
                if key != (bucket, i, j):
                    if key is not None:
                        found += links(key, group)
                    key, group = (bucket, i, j), []
                group.append((mine_, cid, label, flat[ends[r] : ends[r + 1]].copy()))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])
                found = []
        if key is not None and (found := links(key, group)):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    bands: int = 32,
    rows: int = 5,
    seed: int = 0,
    block_rows: int = 512,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Two documents are linked if ``100 * intersection >= percent * union`` of their full shingle sets;
    ``component_id`` is the least doc_id reachable by links and ``kept`` marks the document that has it.
    A null or wordless text has no shingles and is linked with nothing.  Rows that repeat a doc_id each
    come out, and only with equal sets or a link do they share a component; a null doc_id is never the
    component's id while another is there.  An empty table gives an empty result.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sk = checkpoint(sketches(base, width, bands, rows, seed))
    cls = (
        sk.where("n_shingles > 0")
        .groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    )
    cls = checkpoint(cls.withColumn("cid", F.monotonically_increasing_id()))
    members = cls.select("cid", F.posexplode("bands").alias("band", "sig"))
    heads = members.groupBy("band", "sig").agg(F.min("cid").alias("lead"), F.count("*").alias("c")).where("c > 1").drop("c")
    shared = checkpoint(members.join(heads, ["band", "sig"]).select(F.xxhash64("band", "sig").alias("bucket"), "cid", "lead"))
    stars = shared.where("cid != lead").select(F.col("lead").alias("a"), F.col("cid").alias("b")).distinct()

    reps = cls.join(shared.select("cid").distinct(), "cid", "left_semi").select("cid", "rep", "n", "d1", "d2")
    wanted = base.join(reps.select(F.col("rep").alias("r")).distinct(), F.col("doc_id").eqNullSafe(F.col("r")), "left_semi")
    sets = full_sets(wanted, width).dropDuplicates(["d1", "d2"]).join(reps.select("cid", "n", "d1", "d2"), ["d1", "d2"])
    sets = checkpoint(sets.select("cid", "n", "shingles"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Pairs whose full sets are similar enough; sizes that cannot be are ruled out before the sets are fetched."""
        n = sets.select("cid", "n")
        near = (
            pairs.join(n.toDF("a", "na"), "a").join(n.toDF("b", "nb"), "b")
            .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        )
        one, two = sets.select("cid", "shingles").toDF("a", "sa"), sets.select("cid", "shingles").toDF("b", "sb")
        both = F.size(F.array_intersect("sa", "sb"))
        full = near.join(one, "a").join(two, "b").withColumn("both", both)
        return full.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")

    edges = checkpoint(confirmed(stars))
    label = components(edges).toDF("cid", "label")
    tagged = shared.join(label, "cid", "left").select("bucket", "cid", F.coalesce("label", "cid").alias("label"))
    sizes = tagged.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size"))
    # the one pair of a bucket of two is tested
    mixed = sizes.where("lo != hi and size > 2").select("bucket", F.ceil(F.col("size") / block_rows).cast("int").alias("parts"))
    left = tagged.join(mixed, "bucket").join(sets, "cid")
    label = components(edges.union(block_links(left, percent))).toDF("cid", "label")

    done = cls.join(label, "cid", "left").select("d1", "d2", "rep", F.coalesce("label", "cid").alias("label"))
    least = done.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_class = done.join(least, "label").select("d1", "d2", "component_id")
    out = sk.select("doc_id", "n_shingles", "d1", "d2").join(of_class, ["d1", "d2"], "left")
    lone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", lone.alias("component_id"), F.coalesce(F.col("doc_id") == lone, F.lit(False)).alias("kept"))


def without_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without all but the document of the least id of each group of near duplicates.

    Of rows that repeat an id and a text one stays; rows without an id stay, as no group can name them.
    The documents are dealt by id once, at every size, whatever the planner thinks of the list of ids.
    """
    found = near_duplicates(docs, width=width, percent=percent)
    kept = found.where("kept").select("doc_id").distinct()
    named = docs.where("doc_id is not null").withColumn("_fs_h", F.xxhash64(F.coalesce("text", F.lit(""))))
    named = named.join(kept.hint("merge"), "doc_id", "left_semi")
    once = named.withColumn("_fs_n", F.row_number().over(Window.partitionBy("doc_id", "_fs_h").orderBy("_fs_h"))).where("_fs_n = 1")
    return once.select(*docs.columns).union(docs.where("doc_id is null"))
