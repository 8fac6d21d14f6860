"""Phrase collocations of each language, found by best-first growth of prefixes.

A node of the search is a phrase; its children are the phrases one word longer.  With a the count of a phrase and l, r those of
its parts at a cut, the score is ``a*a / (l*r)`` at the worst cut.  As a phrase is no more frequent than its parts, every
phrase that begins with the pair (v, w) scores at most ``f(v w) / f(v)``: the prefix count is an admissible bound.

Words are counted first, then the pairs of frequent words.  Each language gets a threshold, the score of its
``2 * limit``-th pair.  A round counts the children of the pairs whose bound reaches the threshold, and the longer phrases around the
pairs that reach it themselves, as one of those may take a pair out.  All phrases that score at least the threshold
are known then.  A language of which ``limit`` of them survive is settled, ties included; for the others the threshold falls to a
pair twice as far down, and to zero after the last pair, when their whole frontier has been expanded.

What a counting pass is to look at is told to its tasks by bit tables over hashed pairs, whose size is a
parameter and does not grow with the data.  A pair that shares its bit with another is counted too and falls away in the
exact joins that follow, so the size changes the work and not the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.common import checkpoint, mix64, text_bytes, text_chunks

_CUT = b"\xff"  # a byte that UTF-8 never has
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 9 else 255 if chr(c) in ".,;:!?\n\x0b\x0c\r" else c for c in range(256))
UNKNOWN = "und"


def pieces(text: bytes) -> list[bytes]:
    """The words of a text, A-Z lower-cased, with ``_CUT`` between two pieces."""
    return text.translate(_TABLE).replace(_CUT, b" " + _CUT + b" ").split()


def _word_hash(words: list[bytes], lang: str) -> np.ndarray:
    key = hashlib.blake2b(lang.encode(), digest_size=16).digest()
    return np.frombuffer(b"".join(hashlib.blake2b(w, digest_size=8, key=key).digest() for w in words), np.uint64)


def _slots(words: list[np.ndarray], bits: int) -> np.ndarray:
    """The bit of each phrase, given the hashes of its first, second .. words."""
    out = np.zeros(len(words[0]), np.uint64)
    for h in words:
        out = mix64(out * np.uint64(3) + h)
    return (out % np.uint64(bits)).astype(np.int64)


def _has(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (table[slots >> 6] >> (slots & 63).astype(np.uint64)) & np.uint64(1) > 0


def bit_table(phrases: DataFrame, size: int, bits: int) -> np.ndarray:
    """The table of ``lang, w1 .. w<size>``: ``bits / 64`` numbers, whatever the number of phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, *words = (batch.column(k).to_pylist() for k in range(size + 1))
            slots = np.zeros(len(langs), np.int64)
            for lang in set(langs):
                rows = [k for k, x in enumerate(langs) if x == lang]
                slots[rows] = _slots([_word_hash([side[k].encode() for k in rows], lang) for side in words], bits)
            slots = np.unique(slots)
            yield pa.RecordBatch.from_arrays([pa.array(slots >> 6), pa.array(np.left_shift(np.int64(1), slots & 63))], ["cell", "bit"])

    read = phrases.select("lang", *[f"w{k + 1}" for k in range(size)])
    cells = read.mapInArrow(run, "cell long, bit long").groupBy("cell").agg(F.expr("bit_or(bit)").alias("bit")).toArrow()
    table = np.zeros(-(-bits // 64), np.uint64)
    table[cells.column("cell").to_numpy()] = cells.column("bit").to_numpy().astype(np.int64).view(np.uint64)
    return table


def asked(tables: dict[str, np.ndarray], words: list[np.ndarray], bits: int) -> np.ndarray:
    """Which phrases, given the hashes of their words, a round asks for."""
    if len(words) == 2:
        return _has(tables["words"], _slots(words[:1], bits)) & _has(tables["words"], _slots(words[1:], bits))
    front, rear = _slots(words[:2], bits), _slots(words[1:], bits)
    return _has(tables["pairs"], front) & _has(tables["pairs"], rear) & (_has(tables["open"], front) | _has(tables["top"], rear))


def _counts(docs: DataFrame, size: int, rounds: list[dict[str, np.ndarray]], bits: int) -> DataFrame:
    """``lang, w1 .. w<size>, c``: the phrases of ``size`` words of ``docs`` (``lang, text``) with their counts.

    With ``rounds``, the bit tables of each, those that the last round asks for and none before it.
    """
    names = [f"w{k + 1}" for k in range(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text", 4 << 20):
            raw, ends = text_bytes(batch.column(1))
            langs = batch.column(0).to_pylist()
            for lang in set(langs):
                known: dict[bytes, int] = {_CUT: 0}
                line = [0]
                for k in [k for k, x in enumerate(langs) if x == lang]:
                    line += [known.setdefault(w, len(known)) for w in pieces(raw[ends[k] : ends[k + 1]].tobytes())]
                    line.append(0)
                words, ids = list(known), np.array(line, np.int64)
                at = np.flatnonzero(ids[: len(ids) - size + 1])
                for k in range(1, size):
                    at = at[ids[at + k] > 0]
                if rounds:
                    hashes = _word_hash(words, lang)
                    of = [hashes[ids[at + k]] for k in range(size)]
                    take = asked(rounds[-1], of, bits)
                    for tables in rounds[:-1]:
                        take &= ~asked(tables, of, bits)
                    at = at[take]
                key = ids[at]
                for k in range(1, size):
                    if k > 1:  # keeps the numbers small
                        key = np.unique(key, return_inverse=True)[1]
                    key = key * len(words) + ids[at + k]
                _, where, counts = np.unique(key, return_index=True, return_counts=True)
                vocabulary = pa.array(words[1:], pa.binary()).cast(pa.string())
                columns = [vocabulary.take(pa.array(ids[at[where] + k] - 1)) for k in range(size)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(where), pa.string()), *columns, pa.array(counts.astype(np.int64))], ["lang", *names, "c"])

    parts = docs.select("lang", "text").mapInArrow(run, "lang string, " + "".join(f"{w} string, " for w in names) + "c long")
    return parts.groupBy("lang", *names).agg(F.sum("c").alias("c"))


def ratio(a: Column, left: Column, right: Column) -> Column:
    """``floor(1000000 * a * a / (left * right))`` in exact arithmetic, for counts below 1e15."""
    a, left, right = (x.cast("decimal(15,0)") for x in (a, left, right))
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (a * a), left * right)


def _scored(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """``lang, w1, w2, w3, a, l, r, score`` at the worst cut; every part of a candidate is a pair or in one."""
    front = pairs.select("lang", "w1", "w2", F.col("l").alias("f1"), F.col("a").alias("f12"))
    rear = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"), F.col("r").alias("f3"))
    both = triples.join(front, ["lang", "w1", "w2"]).join(rear, ["lang", "w2", "w3"])
    both = both.withColumn("s1", ratio(F.col("a"), F.col("f1"), F.col("f23"))).withColumn("s2", ratio(F.col("a"), F.col("f12"), F.col("f3")))
    early = F.col("s1") <= F.col("s2")
    l, r = F.when(early, F.col("f1")).otherwise(F.col("f12")), F.when(early, F.col("f23")).otherwise(F.col("f3"))
    return both.select("lang", "w1", "w2", "w3", "a", l.alias("l"), r.alias("r"), F.least("s1", "s2").alias("score"))


def _survivors(pairs: DataFrame, triples: DataFrame, thresholds: DataFrame, inside: int) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the phrases that reach their language's threshold and are not dropped."""
    most = triples.select(F.inline(F.array(*(F.struct("lang", F.col(x).alias("w1"), F.col(y).alias("w2"), F.col("a").alias("m")) for x, y in (("w1", "w2"), ("w2", "w3"))))))
    most = most.groupBy("lang", "w1", "w2").agg(F.max("m").alias("m"))
    held = pairs.join(most, ["lang", "w1", "w2"], "left").where(F.col("m").isNull() | (F.col("m") * 100 < F.col("a") * inside))
    found = held.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score")
    found = found.union(triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3"), "a", "l", "r", "score"))
    return found.join(thresholds, "lang").where("score >= t").drop("t")


def score_at(phrases: DataFrame, rank: int) -> DataFrame:
    """``lang, t``: the score of the ``rank``-th phrase of each language that has so many.

    Phrases are counted by score, of which there are no more than 1,000,001, before anything is ordered.
    """
    down = Window.partitionBy("lang").orderBy(F.desc("score"))
    counts = phrases.groupBy("lang", "score").agg(F.count("*").alias("c")).withColumn("k", F.sum("c").over(down))
    return counts.where(F.col("k") >= rank).groupBy("lang").agg(F.max("score").alias("t"))


def collocations(docs: DataFrame, least: int = 10, limit: int = 2000, inside: int = 50, bits: int = 1 << 24) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``limit`` phrases of 2 and 3 words of each language of ``docs`` (``text, lang``).

    Candidates occur at least ``least`` times.  A pair goes that lies inside a triple of at least ``inside`` percent of its
    count.  Order: score, then a, both falling, then phrase by code point.  A null language is ``und``; a null or empty text has
    no words; repeated rows count each time; other columns are not read.  ``n`` counts all words of the language.
    """
    docs = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text").where("text is not null")
    words = checkpoint(_counts(docs, 1, [], bits))
    sizes = words.groupBy("lang").agg(F.sum("c").alias("n"))
    frequent = words.where(F.col("c") >= least)
    counted = _counts(docs, 2, [{"words": bit_table(frequent, 1, bits)}], bits).where(F.col("c") >= least).withColumnRenamed("c", "a")
    counted = counted.join(frequent.select("lang", "w1", F.col("c").alias("l")), ["lang", "w1"])
    counted = counted.join(frequent.select("lang", F.col("w1").alias("w2"), F.col("c").alias("r")), ["lang", "w2"])
    a, l, r = F.col("a"), F.col("l"), F.col("r")
    # the bound is a score whose right part is as frequent as the phrase
    pairs = checkpoint(counted.select("lang", "w1", "w2", "a", "l", "r", ratio(a, l, r).alias("score"), ratio(a, l, a).alias("bound")))
    everywhere = bit_table(pairs, 2, bits)
    rounds: list[dict[str, np.ndarray]] = []
    triples, open_langs, depth, done = None, pairs.select("lang").distinct(), 2 * limit, []
    while True:
        thresholds = checkpoint(open_langs.join(score_at(pairs, depth), "lang", "left").select("lang", F.coalesce("t", F.lit(0)).alias("t")))
        near = pairs.join(thresholds, "lang").where("bound >= t")
        rounds.append({"pairs": everywhere, "open": bit_table(near, 2, bits), "top": bit_table(near.where("score >= t"), 2, bits)})
        new = _counts(docs, 3, rounds, bits).where(F.col("c") >= least).withColumnRenamed("c", "a")
        new = checkpoint(_scored(new, pairs))
        triples = new if triples is None else triples.union(new)
        found = checkpoint(_survivors(pairs, triples, thresholds, inside))
        many = found.groupBy("lang").agg(F.count("*").alias("k"))
        settled = thresholds.join(many, "lang", "left").where((F.col("t") == 0) | (F.col("k") >= limit)).select("lang")
        done.append(found.join(settled, "lang", "left_semi"))
        open_langs = checkpoint(thresholds.select("lang").join(settled, "lang", "left_anti"))
        if open_langs.isEmpty():
            break
        depth *= 2
    best = done[0]
    for more in done[1:]:
        best = best.union(more)
    best = best.join(score_at(best, limit), "lang", "left").where(F.col("t").isNull() | (F.col("score") >= F.col("t")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= limit)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
