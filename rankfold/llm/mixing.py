"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key ``-ln(u) / quality`` with ``u`` from a digest of its id, so reruns
agree.  A source's target is its weighted share of ``share`` times all words, at most ``max_epochs``
times its own words, the excess reshared by weight.  Whole epochs are taken first; of the rest of the target
the documents with the least keys are taken, by a prefix sum of their sizes in key order; the document
at the cut gives a part of its words, or as a whole document comes or stays, whichever ends nearer to the target.

The prefix sum is one over ranges of the key per source, whose number grows with the rows, and a sort only of the one range
that holds the cut, so a source with a third of all rows is never sorted or gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.common import WORD, checkpoint, drop_columns, hex_unit

#: Rows of a range of the key; the range that holds a source's cut is sorted.
RANGE_ROWS = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def letter_quality(text: Column) -> Column:
    """Quality weight in [0.05, 1]: the share of letters among the characters (null or empty: 0.05)."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.greatest(F.lit(0.05), F.coalesce(letters / F.nullif(F.length(text), F.lit(0)), F.lit(0.0)))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``: one row per source, in one small sort.

    Sources by code point (null last) take ``weights`` in turn.  The level ``x`` that solves
    sum(min(x * weight, cap)) = share * all words is read off the sources sorted by cap / weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    ranked = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))).withColumn("ratio", F.col("cap") / F.col("w"))
    fill = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, whole = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = rest / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    levels = ranked.withColumn("level", level)
    found = F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", F.col("source").isNull(), "source", "level"))).over(whole)
    target = F.coalesce(F.least("cap", found["level"] * F.col("w")), F.col("cap"))
    return levels.withColumn("target", target).select("source", "source_size", "target")


def sized(docs: DataFrame, quality: Column | None, seed: int) -> DataFrame:
    """``docs`` plus ``_mx_size, _mx_key, _mx_tie``."""
    u = hex_unit(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(str(seed)))))
    weight = letter_quality(F.col("text")) if quality is None else quality
    return docs.withColumns({"_mx_size": word_count(F.col("text")), "_mx_key": -F.log(u) / weight, "_mx_tie": F.xxhash64(F.coalesce("text", F.lit("")))})


def plan(
    rows: DataFrame, weights: tuple[float, ...], share: float, max_epochs: int, key_buckets: int | None, small_sources: int
) -> tuple[DataFrame, bool]:
    """Per source: its size, target, whole epochs and the key at which the last epoch is cut; and whether these rows are few.

    ``rows``: ``source, _mx_size, _mx_key, _mx_tie``.  One row per source, broadcast up to ``small_sources`` of them; beyond, they
    are joined by source.
    """
    key = F.col("source").eqNullSafe(F.col("_mx_source"))
    buckets = key_buckets or max(4096, -(-rows.count() // RANGE_ROWS))
    place = F.least(F.lit(buckets - 1), F.floor((1 - F.exp(-F.col("_mx_key"))) * buckets))
    rows = rows.withColumn("_mx_range", place.cast("long"))
    ranges = checkpoint(rows.groupBy("source", "_mx_range").agg(F.sum("_mx_size").alias("n")))
    totals = checkpoint(source_targets(ranges.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, max_epochs))
    few = totals.count() <= small_sources
    hint = F.broadcast if few else (lambda df: df)
    epochs = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    totals = totals.withColumn("epochs", epochs.cast("long"))
    totals = totals.withColumn("budget", F.round("target").cast("long") - F.col("epochs") * F.col("source_size")).withColumnRenamed("source", "_mx_source")
    upto = Window.partitionBy("source").orderBy("_mx_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = ranges.withColumn("upto", F.sum("n").over(upto)).join(hint(totals), key)
    at = at.where("upto >= budget and upto - n < budget").select("_mx_source", F.col("_mx_range").alias("r"), (F.col("upto") - F.col("n")).alias("base"), "budget")
    near = rows.join(hint(at), key & (F.col("_mx_range") == F.col("r")))
    equal = near.groupBy("_mx_source", "_mx_key", "_mx_tie").agg(F.sum("_mx_size").alias("n"), F.count("*").alias("m"), F.first("base").alias("base"), F.first("budget").alias("budget"))
    run = Window.partitionBy("_mx_source").orderBy("_mx_key", "_mx_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    equal = equal.withColumn("upto", F.col("base") + F.sum("n").over(run)).where("upto >= budget and upto - n < budget")
    part = F.floor((F.col("budget") - F.col("upto") + F.col("n")) / F.col("m")).cast("long")
    cut = equal.select(F.col("_mx_source").alias("_mx_cut"), F.col("_mx_key").alias("_mx_cut_key"), F.col("_mx_tie").alias("_mx_cut_tie"), part.alias("_mx_cut_words"))
    marks = totals.join(cut, F.col("_mx_source").eqNullSafe(F.col("_mx_cut")), "left").drop("_mx_cut", "budget")
    for name in ("source_size", "target", "epochs"):
        marks = marks.withColumnRenamed(name, f"_mx_{name}")
    return checkpoint(marks), few


def _marked(docs: DataFrame, weights, share, max_epochs, quality, seed, key_buckets, small_sources, keep_text: bool) -> DataFrame:
    """``docs`` (or its ``doc_id`` only) plus ``_mx_size, _mx_source_size, _mx_target, _mx_epochs, _mx_extra, _mx_last``."""
    rows = checkpoint(sized(docs.select("doc_id", "text", "source"), quality, seed).drop("text"))
    marks, few = plan(rows, weights, share, max_epochs, key_buckets, small_sources)
    full = sized(docs, quality, seed) if keep_text else rows
    out = full.join(F.broadcast(marks) if few else marks, F.col("source").eqNullSafe(F.col("_mx_source")))
    key, tie = F.col("_mx_key"), F.col("_mx_tie")
    below = (key < F.col("_mx_cut_key")) | ((key == F.col("_mx_cut_key")) & (tie < F.col("_mx_cut_tie")))
    there = (key == F.col("_mx_cut_key")) & (tie == F.col("_mx_cut_tie"))
    extra = F.when(below, F.col("_mx_size")).when(there, F.col("_mx_cut_words")).otherwise(F.lit(0)).cast("long")
    last = F.coalesce(below | (there & (2 * F.col("_mx_cut_words") >= F.col("_mx_size"))), F.lit(False))
    return out.withColumns({"_mx_extra": extra, "_mx_last": last})


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: int = 2,
    quality: Column | None = None,
    seed: int = 17,
    key_buckets: int | None = None,
    small_sources: int = 100_000,
    keep_text: bool = False,
) -> DataFrame:
    """``doc_id, size, source_size, target, epochs, extra, taken`` per row of ``docs``; with ``keep_text`` all columns of ``docs`` too.

    ``taken = epochs * size + extra`` words; ``extra`` is ``size`` below the cut of the last epoch, a part at the
    cut, else 0.  A null text has size 0 and is taken with 0 words; a null source is a source of its own,
    after all others; rows equal in id and text share the words left at the cut; an empty table gives an
    empty result.  ``docs``' own columns of the made names, in any case, are replaced.  ``key_buckets`` is the number of ranges of
    the key (None: one for ``RANGE_ROWS`` rows); ``small_sources`` bounds what is broadcast, one row per source.
    """
    made = ["size", "source_size", "target", "epochs", "extra", "taken"]
    docs = drop_columns(docs, made)
    out = _marked(docs, weights, share, max_epochs, quality, seed, key_buckets, small_sources, keep_text)
    taken = F.col("_mx_epochs") * F.col("_mx_size") + F.col("_mx_extra")
    head = docs.columns if keep_text else ["doc_id"]
    return out.select(*[F.col(f"`{c}`") for c in head], *[F.col(f"_mx_{c}").alias(c) for c in made[:-1]], taken.alias("taken"))


def mixed_documents(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: int = 2,
    quality: Column | None = None,
    seed: int = 17,
    key_buckets: int | None = None,
    small_sources: int = 100_000,
) -> DataFrame:
    """The mix as whole documents, in the columns of ``docs``: a row per whole epoch, and one for the last.

    ``docs`` has ``doc_id, text, source`` and any other columns.  The document at a source's cut comes whole if half of it or more lies within the
    target, else it stays out.  Wordless documents come with their neighbours by key; a source without any word is kept once.
    """
    rows = _marked(docs, weights, share, max_epochs, quality, seed, key_buckets, small_sources, True)
    copies = F.when(F.col("_mx_source_size") == 0, F.lit(1)).otherwise(F.col("_mx_epochs").cast("int") + F.col("_mx_last").cast("int"))
    rows = rows.withColumn("_mx_copy", F.explode(F.array_repeat(F.lit(0), copies)))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
