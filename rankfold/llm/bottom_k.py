"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A document's shingles are runs of ``width`` words (all of them, if there are fewer); its sketch is the ``k``
least distinct hashes in ascending order.  Sketches merge across parts by the k least of their union, and give
resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.common import checkpoint

_SPAN = float(1 << 64)


def with_sketch(df: DataFrame, text: str, name: str, k: int = 128, width: int = 5) -> DataFrame:
    """``df`` plus the sketch ``name`` (array of longs, ascending) of the column ``text``; empty for a null or wordless text."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    df = df.withColumn("_w", F.transform(words, lambda w: F.xxhash64(w)))
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("_w") - (width - 1), F.lit(1))), lambda i: F.xxhash64(F.slice("_w", i, width)))
    hashes = F.when(F.size("_w") > 0, runs).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(name, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)).drop("_w")


def merged(a: Column, b: Column, k: int = 128) -> Column:
    """Sketch of the union of two documents' shingles."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(df: DataFrame, by: list[str], sketch: str, k: int = 128) -> DataFrame:
    """One sketch per group of ``by``: hashes are made distinct before the shuffle, and only a rank up to ``k`` is kept.

    Spark limits a ranked window in each task before it shuffles, so a group with a third of all rows moves
    ``k`` hashes a task.
    """
    each = df.select(*by, F.explode(sketch).alias("_h")).distinct()
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("_h"))
    least = each.withColumn("_r", rank).where(F.col("_r") <= k)
    return least.groupBy(*by).agg(F.sort_array(F.collect_list("_h")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated Jaccard likeness; exact where both have fewer than ``k`` shingles; two empty sketches are alike."""
    both = merged(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.size(both))


def distinct_shingles(sketch: Column, k: int = 128) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(sketch, -1).cast("double") + F.lit(_SPAN / 2)) / F.lit(_SPAN)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has too (1 for an empty ``a``)."""
    j, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j * (na + nb) / (1 + j) / na))


def fingerprint(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def id_ranges(docs: DataFrame, parts: int, fan: int = 1000) -> tuple[DataFrame, int]:
    """``docs`` plus ``_range``, about ``parts`` ranges of descending doc_id (null: the last one), and their number.

    Ids are cut at approximate quantiles; beyond ``fan`` ranges in two levels, the quantiles of each first range in a table
    of at most ``fan * fan`` numbers, so that ranges keep their size while the text grows to ``fan * fan`` of them.
    """
    ids = F.col("doc_id").cast("double")
    first, second = min(parts, fan), min(fan, -(-parts // fan))
    at = docs.select(F.percentile_approx("doc_id", [i / first for i in range(1, first)], 50 * first).alias("q")).first()["q"]
    splits = [float("-inf"), *sorted({float(x) for x in at or (0,)}), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="_d", outputCol="_coarse", handleInvalid="keep").transform(docs.withColumn("_d", F.coalesce(ids, F.lit(float("nan")))))
    coarse, fine = len(splits) - 1, F.lit(0)
    if second > 1:
        cuts = ranged.where("doc_id is not null").groupBy("_coarse").agg(F.percentile_approx("doc_id", [i / second for i in range(1, second)], 50 * second).alias("_cuts"))
        ranged = ranged.join(F.broadcast(checkpoint(cuts)), "_coarse", "left")
        fine = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col("doc_id"))), F.lit(0))
    last = coarse * second
    place = F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(last - 1 - (F.col("_coarse") * second + fine))
    return ranged.withColumn("_range", place.cast("int")).select(*docs.columns, "_range"), last + 1


def with_next(docs: DataFrame, range_chars: int = 2_000_000, k: int = 128, width: int = 5, fan: int = 1000) -> DataFrame:
    """``doc_id, n_chars, text, sketch, next_text, next_sketch`` in descending doc_id; the last one's next is the first.

    Ids are cut into ranges of about ``range_chars`` of text;
    the text is shuffled once, by range.  The next document of a range's last one is the first of the range
    below, from a table with one row per range.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    seen = docs.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    ranged, _ = id_ranges(docs, max(2, -(-seen // range_chars)), fan)
    ranged = ranged.withColumn("_tie", F.xxhash64("text"))

    keys = ranged.select("_range", "doc_id", "_tie")
    top = keys.groupBy("_range").agg(F.min(F.struct(F.col("doc_id").isNull().alias("o"), -F.col("doc_id").cast("decimal(20,0)"), "_tie")).alias("s"))
    order = Window.orderBy("_range")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    top = top.withColumn("first", F.first("s").over(whole)).withColumn("after", F.coalesce(F.lead("s").over(order), F.col("first")))
    top = top.select(F.col("_range").alias("_of"), (-F.col("after.col2")).cast(docs.schema["doc_id"].dataType).alias("h_id"), F.col("after._tie").alias("h_tie"))
    heads = ranged.select("doc_id", "_tie", F.col("text").alias("h_text")).join(F.broadcast(top), F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("_tie") == F.col("h_tie")))
    heads = with_sketch(checkpoint(heads.select("_of", "h_text").dropDuplicates(["_of"])), "h_text", "h_sketch", k, width)

    dealt = with_sketch(ranged.repartition("_range"), "text", "sketch", k, width)
    down = Window.partitionBy("_range").orderBy(F.col("doc_id").desc_nulls_last(), "_tie")
    led = dealt.withColumns({"n_text": F.lead("text").over(down), "n_sketch": F.lead("sketch").over(down)})
    out = led.join(heads, (F.col("_range") == F.col("_of")) & F.col("n_text").isNull(), "left")
    return out.select("doc_id", F.length("text").cast("long").alias("n_chars"), "text", "sketch",
                      F.coalesce("n_text", "h_text").alias("next_text"), F.coalesce("n_sketch", "h_sketch").alias("next_sketch"))


def fingerprints(docs: DataFrame, k: int = 128, width: int = 5) -> DataFrame:
    """Fingerprint of every text and of its edited text, and likeness to the edited text and to the next document.

    The edited text has the last half of the code points replaced by the first as many (or all) of the next document in
    descending doc_id.  A null text is empty; rows that repeat an id are ordered by a digest of the text; rows without an id
    come last; an empty table gives an empty result; other columns are left out.
    """
    rows = with_next(docs, k=k, width=width)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half))
    rows = with_sketch(rows.withColumn("edited", edited), "edited", "edited_sketch", k, width)
    s, t = F.col("sketch"), F.col("edited_sketch")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(s).alias("fingerprint"), fingerprint(t).alias("edited_fingerprint"),
        resemblance(s, t, k).alias("near_edited"), resemblance(s, F.col("next_sketch"), k).alias("near_next"),
        containment(t, s, k).alias("edited_contained"), distinct_shingles(s, k).alias("n_shingles"),
    )
