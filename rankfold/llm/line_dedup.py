"""Substring deduplication by hashing sentences, lines or paragraphs.

A document is cut into units: lines cut further behind the marks that end a sentence (the default), whole lines, or paragraphs between blank
lines.  Every unit with a word is normalised (words joined by one space, A-Z lower-cased) and its digest grouped over all documents; the
occurrence in the least document id, and there at the first place, stays, the others go, however short or frequent they
are.  Kept and removed text keeps its offsets in the original, and the number of words and characters that went tells a stock phrase
from a copied passage.

Only digests that occur twice or more are joined back, in a join that Spark can split where one unit is very
frequent.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankfold.llm.common import checkpoint, drop_columns, text_chunks, words_of

_FOLD = {c: c + 32 for c in range(65, 91)}
#: What lies between two units.
_GAPS = {
    "sentence": re.compile(r"\n|(?<=[.!?])[\x20\x09]+"),
    "line": re.compile(r"\n"),
    "paragraph": re.compile(r"\n(?:[\x20\x09\x0B-\x0D]*\n)+"),
}


def cut(text: str, unit: str) -> list[tuple[int, int]]:
    """``(start, end)`` of every unit; between two units lies a gap."""
    gaps = [m.span() for m in _GAPS[unit].finditer(text)]
    return list(zip([0, *(e for _, e in gaps)], [*(s for s, _ in gaps), len(text)], strict=True))


def parts_of(text: str, unit: str) -> list[str]:
    """The units' texts, as ``cut`` places them."""
    return _GAPS[unit].split(text)


def _has_word(part: str) -> bool:
    return bool(part.strip("\x20\x09\x0A\x0B\x0C\x0D"))


def unit_digests(docs: DataFrame, unit: str) -> DataFrame:
    """``doc_id, h, unit, d1, d2`` of the units with a word."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            rows, numbers, digests = [], [], []
            for r, text in enumerate(batch.column(2).to_pylist()):
                for k, part in enumerate(parts_of(text or "", unit)):
                    words = words_of(part)
                    if words:
                        rows.append(r)
                        numbers.append(k)
                        digests.append(hashlib.blake2b(" ".join(words).translate(_FOLD).encode(), digest_size=16).digest())
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            at = pa.array(rows, pa.int64())
            made = [batch.column(0).take(at), batch.column(1).take(at), pa.array(numbers, pa.int32())]
            yield pa.RecordBatch.from_arrays([*made, pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())], ["doc_id", "h", "unit", "d1", "d2"])

    return docs.mapInArrow(run, f"doc_id {kind}, h long, unit int, d1 long, d2 long")


def repeated_units(docs: DataFrame, unit: str = "sentence") -> DataFrame:
    """``doc_id, h, unit`` of every unit that goes (``docs``: ``doc_id, h, text``)."""
    units = checkpoint(unit_digests(docs, unit))
    twice = units.groupBy("d1", "d2").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    again = checkpoint(units.join(twice, ["d1", "d2"]))
    place = F.struct(F.col("doc_id").isNull().alias("o"), F.col("doc_id").alias("i"), F.col("h"), F.col("unit").alias("k"))
    first = again.groupBy("d1", "d2").agg(F.min(place).alias("f"))
    stays = F.col("doc_id").eqNullSafe(F.col("f.i")) & (F.col("h") == F.col("f.h")) & (F.col("unit") == F.col("f.k"))
    return again.join(first, ["d1", "d2"]).where(~stays).select("doc_id", "h", "unit")


def without_repeats(docs: DataFrame, unit: str = "sentence") -> DataFrame:
    """``docs`` (``doc_id, text`` and more) with the cleaned ``text`` and ``n_units, n_removed, removed_words, removed_chars, removed``.

    ``n_units`` counts the units with a word; ``removed`` lists ``start:end`` of the units that went, in code points of the
    original.  Between two kept units stays one newline if one lay between them, else the gap before the later one.  A null text stays
    null and has no units, an empty one none either.  Rows equal in id and text are one document and come out alike; a null id
    ranks after all others.  Extra columns stay, but for those of the names made here, in any case.
    """
    made = ["n_units", "n_removed", "removed_words", "removed_chars", "removed"]
    docs = drop_columns(docs, [*made, "_ld_h", "_ld_i", "_ld_g", "_ld_gone"])
    keyed = docs.withColumn("_ld_h", F.xxhash64(F.coalesce("text", F.lit(""))))
    gone = repeated_units(keyed.select("doc_id", F.col("_ld_h").alias("h"), "text"), unit).distinct()
    gone = gone.groupBy(F.col("doc_id").alias("_ld_i"), F.col("h").alias("_ld_g")).agg(F.collect_list("unit").alias("_ld_gone"))
    joined = keyed.join(gone, F.col("doc_id").eqNullSafe(F.col("_ld_i")) & (F.col("_ld_h") == F.col("_ld_g")), "left").select(*docs.columns, "_ld_gone")
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            texts, numbers, spans = [], [], []
            for text, gone in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                parts = cut(text, unit) if text is not None else []
                out, kept, last, lost = set(gone or ()), [], None, []
                for k, (s, e) in enumerate(parts) if out else ():
                    if k in out:
                        lost.append((s, e))
                        continue
                    if last is not None:
                        kept.append("\n" if unit == "sentence" and "\n" in text[last:s] else text[parts[k - 1][1] : s])
                    kept.append(text[s:e])
                    last = e
                texts.append("".join(kept) if out else text)
                numbers.append((sum(map(_has_word, parts_of(text, unit))) if parts else 0, len(lost), sum(len(words_of(text[s:e])) for s, e in lost), sum(e - s for s, e in lost)))
                spans.append(",".join(f"{s}:{e}" for s, e in lost))
            columns = list(batch.columns[: len(names)])
            columns[at] = pa.array(texts, pa.string())
            table = np.array(numbers, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(table[:, k]) for k in range(4)), pa.array(spans, pa.string())], [*names, *made])

    schema = StructType(docs.schema.fields[:])
    for name in made:
        schema = schema.add(name, "string" if name == "removed" else "long")
    return joined.mapInArrow(run, schema)
