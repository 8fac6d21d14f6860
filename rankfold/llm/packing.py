"""Best-fit packing of documents into token sequences by a plan over the length histogram.

Best-fit decreasing places counts of equal lengths into counts of equal gaps, so the plan is a few
thousand rows whatever the number of documents.  A planned slot says that ranks ``[first, stop)`` of a
length lie in consecutive sequences, ``per`` in each, from ``offset`` on; documents take their slot by a
join on length and rank.  Ranks within a length are a prefix over hashed parts, so that a length that a third
of all pieces have is no single task.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.common import checkpoint, text_chunks

#: Names of public vocabulary files: the vocabulary is also there as ranks for the faster byte-pair encoder.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Tokens that the vocabulary adds to the byte pairs; a text that holds one has its id.
ADDED = {"<|endoftext|>": 50256}
#: White space of the vocabulary's pattern, and the length from which runs of it are cut out: its regular expression fails near a million.
_RUNS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_LONG = 1 << 16


def load_encoder(vocabulary: str = VOCABULARY):
    """Byte-pair encoder whose ids equal those of ``tokenizers`` with ``byte_bpe_50k.json`` (held by a test)."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=ADDED)


def id_maker(vocabulary: str = VOCABULARY) -> Callable[[str], list[int]]:
    """Ids of a text with added tokens and with white space of any length.

    The pattern makes one token sequence of a run but for its last character, which goes with the next word (before an added
    token or the end it takes that one too), so a long run is encoded by itself and the text before and after it as usual.
    """
    encoder = load_encoder(vocabulary)
    added = tuple(ADDED)

    def plain(text: str) -> list[int]:
        return encoder.encode(text, allowed_special="all")

    def encode(text: str) -> list[int]:
        # a run of twice the length holds a whole block of white space
        if not any(text[i : i + _LONG].isspace() for i in range(0, len(text) - _LONG + 1, _LONG)):
            return plain(text)
        ids, at = [], 0
        for m in _RUNS.finditer(text):
            if m.end() - m.start() >= _LONG:
                end = m.end() - (m.end() < len(text) and not text.startswith(added, m.end()))
                ids += plain(text[at : m.start()])
                ids += encoder._encode_single_piece(text[m.start() : end])
                at = end
        return ids + plain(text[at:])

    return encode


def token_pieces(docs: DataFrame, capacity: int = 1024, end_id: int = 2, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of ``doc_id, text``; a longer document's first piece is the short one.

    A null text is empty, that is one end token.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = id_maker(vocabulary)
        for batch in text_chunks(batches, "text", 8 << 20):
            rows, piece, start, length, crc = [], [], [], [], []
            for r, text in enumerate(batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                at, n = 0, len(ids) % capacity or capacity
                while at < len(ids):
                    rows.append(r)
                    piece.append(piece[-1] + 1 if at else 0)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(ids[at : at + n].tobytes()))
                    at, n = at + n, capacity
            columns = [pa.array(x, t) for x, t in ((piece, pa.int32()), (start, pa.int64()), (length, pa.int64()), (crc, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def plan_slots(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: ``(length, first_rank, stop_rank, first_sequence, per, offset)`` rows."""
    slots: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []
    opened = 0

    def free(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in gaps:
                gaps[space] = []
                bisect.insort(spaces, space)
            gaps[space].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            k = bisect.bisect_left(spaces, length)
            if k < len(spaces):
                space = spaces[k]
                first, n = gaps[space].pop()
                if not gaps[space]:
                    del gaps[space]
                    spaces.pop(k)
            else:
                space, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            per = space // length
            whole = min(n, left // per)
            per, used = (per, whole) if whole else (left, 1)
            slots.append((length, rank, rank + used * per, first, per, capacity - space))
            free(space - per * length, first, used)
            free(space, first + used, n - used)
            rank, left = rank + used * per, left - used * per
    return slots


def pack(pieces: DataFrame, capacity: int = 1024, part_rows: int = 50_000) -> DataFrame:
    """``pieces`` (``doc_id, piece, start, length, ids_crc32``) plus ``sequence_id`` and ``offset``.

    A piece of ``capacity`` tokens is a sequence by itself, with a negative number, and takes no part in the plan.  The others are ranked
    within their length, in parts of about ``part_rows`` rows.  The histogram has fewer than ``capacity`` rows and the plan, which is
    broadcast, a small multiple of them.
    Pieces longer than ``capacity`` are a caller's error; equal rows each get a place; an empty table gives
    an empty result.
    """
    spark = pieces.sparkSession
    pieces = checkpoint(pieces)
    full = pieces.where(F.col("length") == capacity).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = pieces.where(F.col("length") != capacity)
    parts = max(1, -(-short.count() // part_rows))
    rows = short.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int"))
    counts = checkpoint(rows.groupBy("length", "_part").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if histogram and max(histogram) > capacity:
        raise ValueError(f"a piece is longer than {capacity}")
    slots = spark.createDataFrame(plan_slots(histogram, capacity), "slot_length long, first long, stop long, sequence long, per long, base long")
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = rows.join(starts, ["length", "_part"]).withColumn("_rank", F.col("_before") + F.row_number().over(within) - 1)
    placed = ranked.join(F.broadcast(slots), F.expr("length = slot_length and _rank >= first and _rank < stop"))
    place = F.col("_rank") - F.col("first")
    sequence = F.col("sequence") + F.floor(place / F.col("per"))
    placed = placed.select(
        *[F.col(c) for c in pieces.columns], sequence.cast("long").alias("sequence_id"), (F.col("base") + place % F.col("per") * F.col("length")).alias("offset")
    )
    return placed.union(full)
