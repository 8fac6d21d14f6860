"""Language identification as inference of a multilingual mixture.

Byte trigrams of the lower-cased letters are counted for each language over all training rows.  A document's
trigrams are draws from a mixture of the languages: expectation-maximisation estimates the proportions,
and the set of languages is the one with the best penalised likelihood among one language and the nested
sets of the most present ones.  A set of ``k`` languages costs ``(k - 1) * penalty * ln(n) / 2``, and a trigram
counts a third, as each letter lies in three.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankfold.llm.common import drop_columns, text_bytes, text_chunks

#: Number of hashed trigram classes; a model is ``languages * CLASSES`` numbers.
CLASSES = 1 << 16
UNKNOWN = "und"
#: Bytes of text that a task works on at a time; its arrays hold some hundred bytes for each.
CHUNK = 1 << 19

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document index, trigram class and count, sorted by document, then class."""
    data, ends = text_bytes(texts)
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    # a blank on either side, so that a text of one letter has a trigram too
    low = np.full(len(data) + 2 * len(texts), 0x20, np.uint8)
    low[np.arange(len(data)) + np.repeat(2 * np.arange(len(texts)) + 1, np.diff(ends))] = _FOLD[data]
    ends = ends + 2 * np.arange(len(texts) + 1)
    code = low[:-2].astype(np.uint32) << np.uint32(16) | low[1:-1].astype(np.uint32) << np.uint32(8) | low[2:]
    inside = code != 0x202020
    edge = ends[1:-1]
    edge = np.concatenate((edge - 1, edge - 2))
    inside[edge[(edge >= 0) & (edge < len(inside))]] = False
    at = np.flatnonzero(inside)
    hashed = (code[at] * np.uint32(0x9E3779B1)) >> np.uint32(16)
    doc = np.repeat(np.arange(len(texts)), np.diff(ends))[at]
    key = np.sort(doc << 16 | hashed.astype(np.int64))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(key)))
    key = key[first]
    return key >> 16, key & (CLASSES - 1), count


def trigram_counts(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all rows of ``lang, text``; a task sums what it has read before it emits a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in text_chunks(batches, "text", CHUNK):
            doc, gram, n = trigrams(batch.column(1))
            langs = batch.column(0).dictionary_encode()
            of = langs.indices.to_numpy()[doc]
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                mine = of == k
                found.setdefault(lang, np.zeros(CLASSES, np.int64))
                found[lang] += np.bincount(gram[mine], n[mine], CLASSES).astype(np.int64)
        for lang, counts in found.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["lang", "gram", "n"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, smoothing: float = 0.5, max_languages: int = 500) -> tuple[list[str], np.ndarray]:
    """Languages and their ``(languages, CLASSES)`` trigram probabilities, from all rows of ``lang, text`` with both.

    The result has ``languages * CLASSES`` numbers, whatever the number of rows; more than ``max_languages``
    languages raise.  Without rows there are no languages and every document is ``und``.
    """
    docs = docs.where("lang is not null and text is not null")
    if docs.select("lang").distinct().limit(max_languages + 1).count() > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    table = trigram_counts(docs).toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    total = np.zeros((len(langs), CLASSES))
    row = np.searchsorted(np.array(langs), table.column("lang").to_numpy()) if langs else np.zeros(0, int)
    total[row, table.column("gram").to_numpy()] = table.column("n").to_numpy()
    total += smoothing
    return langs, total / total.sum(1, keepdims=True)


def _segments(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, heads, axis=0)


def mixtures(doc: np.ndarray, gram: np.ndarray, count: np.ndarray, n: int, model: np.ndarray, rounds: int, penalty: float) -> np.ndarray:
    """Language proportions ``(n, languages)`` of the chosen set per document; rows of zeros without a trigram."""
    out = np.zeros((n, len(model)))
    if not len(doc) or not len(model):
        return out
    ids, heads = np.unique(doc, return_index=True)
    likely = np.ascontiguousarray(model[:, gram].T)
    place = np.repeat(np.arange(len(ids)), np.diff(np.append(heads, len(doc))))
    weight = count.astype(np.float64)
    total = _segments(weight, heads)

    def em(rows: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions and log-likelihood for the documents ``rows``, each limited to its allowed languages."""
        mine = np.isin(place, rows) if len(rows) < len(ids) else slice(None)
        p, c = likely[mine], weight[mine]
        h = np.concatenate(([0], np.cumsum(np.diff(np.append(heads, len(doc)))[rows])))[:-1]
        of = np.repeat(np.arange(len(rows)), np.diff(np.append(h, len(c))))
        pi = allowed / allowed.sum(1, keepdims=True)
        for _ in range(rounds):
            share = p * pi[of]
            share *= (c / share.sum(1))[:, None]
            pi = _segments(share, h) / total[rows][:, None]
        return pi, _segments(c * np.log((p * pi[of]).sum(1)), h)

    single = _segments(weight[:, None] * np.log(likely), heads)
    best = single.argmax(1)
    every = np.arange(len(ids))
    pi, full = em(every, np.ones((len(ids), len(model))))
    cost = penalty * np.log(np.maximum(total, 2.0)) / 2
    value = single.max(1) / 3
    chosen = np.zeros_like(pi)
    chosen[every, best] = 1
    order = np.argsort(-pi, axis=1, kind="stable")
    open_ = every[full / 3 - cost > value]  # else no set of several languages can win
    for k in range(2, len(model) + 1):
        if not len(open_):
            break
        allowed = np.zeros((len(open_), len(model)))
        np.put_along_axis(allowed, order[open_, :k], 1, 1)
        got, like = em(open_, allowed)
        gain = like / 3 - (k - 1) * cost[open_]
        better = gain > value[open_]
        chosen[open_[better]], value[open_[better]] = got[better], gain[better]
        open_ = open_[full[open_] / 3 - k * cost[open_] > value[open_]]
    out[ids] = chosen
    return out


def predict(docs: DataFrame, langs: list[str], model: np.ndarray, rounds: int = 12, penalty: float = 2.0) -> DataFrame:
    """``docs`` (with ``text``) plus ``lang_pred``, ``score`` and ``mixture``.

    ``lang_pred`` is the most present language of the chosen set (ties: the first by name), ``score`` its
    proportion, ``mixture`` the set as ``lang:proportion``.  A null text or one without a letter
    is ``und`` with score 0.  The model is broadcast: ``languages * CLASSES`` floats.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model.astype(np.float32))
    docs = drop_columns(docs, ["lang_pred", "score", "mixture"])
    columns = docs.columns
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in text_chunks(batches, "text", CHUNK):
            texts = batch.column(at)
            n = batch.num_rows
            shares = mixtures(*trigrams(texts), n, table, rounds, penalty)
            top = shares.argmax(1) if len(langs) else np.zeros(n, int)
            score = shares.max(1, initial=0.0)
            data, ends = text_bytes(texts)
            letters = np.concatenate(([0], np.cumsum(_FOLD[data] != 0x20)))
            lettered = letters[ends[1:]] > letters[ends[:-1]]
            latin = np.concatenate(([0], np.cumsum((_FOLD[data] != 0x20) & (data < 0x80))))
            for r in np.flatnonzero(lettered & (latin[ends[1:]] == latin[ends[:-1]])):
                lettered[r] = any(c.isalpha() for c in texts[int(r)].as_py())
            known = lettered & (score > 0)
            names = [langs[k] if ok else UNKNOWN for k, ok in zip(top.tolist(), known.tolist(), strict=True)]
            mixture = [",".join(f"{langs[k]}:{row[k]:.3f}" for k in np.argsort(-row, kind="stable") if row[k] >= 0.0005) if ok else "" for row, ok in zip(shares, known.tolist(), strict=True)]
            made = [pa.array(names, pa.string()), pa.array(np.where(known, np.minimum(score, 1.0), 0.0)), pa.array(mixture, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*columns, "lang_pred", "score", "mixture"])

    schema = StructType(docs.schema.fields[:]).add("lang_pred", "string").add("score", "double").add("mixture", "string")
    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether the checksum of the id as text falls in fold 0 (null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows outside fold 0 that have a language, then predict every row; adds ``held_out`` too.

    A null doc_id is in no fold: it is neither held out nor learnt from.
    """
    inside = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    langs, model = fit(docs.where(inside).select("lang", "text"))
    return predict(drop_columns(docs, ["held_out"]), langs, model).withColumn("held_out", held_out(F.col("doc_id")))
