"""Toxicity by a misspelling-tolerant lexicon and the context of each hit.

The lexicon is a trie.  A Levenshtein automaton runs beside it: a state is the set of ``(trie node, edits so far)`` that the letters
read until now allow, where an edit is a letter left out, added, replaced or swapped with its neighbour, and
repeated letters and look-alike signs cost nothing; the first letter has to be right.  States and steps are made when first met and kept, so a word costs one table
look-up a letter, and most words reach the empty state after two or three.

A hit counts by its context window: quotation marks around it and words of reporting lower its score, words that address
someone raise it.  A document's features are made of these scores, and logistic regression on labelled documents turns
them into a probability.  Words far more frequent in toxic training documents than in others join the lexicon.

Labels are read only from documents whose ``crc32(doc_id)`` leaves a remainder of ``folds`` other than 0; at most about
``sample_rows`` of them, chosen by a hash, are used.  A score sees nothing but the text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankfold.llm.common import drop_columns, hash_sample, text_chunks, words_of

#: Terms that start the lexicon.
TERMS = (
    "idiot", "moron", "loser", "scum", "stupid", "worthless", "pathetic", "disgusting", "trash", "dumb", "imbecile", "bastard", "retard",
    "idiotisch", "dummkopf", "abschaum", "arschloch", "trottel", "connard", "salaud", "abruti", "estupido", "imbecil", "pendejo",
)
#: Words of reporting, and words that address someone.
REPORTING = frozenset(
    "said says say called calls quoted quote quotes wrote writes term word words phrase insult insults slur shouted according "
    "sagte sagt nannte wort begriff zitat dit disait appelait terme mot dijo dice llamó palabra término".split()
)
ADDRESSING = frozenset("you your you're youre u ur du dich dein ihr tu toi ton vous votre tú usted ustedes he she they".split())
LOOKALIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_STRIP = ".,;:!?\"'()[]{}<>«»“”„‘’…*_~`#%&-|/\\"
_OPEN, _CLOSE = "\"“„«‘", "\"”»“’"

WINDOW = 12
#: States of the automaton kept between two words.
ROOM = 20_000
FEATURES = ("bias", "score", "share", "most", "kinds", "misspelt", "quoted")
#: Weights without training rows of both kinds.
PRIOR = (-3.0, 2.0, 0.3, 1.0, 0.0, 0.0, 0.0)


def edits_of(term: str) -> int:
    """Edits that a term of this length forgives."""
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Matcher:
    """The lexicon trie with its Levenshtein automaton, determinised as words are read."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.budget = [0]
        self.letter = [""]
        for t in sorted(set(terms)):
            node = 0
            self.budget[0] = max(self.budget[0], edits_of(t))
            for c in t:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.budget.append(0)
                    self.letter.append(c)
                node = self.children[node][c]
                self.budget[node] = max(self.budget[node], edits_of(t))
            self.term[node] = t
        self._forget()

    def _forget(self) -> None:
        """Only the empty and the start state are known; the others are made again when met."""
        self.ids: dict[frozenset, int] = {frozenset(): 0}
        self.states = [frozenset()]
        self.steps: list[dict[str, int]] = [{}]
        self.ends: list[tuple[str, int] | None] = [None]
        self.start = self._state(frozenset([(0, 0, "")]))

    def _closed(self, made: dict) -> frozenset:
        """With the states that leave out letters of the term."""
        queue = list(made)
        out = set(queue)
        while queue:
            node, e, wait = queue.pop()
            if not wait:
                for child in self.children[node].values():
                    more = (child, e + 1, "")
                    if e < self.budget[child] and more not in out:
                        out.add(more)
                        queue.append(more)
        least: dict[tuple[int, str], int] = {}
        for node, e, wait in out:
            least[node, wait] = min(e, least.get((node, wait), e))
        return frozenset((node, e, wait) for (node, wait), e in least.items())

    def _state(self, state: frozenset) -> int:
        if state not in self.ids:
            self.ids[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
            ends = [(e, self.term[node]) for node, e, wait in state if not wait and self.term[node] and e <= edits_of(self.term[node])]
            self.ends.append((min(ends)[1], min(ends)[0]) if ends else None)
        return self.ids[state]

    def _step(self, number: int, c: str) -> int:
        made: dict[tuple[int, int, str], None] = {}
        same = c + LOOKALIKE.get(c, "")
        for node, e, wait in self.states[number]:
            if wait:  # the second of two swapped letters
                if c == wait:
                    made[node, e, ""] = None
                continue
            if self.letter[node] and self.letter[node] in same:
                made[node, e, ""] = None
            if node and e < self.budget[node]:
                made[node, e + 1, ""] = None
            for letter, child in self.children[node].items():
                if letter in same:
                    made[child, e, ""] = None
                elif node and e < self.budget[child]:
                    made[child, e + 1, ""] = None
                    swapped = self.children[child].get(c)
                    if swapped is not None and e < self.budget[swapped]:
                        made[swapped, e + 1, letter] = None
        self.steps[number][c] = out = self._state(self._closed(made))
        return out

    def find(self, word: str) -> tuple[str, int] | None:
        """The term nearest to the word, with its edits, or None; ties go to the first by alphabet."""
        if len(self.states) > ROOM:
            self._forget()
        number = self.start
        for c in word:
            step = self.steps[number].get(c)
            number = self._step(number, c) if step is None else step
            if not number:
                return None
        return self.ends[number]


class Hits(dict):
    """Token to ``(term, edits)`` or None; every distinct token is matched once.  ``weight`` has the terms' weights."""

    def __init__(self, terms: dict[str, float], room: int = 1 << 20):
        super().__init__()
        self.matcher, self.weight, self.room = Matcher(list(terms)), terms, room

    def __missing__(self, token: str):
        if len(self) >= self.room:
            self.clear()
        bare = token.strip(_STRIP)
        found = self.matcher.find(bare.lower()) if bare else None
        self[token] = found
        return found


def quoted(words: list[str], at: int) -> bool:
    """Whether word ``at`` stands between quotation marks that open and close within the window."""
    opened = False
    for k in range(max(0, at - WINDOW), at + 1):
        if k < at and opened and words[k].rstrip(".,;:!?)")[-1:] in _CLOSE and words[k].rstrip(".,;:!?)"):
            opened = False
        elif words[k].lstrip("(")[:1] in _OPEN and words[k].lstrip("("):
            bare = words[k].rstrip(".,;:!?)")
            opened = k == at or not (len(bare) > 1 and bare[-1] in _CLOSE)
    return opened and any(w.rstrip(".,;:!?)")[-1:] in _CLOSE and w.rstrip(".,;:!?)") for w in words[at : at + WINDOW])


def context(words: list[str], at: int) -> tuple[float, bool]:
    """Score of a hit in its window, 0 to 1, and whether it is quoted."""
    near = [w.strip(_STRIP).lower() for w in words[max(0, at - WINDOW) : at + WINDOW + 1]]
    marks = quoted(words, at)
    z = 1.0 - 4.0 * marks - 1.5 * any(w in REPORTING for w in near) + 0.5 * any(w in ADDRESSING for w in near)
    return 1.0 / (1.0 + np.exp(-z)), marks


def features(words: list[str], hits: Hits) -> list[float]:
    """One number for each of ``FEATURES``."""
    found = [(k, h) for k, w in enumerate(words) if (h := hits[w]) is not None]
    total = most = misspelt = inside = 0.0
    kinds = set()
    for k, (term, edits) in found:
        score, marks = context(words, k)
        score *= hits.weight[term]
        inside += marks
        if edits:
            misspelt += score
        else:
            total += score
            kinds.add(term)
            most = max(most, score)
    return [1.0, float(np.log1p(total)), float(np.log1p(100.0 * total / max(len(words), 1))), most, float(np.log1p(len(kinds))), float(np.log1p(misspelt)), float(np.log1p(inside))]


def held_out(folds: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))


def _training(docs: DataFrame, labels: DataFrame, folds: int, sample_rows: int, seed: int) -> DataFrame:
    """``h, text, toxic`` of about ``sample_rows`` labelled documents outside fold 0.  The labels are thinned first, so what is broadcast has that bound."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(folds))
    known = hash_sample(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), F.xxhash64("doc_id", F.lit(seed)), sample_rows)
    return docs.select("doc_id", "text").where("text is not null").join(F.broadcast(known), "doc_id").select(F.xxhash64("doc_id", "text").alias("h"), "text", "toxic")


def _evidence(counts: DataFrame, bad: int, good: int, evidence: float, odds: float) -> DataFrame:
    """``word, ratio`` of the words whose counts ``b`` and ``g`` differ by a likelihood ratio (G squared) of ``evidence`` and a factor of ``odds``."""
    b, g, share = F.col("b"), F.col("g"), bad / (bad + good)
    gain = b * F.log(b / ((b + g) * share)) + F.when(g > 0, g * F.log(g / ((b + g) * (1 - share)))).otherwise(0.0)
    ratio = (b / bad) / ((g + 0.5) / good)
    return counts.where((b > 0) & (2 * gain >= evidence) & (ratio >= odds)).select("word", ratio.alias("ratio"))


def learned_terms(training: DataFrame, evidence: float = 15.0, odds: float = 10.0) -> dict[str, float]:
    """Words (letters only, four or more) far more frequent in toxic texts, with a weight of 0.3 to 1 that rises with the ratio.

    First texts are counted, a repeated text once; then, for the words that pass, the different pairs of neighbours they have, so that the
    words of a passage with many near copies don't look like evidence.
    """
    training = training.select("h", "text", "toxic").dropDuplicates(["h"])
    sizes = {r["toxic"]: r["count"] for r in training.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return {}

    def plain(text: str) -> list[str]:
        return [w.strip(_STRIP).lower() for w in words_of(text)]

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            seen: Counter = Counter()
            for text, toxic in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                seen.update((w, toxic) for w in set(plain(text)) if len(w) >= 4 and w.isalpha())
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in seen], pa.string()), pa.array([t for _, t in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())], ["word", "toxic", "c"])

    def sums(df: DataFrame) -> DataFrame:
        by = {1: "b", 0: "g"}
        return df.groupBy("word").agg(*(F.sum(F.when(F.col("toxic") == t, F.col("c")).otherwise(0)).alias(n) for t, n in by.items()))

    often = {r["word"] for r in _evidence(sums(training.mapInArrow(texts, "word string, toxic int, c long")), bad, good, evidence, odds).select("word").collect()}

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            rows = set()
            for text, toxic in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = ["", *plain(text), ""]
                rows.update((words[k], toxic, words[k - 1], words[k + 1]) for k in range(1, len(words) - 1) if words[k] in often)
            cells = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 1 else pa.string()) for k, c in enumerate(cells)], ["word", "toxic", "before", "after"])

    places = training.mapInArrow(neighbours, "word string, toxic int, before string, after string").distinct().withColumn("c", F.lit(1))
    kept = _evidence(sums(places), bad, good, evidence, odds)
    return {r["word"]: round(float(np.clip(np.log(r["ratio"]) / np.log(50.0), 0.3, 1.0)), 6) for r in kept.orderBy("word").collect()}


def fit(docs: DataFrame, labels: DataFrame, terms: tuple[str, ...] = TERMS, folds: int = 5, sample_rows: int = 10_000, ridge: float = 1.0, seed: int = 11) -> dict:
    """``terms`` and ``weights`` from the labelled documents outside fold 0; labels other than 0 and 1 are not read.

    Without training rows of both kinds the weights are ``PRIOR``.
    """
    training = _training(docs, labels, folds, sample_rows, seed).where("toxic in (0, 1)")
    terms = {**dict.fromkeys(terms, 1.0), **learned_terms(training)}
    width = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = Hits(terms)
        for batch in text_chunks(batches, "text"):
            x = np.array([features(words_of(t), hits) for t in batch.column(1).to_pylist()]).reshape(-1, width)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(x[:, k]) for k in range(width))], ["h", "toxic", *FEATURES])

    # about sample_rows rows of a few numbers; sorted, so that sums do not depend on the order of tasks
    table = training.mapInArrow(run, "h long, toxic int, " + ", ".join(f"{f} double" for f in FEATURES)).toPandas().sort_values(["h", "toxic"])
    y, x = table["toxic"].to_numpy(float), table[list(FEATURES)].to_numpy(float)
    weights = np.array(PRIOR)
    if 0 < y.sum() < len(y):
        hold = np.diag([1e-3, *[ridge] * (width - 1)])
        weights = np.zeros(width)
        for _ in range(50):
            p = 1.0 / (1.0 + np.exp(-x @ weights))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold, x.T @ (y - p) - hold @ weights)
            weights = weights + step
            if np.abs(step).max() < 1e-9:
                break
    return {"terms": terms, "weights": weights.tolist()}


def score(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1), ``predicted`` (1 where the score reaches ``threshold``), ``n_hits``, ``n_quoted`` and ``hits``.

    ``hits`` lists ``term:edits:word number``.  A null or empty text has no hits.  Columns of these names, in any case, are replaced; the others
    stay; rows that repeat are scored alike.
    """
    made = ["score", "predicted", "n_hits", "n_quoted", "hits"]
    docs = drop_columns(docs, made)
    names = docs.columns
    at = names.index("text")
    weights, terms = np.array(model["weights"]), model["terms"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = Hits(terms)
        for batch in text_chunks(batches, "text"):
            x, many, marked, listed = [], [], [], []
            for text in batch.column(at).to_pylist():
                words = words_of(text or "")
                found = [(k, h) for k, w in enumerate(words) if (h := hits[w]) is not None]
                x.append(features(words, hits) if found else [1.0, *[0.0] * (len(FEATURES) - 1)])
                many.append(len(found))
                marked.append(sum(quoted(words, k) for k, _ in found))
                listed.append(",".join(f"{term}:{edits}:{k}" for k, (term, edits) in found))
            p = 1.0 / (1.0 + np.exp(-np.array(x).reshape(-1, len(weights)) @ weights))
            columns = [pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array(many, pa.int64()), pa.array(marked, pa.int64()), pa.array(listed, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*names, *made])

    schema = StructType(docs.schema.fields[:])
    for name, kind in zip(made, ("double", "integer", "long", "long", "string"), strict=True):
        schema = schema.add(name, kind)
    return docs.mapInArrow(run, schema)
