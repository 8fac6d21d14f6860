"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns give the base spans.  Nodes of the field are the mentions of a document: base spans, whose
labels are observed, and other long digit runs and tokens with an at sign, whose labels are hidden: a card number in a
run that is too long for one, a phone number without its plus, a number with a wrong digit.
Neighbouring mentions share a chain potential; mentions with equal or similar keys (the same digits, the
same last digits, the same address) share a skip potential however far apart they are.  Loopy belief
propagation, in every document with a hidden mention and another one, gives the hidden labels, and a hidden mention that takes
the label of a mention it is linked with becomes a span too, so one entity has one label throughout its document.

Node potentials are a logistic function of the mention's shape and checksum, of what it is glued to, of the separator and the word
before it.  The labels of hidden mentions are latent in training: expectation-maximisation alternates between beliefs over the
whole sample and weights fitted to them, on a bounded sample of documents.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankfold.llm.common import drop_columns, hash_sample, text_chunks

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
#: Characters between two mentions up to which they are neighbours in the chain.
GAP = 80

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_RUN = re.compile(r"\(?[0-9](?:[\x20().-]{0,2}[0-9])+")
_PIECE = re.compile(r"[^\x20]+")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_ANY = re.compile(r"[0-9@]")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, at sign, domain: from each at sign the local part is read backwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _at_words(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start, end = at, _SPACE.search(text, at)
        while start > done and not _SPACE.match(text, start - 1):
            start -= 1
        done = end.start() if end else len(text)
        yield start, done
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` by kind, then start; ends exclusive, in code points."""
    if not _ANY.search(text):
        return []
    out = [(0, s, e) for s, e in _emails(text)]
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and _luhn(d)]
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def _loose_runs(text: str) -> Iterator[tuple[int, int]]:
    """Runs of seven digits or more with up to two separators between them; cut at blanks where a piece is as long as a card number."""
    for m in _RUN.finditer(text):
        pieces = [p.span() for p in _PIECE.finditer(m[0])]
        long = [(s, e) for s, e in pieces if sum(c.isdigit() for c in m[0][s:e]) >= 12]
        if long:
            yield from ((m.start() + s, m.start() + e) for s, e in long)
        elif sum(c.isdigit() for c in m[0]) >= 7:
            yield m.span()


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Base spans and hidden mentions as ``(start, end, label)`` by start; hidden ones have label -1 and overlap no base span."""
    taken = sorted((s, e) for _, s, e in base)
    rest = [*_loose_runs(text), *_at_words(text)]
    out, k = [(s, e, kind) for kind, s, e in base], 0
    for s, e in sorted(rest):
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        if k == len(taken) or taken[k][0] >= e:
            out.append((s, e, -1))
    return sorted(out)


#: Hashed classes of the word before a mention.
WORDS = 32


def features(text: str, s: int, e: int) -> list[float]:
    """Shape, checksum and context of a mention."""
    m = text[s:e]
    digits = _digits(m)
    n = len(digits)
    sizes = [7 <= n < 9, 9 <= n < 13, 13 <= n < 16, n == 16, 17 <= n < 20, n >= 20]
    marks = ["+" in m or text[s - 1 : s] == "+", "@" in m, m.count(".") == 3, "-" in m, " " in m, "(" in m, any(c.isalpha() for c in m)]
    checksum = [13 <= n <= 19 and _luhn(digits), 13 <= n <= 19 and not _luhn(digits)]
    glued = [text[max(s - 1, 0) : s].isalnum(), text[e : e + 1].isalnum()]
    before = text[max(s - 40, 0) : s]
    word = re.findall(r"\w+", before)[-1:]
    separators = [before.rstrip(" ")[-1:] in (":", "=", "#") and before != "", before[-1:] in ("\"", "'", "(", "[", "<") and before != ""]
    place = [0.0] * WORDS
    if word:
        place[zlib.crc32(word[0].lower().encode()) % WORDS] = 1.0
    return [1.0, *map(float, [*sizes, *marks, *checksum, *glued, *separators]), *place]


def keys(text: str, s: int, e: int) -> list[str]:
    """Two mentions that share a key are linked."""
    m = text[s:e]
    if "@" in m:
        return ["@" + m.lower().strip(".,;:!?()[]<>{}\"'")]
    d = _digits(m).lstrip("0")
    return [d, "~" + d[-8:]] if len(d) >= 8 else [d]


def links(text: str, nodes: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Each mention with the one before it and the first one of the same key: linear in the mentions of a key."""
    first: dict[str, int] = {}
    last: dict[str, int] = {}
    out = set()
    for k, (s, e, _) in enumerate(nodes):
        for key in keys(text, s, e):
            if key in last:
                out |= {(last[key], k), (first[key], k)}
            first.setdefault(key, k)
            last[key] = k
    return sorted(out)


def _logistic(x: np.ndarray, target: np.ndarray, node: np.ndarray, rounds: int, ridge: float = 1e-3) -> np.ndarray:
    """Weights that make ``softmax(x @ node)`` follow ``target`` (a distribution a row), from ``node`` on."""
    for _ in range(rounds if len(x) else 0):
        z = x @ node
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        node = node - 2.0 * (x.T @ (p - target) / len(x) + ridge * node)
    return node


def fit(docs: DataFrame, sample_docs: int = 20_000, sample_mentions: int = 20_000, rounds: int = 200, steps: int = 4, agreement: float = 200.0, seed: int = 5) -> dict[str, np.ndarray]:
    """Weights from the mentions of about ``sample_docs`` documents, chosen by a hash, and at most ``sample_mentions`` of them.

    ``node``: logistic regression of the label on the features; ``chain``: log-ratio of label pairs of
    neighbours to independence; ``skip``: the same for linked mentions, with prior odds ``agreement`` for equal labels.  Both
    start at independence, so labels without evidence get none.  Labels that no pattern gives are latent: they
    start as none (those linked with an observed one are left out of the first fit), and in each of ``steps`` rounds of
    expectation-maximisation are the beliefs under the weights so far.  Without mentions the node weights are zero.
    """
    docs = docs.select("doc_id", "text")
    sample = hash_sample(docs, F.xxhash64("doc_id", F.lit(seed)), sample_docs).where(F.col("text").rlike("[0-9@]"))
    sample = sample.select(F.xxhash64("doc_id", "text").alias("h"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            rows = []
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                nodes = mentions(text, base_spans(text))
                near = links(text, nodes)
                rows += [(h, k, label, features(text, s, e), bool(k) and s - nodes[k - 1][1] <= GAP, [a for a, b in near if b == k]) for k, (s, e, label) in enumerate(nodes)]
            columns = zip(*rows, strict=True) if rows else ([],) * 6
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.bool_(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["h", "k", "label", "x", "chained", "near"])

    seen = sample.mapInArrow(run, "h long, k int, label int, x array<double>, chained boolean, near array<int>").dropDuplicates(["h", "k"])
    table = seen.orderBy("h", "k").limit(sample_mentions).toArrow()
    label = table.column("label").to_numpy().astype(int)
    n, width, labels = len(label), len(features("", 0, 0)), NONE + 1
    x = np.array(table.column("x").to_pylist()).reshape(n, width)
    # the sample as one field, document behind document
    first = np.arange(n) - table.column("k").to_numpy()
    chain_edges = [(k - 1, k) for k, there in enumerate(table.column("chained").to_pylist()) if there]
    skip_edges = [(int(first[k]) + a, k) for k, near in enumerate(table.column("near").to_pylist()) for a in near]
    observed = label >= 0
    belief = np.zeros((n, labels))
    belief[np.arange(n), np.where(observed, label, NONE)] = 1.0
    told = np.ones(n, bool)
    for a, b in skip_edges:
        if observed[a] != observed[b]:
            told[a if observed[b] else b] = False
    node, chain, skip = np.zeros((width, labels)), np.zeros((labels, labels)), np.zeros((labels, labels))
    for _ in range(steps):
        node = _logistic(x[told], belief[told], node, rounds)
        prior = belief.sum(0) + 0.1
        prior /= prior.sum()
        tables = []
        for edges, equal in ((chain_edges, 0.0), (skip_edges, agreement)):
            counts = np.outer(prior, prior) * 10.0 + equal * 10.0 * np.diag(prior)
            seen_by = observed if equal else told  # what links agree on is learnt from the patterns' labels alone
            both = [(a, b) for a, b in edges if seen_by[a] and seen_by[b]]
            if both:
                a, b = np.array(both).T
                pairs = belief[a].T @ belief[b]
                counts += pairs + pairs.T if equal else pairs
            tables.append(np.log(counts / counts.sum() / np.outer(prior, prior)))
        chain, skip = tables
        if not n or observed.all():
            break
        belief = believe(_clamped(x @ node, label), [*((a, b, chain) for a, b in chain_edges), *((a, b, skip) for a, b in skip_edges)])
        told[:] = True
    return {"node": node, "chain": chain, "skip": skip}


def _clamped(score: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Node potentials with observed labels (not negative) made certain."""
    seen = np.flatnonzero(label >= 0)
    score[seen] = -50.0
    score[seen, label[seen]] = 0.0
    return score


def believe(node: np.ndarray, edges: list[tuple[int, int, np.ndarray]], rounds: int = 15, damping: float = 0.3) -> np.ndarray:
    """Sum-product beliefs ``(nodes, labels)`` of a pairwise field with log potentials, by damped loopy message passing."""
    if not edges:
        p = np.exp(node - node.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)
    a = np.array([x for x, _, _ in edges], int)
    b = np.array([x for _, x, _ in edges], int)
    table = np.array([t for *_, t in edges]).reshape(len(edges), *([node.shape[1]] * 2))
    source, target = np.concatenate((a, b)), np.concatenate((b, a))
    potential = np.concatenate((table, table.transpose(0, 2, 1)))
    back = np.concatenate((np.arange(len(a)) + len(a), np.arange(len(a))))
    message = np.zeros((len(source), node.shape[1]))
    for _ in range(rounds):
        total = node.copy()
        np.add.at(total, target, message)
        out = (total[source] - message[back])[:, :, None] + potential
        top = out.max(1)
        new = np.log(np.exp(out - top[:, None, :]).sum(1)) + top
        new -= new.max(1, keepdims=True)
        message = damping * message + (1 - damping) * new
    np.add.at(node := node.copy(), target, message)
    p = np.exp(node - node.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added_spans(text: str, base: list[tuple[int, int, int]], model: dict[str, np.ndarray], threshold: float = 0.9) -> list[tuple[int, int, int]]:
    """Hidden mentions that take the label of a mention they are linked with, at a belief of ``threshold`` or more.

    The field is run wherever there is a hidden mention and another one, hidden or not.
    """
    nodes = mentions(text, base)
    hidden = [k for k, x in enumerate(nodes) if x[2] < 0]
    if not hidden or len(nodes) < 2:
        return []
    near = links(text, nodes)
    score = _clamped(np.array([features(text, s, e) for s, e, _ in nodes]) @ model["node"], np.array([x[2] for x in nodes]))
    chained = [(k - 1, k, model["chain"]) for k in range(1, len(nodes)) if nodes[k][0] - nodes[k - 1][1] <= GAP]
    belief = believe(score, [*chained, *((a, b, model["skip"]) for a, b in near)])
    label = belief.argmax(1)
    partners: dict[int, set[int]] = {}
    for a, b in near:
        partners.setdefault(a, set()).add(int(label[b]))
        partners.setdefault(b, set()).add(int(label[a]))
    return [(int(label[k]), nodes[k][0], nodes[k][1]) for k in hidden if label[k] != NONE and belief[k, label[k]] >= threshold and label[k] in partners.get(k, ())]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, overlapping ones joined, replaced by its kind in brackets."""
    out, done = [], 0
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= done:
            out += [text[done:s], f"[{KINDS[k].upper()}]"]
        done = max(done, e)
    return "".join([*out, text[done:]])


def find(docs: DataFrame, model: dict[str, np.ndarray], redact: bool = False) -> DataFrame:
    """``docs`` plus ``n_email, n_ip, n_card, n_phone, n_added, base_sha256, spans``; ``redact`` also replaces the spans in ``text``.

    The counts and the digest are those of the base spans; ``spans`` has the added ones too.  A null text is
    empty (and stays null).  Columns of these names in ``docs``, in any case, are replaced.
    """
    made = ["n_email", "n_ip", "n_card", "n_phone", "n_added", "base_sha256", "spans"]
    docs = drop_columns(docs, made)
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            counts, digest, spans, texts = [], [], [], []
            for text in batch.column(at).to_pylist():
                base = base_spans(text or "")
                more = added_spans(text, base, model) if text and _ANY.search(text) else []
                counts.append([*(sum(x[0] == k for x in base) for k in range(NONE)), len(more)])
                digest.append(hashlib.sha256(written(base).encode()).hexdigest())
                spans.append(written([*base, *more]))
                if redact:
                    texts.append(redacted(text, [*base, *more]) if base or more else text)
            columns = list(batch.columns)
            if redact:
                columns[at] = pa.array(texts, pa.string())
            numbers = np.array(counts, np.int64).reshape(-1, NONE + 1)
            columns += [*(pa.array(numbers[:, k]) for k in range(NONE + 1)), pa.array(digest, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*names, *made])

    schema = StructType(docs.schema.fields[:])
    for name in made:
        schema = schema.add(name, "long" if name.startswith("n_") else "string")
    return docs.mapInArrow(run, schema)
