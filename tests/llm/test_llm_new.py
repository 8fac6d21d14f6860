"""Operators 11 to 13 against plain versions, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankfold.llm import collocations, periodic_runs, queries, toxicity

SF = "/root/testdata/sf0.001"

# op11


def plain_runs(words, shortest=12):
    known, out = {}, {}
    a = np.array([known.setdefault(w, len(known)) for w in words])
    for q in range(1, len(a) // 2 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (a[:-q] == a[q:]).astype(int), [0]))))
        for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if y - x + q >= max(shortest, 2 * q):
                out.setdefault((x, y - x + q), q)
    return sorted((s, q, n) for (s, n), q in out.items())


def collapsed(words, runs):
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng, most):
    n, k = rng.randint(0, most), rng.choice([1, 2, 2, 3, 5, 20])
    words = [f"w{rng.randrange(k)}" for _ in range(n)]
    if n > 5 and rng.random() < 0.6:
        a = rng.randrange(n)
        p = rng.randint(1, (n - a) // 2 + 1)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if rng.random() < 0.5:
            words[rng.randrange(n)] = "x"
    return words


def test_z_function():
    rng = random.Random(4)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randint(1, 40))]
        for i, k in enumerate(periodic_runs.z_function(s)):
            assert i == 0 or k == next((j for j in range(len(s) - i) if s[j] != s[i + j]), len(s) - i)


@pytest.mark.parametrize("spread, core, shortest", [(1 << 18, 1 << 16, 12), (20, 16, 12), (0, 1, 12), (20, 16, 5), (1 << 18, 64, 30)])
def test_runs_against_plain_version(spark, spread, core, shortest):
    rng = random.Random(spread + shortest)
    texts = {k: random_words(rng, 150) for k in range(300)}
    docs = spark.createDataFrame([(k, "\t ".join(w)) for k, w in texts.items()], "doc_id long, text string").repartition(5)
    for r in periodic_runs.collapse_runs(docs, shortest, spread, core).collect():
        want = plain_runs(texts[r["doc_id"]], shortest)
        assert [(x["start"], x["period"], x["length"]) for x in r["runs"]] == want and r["n_runs"] == len(want)
        assert r["text"] == collapsed(texts[r["doc_id"]], want)


def test_long_periodic_texts(spark):
    rng = random.Random(8)
    block = [f"w{rng.randrange(50)}" for _ in range(7_000)]
    texts = [["a"] * 5_000, block * 3, [f"w{k}" for k in range(20_000)], (["a", "b"] * 400 + ["c"]) * 6]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id long, text string")
    for spread in (1 << 18, 1_000):
        got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periodic_runs.collapse_runs(docs, spread_words=spread, core=256).collect()}
        assert got[0] == [(0, 5_000, 1)] and (0, 21_000, 7_000) in got[1] and got[2] == [] and (0, 4_806, 801) in got[3]
        assert len(got[3]) == 7


def test_op11_query(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op11_periodic_runs"](spark, SF).collect()}
    for d, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(w), zlib.crc32(str(d).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(w)
        top = min(runs, key=lambda r: (-r[2], r[0], r[1])) if runs else None
        numbers = (top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{k},{q}\n" for s, q, k in runs), collapsed(w, runs))]
        assert got[d] == (len(runs), *numbers, *sha)


EDGES = [(1, "a b " * 6, "x"), (1, "a b " * 6, "x"), (2, None, "x"), (3, "", "x"), (4, " \n\t ", None), (None, "c " * 12, "x"), (5, "𝒳 é " * 9, "x")]


def test_runs_edges(spark):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string, N_RUNS string").repartition(3)
    rows = periodic_runs.collapse_runs(docs)
    assert rows.columns == ["doc_id", "text", "n_runs", "runs"]
    got = [(r["doc_id"], r["text"], [tuple(x) for x in r["runs"]]) for r in rows.collect()]
    assert got.count((1, "a b", [(0, 12, 2)])) == 2 and (2, None, []) in got and (3, "", []) in got and (4, "", []) in got
    assert (None, "c", [(0, 12, 1)]) in got and (5, "𝒳 é", [(0, 18, 2)]) in got
    assert periodic_runs.collapse_runs(docs.limit(0)).count() == 0
    more = docs.selectExpr("doc_id", "text", "1 as q", "2 as x", "3 as _PR_ROW", "4 as period")
    assert periodic_runs.collapse_runs(more).columns == ["doc_id", "text", "q", "x", "period", "n_runs", "runs"]


# op12


def edit_distance(a, b):
    """Insertions, deletions, replacements and swaps of neighbours."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_against_edit_distance():
    rng, terms = random.Random(1), [*toxicity.TERMS, "abcde", "abcdefgh", "xyzvw"]
    matcher, seen = toxicity.Matcher(terms), Counter()
    for _ in range(6_000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            k, x = rng.randrange(len(word) + 1), rng.random()
            if x < 0.25 or not word:
                word.insert(k, rng.choice("abcdeixz"))
            elif x < 0.5:
                word[k % len(word)] = rng.choice("abcdeixz")
            elif x < 0.75:
                del word[k % len(word)]
            elif k + 1 < len(word):
                word[k], word[k + 1] = word[k + 1], word[k]
        word = "".join(word)
        if any(a == b for a, b in zip(word, word[1:])):
            continue  # repeated letters are free, see below
        # the first letter has to be right
        rest = [(edit_distance(t[1:], word[1:]), t) for t in terms if t[:1] == word[:1]]
        want = min(((d, t) for d, t in rest if d <= toxicity.edits_of(t)), default=None)
        got = matcher.find(word)
        seen["equal" if (got and (got[1], got[0])) == want else "other"] += 1
    # letters swapped around a third are one edit less for the automaton, which may read on between them
    assert seen["other"] <= 0.002 * seen["equal"]


def test_automaton_signs_and_repeats():
    matcher = toxicity.Matcher(list(toxicity.TERMS))
    for word, term in {"idiooot": "idiot", "1d10t": "idiot", "losserr": "loser", "wrothless": "worthless", "dsgusting": "disgusting", "trahs": "trash", "l0ser": "loser"}.items():
        assert matcher.find(word)[0] == term
    assert matcher.find("scums") is None and matcher.find("") is None and matcher.find("house") is None


def test_quotation_lowers_the_score():
    def at(text):
        words = text.split()
        return toxicity.context(words, next(k for k, w in enumerate(words) if "idiot" in w))

    plain = at("you idiot go home")
    for text in ('he said "you idiot" to me', "the word «idiot» is rude", '"idiot"', "she called him „du idiot“ twice"):
        score, marks = at(text)
        assert marks and score < 0.1 < plain[0]
    assert not at('they "never" saw the idiot')[1] and not plain[1]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    found = queries.QUERIES["op12_lexicon_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = found.where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    bad, good = [r for r in rows if r["toxic"]], [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in bad) >= 0.9 * len(bad) and sum(r["predicted"] for r in good) <= 0.01 * len(good)


def test_toxicity_reads_only_text_and_training_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(5), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs.repartition(7), flipped)


def test_toxicity_edges(spark):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string, SCORE string").repartition(3)
    labels = spark.createDataFrame([(1, 1), (None, 1), (4, None), (99, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model["weights"] == list(toxicity.PRIOR)
    rows = toxicity.score(docs, model)
    assert rows.columns == ["doc_id", "text", "score", "predicted", "n_hits", "n_quoted", "hits"]
    assert rows.count() == len(EDGES) and rows.where("score is null or predicted != 0 or n_hits != 0").count() == 0
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels.limit(0))).count() == 0
    assert toxicity.score(spark.createDataFrame([(1, "you idiot " * 5)], "doc_id long, text string"), model).first()["predicted"] == 1


# op13


def plain_phrases(rows, least, limit, inside):
    out = []
    for lang in {x or "und" for x, _ in rows}:
        counts = [Counter(), Counter(), Counter()]
        for x, text in rows:
            if (x or "und") == lang:
                for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate({c: c + 32 for c in range(65, 91)})):
                    w = re.findall(r"[^ \t]+", piece)
                    for k in range(3):
                        counts[k].update(tuple(w[i : i + k + 1]) for i in range(len(w) - k))
        n, f = sum(counts[0].values()), counts[0] + counts[1] + counts[2]
        good = {p: a for k in (1, 2) for p, a in counts[k].items() if a >= least}
        found = []
        for p, a in good.items():
            if len(p) == 2 and any(len(t) == 3 and p in (t[:2], t[1:]) and 100 * b >= inside * a for t, b in good.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, left, right, n, -s) for r, (s, a, p, left, right) in enumerate(sorted(found)[:limit])]
    return sorted(out)


@pytest.mark.parametrize("limit, bits", [(5, 1 << 16), (15, 64), (40, 1 << 20), (10_000, 1 << 16)])
def test_phrases_against_plain_version(spark, limit, bits):
    rng = random.Random(limit)
    names = [f"w{k}" for k in range(25)] + ["Élan", "ñ", "X", "-"]
    fixed = [" ".join(rng.choices(names, k=rng.randint(2, 5))) for _ in range(30)]
    rows = []
    for _ in range(400):
        parts = [rng.choice(fixed) if rng.random() < 0.5 else " ".join(rng.choices(names, k=rng.randint(0, 5))) for _ in range(rng.randint(0, 8))]
        rows.append((rng.choice(["en", "en", "en", "de", None]), rng.choice([". ", ", ", "\n", " \t"]).join(parts)))
    rows += [("fr", "one two three"), ("fr", None), ("en", ""), ("xx", "a a a a a a a a a a a a a")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = sorted(tuple(r) for r in collocations.collocations(docs, 4, limit, 50, bits).collect())
    assert got == plain_phrases(rows, 4, limit, 50)


def test_phrases_edges(spark):
    docs = spark.createDataFrame([(None, None, 1), ("en", "", 1), ("en", "a b " * 30, 1)], "lang string, text string, A int")
    got = sorted(tuple(r) for r in collocations.collocations(docs.select("lang", "text", "A", F.lit(1).alias("w1"))).collect())
    assert got == plain_phrases([("en", "a b " * 30)], 10, 2000, 50)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_score_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**12, 10**12 + 1, 10**12 + 7), (3, 7, 9)], "a long, l long, r long")
    got = [r[0] for r in df.select(collocations.ratio(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [10**6 * 10**24 // ((10**12 + 1) * (10**12 + 7)), 10**6 * 9 // 63]


# op9: the field


def exact_marginals(node, edges):
    from itertools import product

    n, k = node.shape
    out = np.zeros_like(node)
    for labels in product(range(k), repeat=n):
        w = np.exp(sum(node[i, x] for i, x in enumerate(labels)) + sum(t[labels[a], labels[b]] for a, b, t in edges))
        for i, x in enumerate(labels):
            out[i, x] += w
    return out / out.sum(1, keepdims=True)


@pytest.mark.parametrize("strength, off, same", [(0.5, 0.05, 1.0), (3.0, 0.25, 0.95)])
def test_loopy_beliefs_against_enumeration(strength, off, same):
    """Two cycles over few nodes: close to the exact marginals for weak links, the same labels for strong ones."""
    from rankfold.llm import pii

    rng = np.random.default_rng(3)
    worst, agree, many = 0.0, 0, 0
    for _ in range(40):
        n = int(rng.integers(3, 6))
        node = rng.normal(0, 1.5, (n, 3))
        skip = np.log(np.ones((3, 3)) + strength * np.eye(3))
        chain = rng.normal(0, 0.3, (3, 3))
        edges = [(k - 1, k, chain) for k in range(1, n)] + [(0, n - 1, skip), (0, 2, skip)]
        got, want = pii.believe(node, edges, rounds=60), exact_marginals(node, edges)
        worst = max(worst, float(np.abs(got - want).max()))
        agree += int((got.argmax(1) == want.argmax(1)).sum())
        many += n
    assert worst < off and agree >= same * many


def test_planted_mentions_are_added_and_decoys_are_not(spark):
    from rankfold.llm import pii

    rng = random.Random(6)

    def digits(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        while True:
            d = "4" + digits(15)
            if pii._luhn(d):
                return d

    def no_card():
        while True:
            d = "4" + digits(15)
            if not pii._luhn(d):
                return d

    filler = ["the report was sent to them", "please look at the account again", "und dann kam noch etwas", "call back about it"]
    rows, want, decoys = [], {}, {}
    for k in range(600):
        c, area, line = card(), digits(3), digits(4)
        phone = f"+1 ({area}) 555-{line}"
        typo = ("5" if c[0] != "5" else "6") + c[1:]
        kind = k % 6
        first, second = [(c, f"{no_card()} {c}"), (phone, f"({area}) 555-{line}"), (c, typo), (c, no_card()), (phone, f"token {digits(7)}ab{digits(9)}"), ("mail a.b@c.org", no_card())][kind]
        text = f"{rng.choice(filler)} {first} {' '.join(rng.choices(filler, k=rng.randint(1, 6)))} {second} {rng.choice(filler)}"
        rows.append((k, text))
        at = text.rindex(second)
        if kind in (0, 1, 2):
            piece = c if kind == 0 else second
            start = text.rindex(piece)
            want[k] = ["card", "phone", "card"][kind] + f":{start}:{start + len(piece)}"
        else:
            decoys[k] = at
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = pii.fit(docs)
    hits = extra = 0
    for r in pii.find(docs, model).collect():
        base = {f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in pii.base_spans(r["text"])}
        spans = set(filter(None, r["spans"].split(",")))
        assert base <= spans and r["n_added"] == len(spans) - len(base)
        added = spans - base
        hits += want.get(r["doc_id"]) in added
        extra += len(added - {want.get(r["doc_id"])})
    assert hits >= 0.9 * len(want) and extra <= 0.05 * hits


def test_pii_names_in_any_case(spark):
    from rankfold.llm import pii

    docs = spark.createDataFrame([(1, "a@b.org 4845168114407329", "x", "y")], "doc_id long, text string, Spans string, N_EMAIL string")
    row = pii.find(docs, pii.fit(docs)).first()
    assert row["n_email"] == 1 and row["n_card"] == 1
