"""Every operator against a plain version, an exact round trip or held-out accuracy."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankfold.llm import bottom_k, fast_sketch, html_layout, language, line_dedup, mixing, packing, pii, pivot_index, queries, url_filter
from rankfold.llm.common import components

SF = "/root/testdata/sf0.001"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# components


def test_components_chain_hub_and_loops(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 400)] + [(5, 5), (None, 3), (900, 899), (898, 899)]
    got = {r["node"]: r["component"] for r in components(frame(spark, edges, "a long, b long")).collect()}
    assert all(got[k] == 100 for k in range(100, 141)) and all(got[k] == 7 for k in range(200, 400))
    assert got[900] == got[899] == got[898] == 898 and 5 not in got and 3 not in got


# op1


def test_block_passes_to_aliases_and_allow_comes_first(spark):
    rules = frame(spark, [("bad.com", "/", "block"), ("good.com", "/", "allow")], "rule_host string, rule_path string, action string")
    link = lambda u: f'<head><link href="{u}" rel="canonical"></head>'
    rows = [
        (1, "http://a.com/1", link("https://bad.com/x")),
        (2, "http://b.com/2#f", '<META HTTP-EQUIV=refresh content="0; url=http://a.com/1">'),
        (3, "https://c.com/3", link("http://bad.com/y?a=1&amp;b=2")),
        (4, "https://good.com/3", link("//c.com/3")),
        (5, "https://d.com/p/5", link("6")),
        (6, "https://d.com/p/6", ""),
        (7, "https://sub.bad.com/", link("http://d.com/p/6")),
    ]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(frame(spark, rows, "page_id long, url string, html string"), rules).collect()}
    assert got[1] == (None, "block") and got[2] == (None, "block")
    assert got[4] == ("good.com/", "allow") and got[3] == (None, "allow")
    assert got[7] == ("bad.com/", "block") and got[5] == got[6] == (None, "block")
    more = frame(spark, [("http://z.com/", "http://a.com/1")], "a string, b string")
    again = url_filter.judge(frame(spark, [*rows, (8, "http://z.com/", None)], "page_id long, url string, html string"), rules, more)
    assert again.where("page_id = 8").first()["verdict"] == "block"


# op2


def test_pivot_index_recall_with_a_large_group(spark):
    rng = np.random.default_rng(3)
    unit = pivot_index.unit
    base = unit(rng.standard_normal((600, 32)))
    noise = unit(rng.standard_normal((200, 32)))
    near = 0.93 * base[:200] + (1 - 0.93**2) ** 0.5 * noise
    group = base[599] + 0.03 * rng.standard_normal((400, 32))
    vectors = np.concatenate((base, near, group)).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    df = frame(spark, rows, "vec_id long, embedding array<float>")
    got = pivot_index.near_vectors(df, block_rows=64).orderBy("vec_id").toPandas()
    u = unit(vectors.astype(np.float64))
    links = (u @ u.T >= 0.9).sum(1) - 1
    assert (got.n_links <= links).all() and got.n_links.sum() >= 0.98 * links.sum()
    assert (got.component_id[800:] == got.component_id[800]).all() and (got.kept == (got.vec_id == got.component_id)).all()


# op3


def test_language_held_out_accuracy_and_mixture(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    got = queries.language_mixture(spark, f"{SF.replace('0.001', '0.01')}").join(docs.select("doc_id", "lang"), "doc_id")
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a")).first()["a"]
    assert right >= 0.97
    texts = {lang: " ".join(r["text"] for r in docs.where(F.col("lang") == lang).orderBy("doc_id").limit(20).collect())[:4000] for lang in ("en", "de")}
    both = texts["en"] + " " + texts["de"]
    langs, model = language.fit(docs.select("lang", "text"))
    row = language.predict(frame(spark, [(1, both), (2, texts["de"])], "doc_id long, text string"), langs, model).orderBy("doc_id").collect()
    share = dict(x.split(":") for x in row[0]["mixture"].split(","))
    assert {"en", "de"} <= set(share) and 0.4 < float(share["en"]) < 0.6 and row[1]["lang_pred"] == "de" and row[1]["score"] > 0.97


def test_trigrams_do_not_cross_documents():
    texts = ["abc", "d", None, "abcabc", "  1", "Ö"]
    doc, gram, count = language.trigrams(pa.array(texts))
    for k, text in enumerate(texts):
        low = b" " + re.sub(rb"[^a-z\x80-\xff]", b" ", (text or "").lower().encode()) + b" " if text != "Ö" else b" " + text.encode() + b" "
        want = sorted(Counter(low[i : i + 3] for i in range(len(low) - 2) if low[i : i + 3].strip()).values())
        assert sorted(count[doc == k].tolist()) == want


def test_short_letters_have_a_language(spark):
    docs = frame(spark, [(k, w * 5, lang) for k, (w, lang) in enumerate([("the cat is here ", "en"), ("der Hund ist groß und schön ", "de")] * 20)], "doc_id long, text string, lang string")
    langs, model = language.fit(docs)
    short = frame(spark, [(k, t) for k, t in enumerate(["a", "ok", "de", "Ö", "1", " ", ""])], "doc_id long, text string")
    found = {r["text"]: r["lang_pred"] for r in language.predict(short, langs, model).collect()}
    assert all(found[t] in ("en", "de") for t in ("a", "ok", "de", "Ö")) and found["1"] == found[" "] == found[""] == "und"


# op4


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def plain_shingles(text, width):
    w = words_of(text)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


@given(st.lists(st.text(alphabet="aAb \n\té😀", max_size=40), min_size=1, max_size=6), st.integers(1, 4))
@settings(max_examples=80, deadline=None)
def test_shingle_sets_match_plain_sets(texts, width):
    h, d = fast_sketch.shingle_sets(pa.array(texts), width)
    plain = [plain_shingles(t, width) for t in texts]
    assert np.bincount(d, minlength=len(texts)).tolist() == [len(s) for s in plain]
    for a in range(len(texts)):
        for b in range(a):
            assert len(np.intersect1d(h[d == a], h[d == b])) == len(plain[a] & plain[b])


def test_word_hashes_do_not_depend_on_the_piece():
    data = np.frombuffer(("alpha beta  gamma\n" * 50 + "x" * 300 + " end").encode(), np.uint8)
    ends = np.array([0, 40, 41, len(data)])
    whole = fast_sketch.word_hashes(data, ends)
    for piece in (1, 7, 64):
        part = fast_sketch.word_hashes(data, ends, piece)
        assert (part[0] == whole[0]).all() and (part[1] == whole[1]).all()


def test_sketch_fills_and_estimates():
    t, rng = 160, np.random.default_rng(1)
    for size, common in ((1, 1), (3, 2), (400, 320), (4000, 2000)):
        a = rng.integers(0, 1 << 63, size, np.uint64)
        b = np.concatenate((a[:common], rng.integers(0, 1 << 63, size - common, np.uint64)))
        sk = fast_sketch.fast_similarity_sketch(np.concatenate((a, b)), np.repeat([0, 1], size), 2, t)
        assert (sk != fast_sketch._EMPTY).all()
        j = common / (2 * size - common)
        assert abs((sk[0] == sk[1]).mean() - j) < 0.16


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(400)]
    base = [rng.choices(vocabulary, k=rng.randint(1, 120)) for _ in range(40)]
    rows = []
    for k in range(240):
        w = list(base[k % 40]) if k % 3 else rng.choices(vocabulary, k=60)
        for _ in range(rng.choice([0, 0, 1, 3, 8])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((k, " ".join(w)))
    rows += [(300 + k, " ".join(base[0][:100] + [f"tail{k}"])) for k in range(150)]
    sets = {k: plain_shingles(t, 2) for k, t in rows}
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = fast_sketch.near_duplicates(frame(spark, rows, "doc_id long, text string").repartition(5), width=2, block_rows=16).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {k: (len(s), root(k), root(k) == k) for k, s in sets.items()}


# op5


def test_layout():
    page = """<!doctype html><title>no</title><style>x{}</style><p>One   two<p>Three <b>four</b>five<br>six
    <ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul><div hidden>no</div><div style="color:red; Display : none">no</div>
    <table><tr><th>Name<th>Qty<tr><td>apple<td>12<tr><td>x &amp; y<td>3</table><pre>  k
   l</pre>tail<script>no</script>"""
    assert html_layout.render(page) == (
        "One two\n\nThree fourfive\nsix\n\n- a\n- b\n 3. c\n 4. d\n- e\n\nName   Qty\napple  12\nx & y  3\n\n  k\n   l\n\ntail"
    )
    assert html_layout.render("<div>" * 30_000 + "deep") == "deep"
    assert html_layout.render("<p>a<div>b</p>c<span>d") == "a\n\nb\n\ncd"


def test_layout_formulas_and_charts():
    show = html_layout.render
    formula = "<mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup>"
    assert show(f"<p>So <math><semantics><mrow>{formula}</mrow><annotation>no</annotation><annotation-xml>no</annotation-xml></semantics></math> holds") == "So E=mc 2 holds"
    assert show(f"a<math display=block>{formula}<mspace/><mfrac><mn>1</mn><mn>2</mn></mfrac></math>b") == "a\nE=mc 2 1 2\nb"
    unseen = "<title>no</title><desc>no</desc><defs><text>no</text></defs><metadata>no</metadata><text display=none>no</text>"
    chart = f"<svg>{unseen}<g>no<path d='M0'/><text>Sales</text><text x=1>2024 <tspan x=0>in</tspan><tspan x=0 dy=9>EUR</tspan></text></g></svg>"
    assert show(f"<p>See {chart}here.</p>") == "See Sales 2024 in EUR here."
    assert show("<svg><defs/><text>shown</text></svg>") == "shown" and show("<svg/>x<math/>y<desc>z</desc>") == "xyz"
    assert show("<p>a<svg><foreignObject><div>b</div></foreignObject></svg>") == "a\nb"
    assert show("<svg><g><p>left open</p>after") == "left open\n\nafter"
    assert show("<pre>a<svg><text>b</text><text>c</text></svg>\nd</pre>").split() == ["a", "b", "c", "d"]


@given(st.text(alphabet="<>/ab \"'=&;!-tdrplui", max_size=120))
@settings(max_examples=200, deadline=None)
def test_layout_never_fails(page):
    html_layout.render(page)


# op6


def plain_units(text, unit):
    """(start, end, gap after), read character by character."""
    out, start, k = [], 0, 0
    while k < len(text):
        end = k
        if unit == "sentence" and text[k] in " \t" and k > 0 and text[k - 1] in ".!?":
            while end < len(text) and text[end] in " \t":
                end += 1
        elif text[k] == "\n" and unit == "paragraph":
            while (m := re.match(r"[ \t\x0b-\r]*\n", text[(end or k) + (end == k) :])) is not None:
                end = end + (end == k) + m.end()
        elif text[k] == "\n":
            end = k + 1
        if end > k:
            out.append((start, k, text[k:end]))
            start = k = end
        else:
            k += 1
    return [*out, (start, len(text), "")]


@pytest.mark.parametrize("unit", ["sentence", "line", "paragraph"])
def test_units_against_plain_version(spark, unit):
    rng = random.Random(2)
    pool = [f"line number {k} with some words." for k in range(12)] + ["short", "", "LINE  number 3 with some words.", "e.g. this! And  that?! ", "漢字だけの行", " . ", "no"]
    gaps = {"sentence": [" ", "\t ", "\n", "\n\n"], "line": ["\n"], "paragraph": ["\n", "\n \n", "\n\n\n"]}[unit]
    rows = [(k, "".join(x + rng.choice(gaps) for x in rng.choices(pool, k=rng.randint(1, 9)))) for k in range(80)]
    seen, want = set(), {}
    for k, text in rows:
        spans, kept, crossed, n, gap = [], "", False, 0, None
        for s, e, after in plain_units(text, unit):
            w = tuple(words_of(text[s:e]))
            n += bool(w)
            crossed |= "\n" in (gap or "")
            if w and w in seen:
                spans.append((s, e))
            else:
                if gap is not None:
                    first = all((a, b) in spans for a, b, _ in plain_units(text, unit) if b < s)
                    kept += "" if first else "\n" if crossed and unit == "sentence" else gap
                kept += text[s:e]
                crossed = False
            seen.add(w)
            gap = after
        words = sum(len(words_of(text[s:e])) for s, e in spans)
        want[k] = (kept, n, len(spans), words, sum(e - s for s, e in spans), ",".join(f"{s}:{e}" for s, e in spans))
    got = line_dedup.without_repeats(frame(spark, rows, "doc_id long, text string").repartition(4), unit).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want


# op7


def test_fingerprints_against_plain_version(spark):
    import hashlib

    import xxhash

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").orderBy(F.desc("doc_id")).collect()
    signed = lambda x: x - (1 << 64) if x >> 63 else x

    def sketch(text, k=128):
        w = [xxhash.xxh64(x.encode(), 42).intdigest() for x in re.split(r"[\x20\x09-\x0D]+", text.lower()) if x]

        def chain(part):
            h = 42
            for x in part:
                h = xxhash.xxh64(x.to_bytes(8, "little"), h).intdigest()
            return signed(h)

        return sorted({chain(w[i : i + 5]) for i in range(max(len(w) - 4, 1))})[:k] if w else []

    def like(a, b):
        both = sorted({*a, *b})[:128]
        return len(set(both) & set(a) & set(b)) / len(both) if both else 1.0

    want = {}
    for k, r in enumerate(rows):
        after = rows[(k + 1) % len(rows)]["text"]
        half = len(r["text"]) // 2
        edited = r["text"][: len(r["text"]) - half] + after[:half]
        s, t = sketch(r["text"]), sketch(edited)
        want[r["doc_id"]] = (len(r["text"]), hashlib.sha256(edited.encode()).hexdigest(), "".join(f"{x & (1 << 64) - 1:016x}" for x in s), like(s, t), like(s, sketch(after)))
    got = bottom_k.fingerprints(docs).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["near_edited"], r["near_next"]) for r in got} == want


def test_next_document_across_ranges_and_merging(spark):
    docs = frame(spark, [(k * 3, f"text {k} " * 5) for k in range(200)], "doc_id long, text string").repartition(3)
    for fan in (1000, 5):
        got = {r["doc_id"]: r["next_text"] for r in bottom_k.with_next(docs, range_chars=300, fan=fan).collect()}
        assert all(got[k * 3] == f"text {(k - 1) % 200} " * 5 for k in range(200))
    parts = bottom_k.with_sketch(docs.withColumn("g", F.col("doc_id") % 2), "text", "s", k=16)
    merged = {r["g"]: r["s"] for r in bottom_k.merge_groups(parts, ["g"], "s", k=16).collect()}
    every = parts.select("g", F.explode("s").alias("h")).distinct().collect()
    assert merged == {g: sorted(r["h"] for r in every if r["g"] == g)[:16] for g in (0, 1)}


# op8


def test_ids_equal_those_of_tokenizers(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    mine = packing.load_encoder()
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["", "  \n\n x\t\t", "don't I'LL we're", "a" * 5000, "é😀𝒳 " * 50, "12345678 9.0,1", "<|endoftext|>", "\x00\x07 　x y", "!" * 3000 + "?" * 10]
    assert [mine.encode_ordinary(t) for t in texts] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_ids_of_added_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y \n", "<|endoftext <|ENDOFTEXT|> |>", "a  \n <|endoftext|>  's"]
    texts += [f"a{' ' * n}<|endoftext|>{' ' * n}b" for n in (1, 2, 200_000)] + ["", "plain"]
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    encode = packing.id_maker()
    assert [encode(t) for t in texts] == want and want[0] == [64, 220, 50256, 275]
    rows = packing.token_pieces(frame(spark, list(enumerate(texts)), "doc_id long, text string")).where("doc_id = 0").collect()
    assert [(r["length"], r["ids_crc32"]) for r in rows] == [(5, zlib.crc32(np.array([64, 220, 50256, 275, 2], "<u4").tobytes()))]


def test_ids_of_long_white_space(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" " * 2_000_000, "a b" + "\t" * 1_000_000 + "c", "x" + "\n " * 600_000 + "'s y", " \n" * 600_000 + "1", "　" * 1_000_000 + "\x1c  z"]
    texts += ["\x1c" * 200_000 + " " * 200_000 + "!", ("w" + " " * 131_072 + "\n") * 3, " " * 65_536 + "\na" + " " * 70_000 + "b" + "\xa0" * 65_535]
    want = {k: whole.encode(t, add_special_tokens=False).ids for k, t in enumerate(texts)}
    encode = packing.id_maker()
    assert {k: encode(t) for k, t in enumerate(texts)} == want
    rows = packing.token_pieces(frame(spark, list(enumerate(texts)), "doc_id long, text string")).groupBy("doc_id").agg({"length": "sum"}).collect()
    assert {r[0]: r[1] - 1 for r in rows} == {k: len(v) for k, v in want.items()}


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=30))
@settings(max_examples=150, deadline=None)
@example({22: 17})
def test_plan_is_gapless_and_as_good_as_best_fit_by_document(histogram):
    bins, ranks = {}, {}
    for length, first, stop, sequence, per, offset in packing.plan_slots(histogram, 64):
        for rank in range(first, stop):
            ranks.setdefault(length, []).append(rank)
            at = rank - first
            bins.setdefault(sequence + at // per, []).append((offset + at % per * length, length))
    assert ranks == {length: list(range(n)) for length, n in histogram.items()}
    for pieces in bins.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 64
    gaps = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            best = min((g for g in gaps if g >= length), default=None)
            if best is not None:
                gaps.remove(best)
            gaps.append((64 if best is None else best) - length)
    assert len(bins) == len(gaps)


def test_pieces_and_places(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack(packing.token_pieces(docs)).collect()
    mine = packing.load_encoder()
    for r in docs.collect():
        own = sorted((x for x in rows if x["doc_id"] == r["doc_id"]), key=lambda x: x["piece"])
        n = len(mine.encode_ordinary(r["text"])) + 1
        assert sum(x["length"] for x in own) == n and [x["start"] for x in own] == [0, *(np.cumsum([x["length"] for x in own])[:-1])]
        assert all(x["length"] == 1024 for x in own[1:]) and own[0]["length"] == (n % 1024 or 1024)
    bins = {}
    for x in rows:
        bins.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    assert all([o for o, _ in sorted(b)] == [0, *np.cumsum([n for _, n in sorted(b)])[:-1]] and sum(n for _, n in b) <= 1024 for b in bins.values())


# op9

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(digits))) % 10 == 0
            if kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split(".")) or kind == 2 and 13 <= len(digits) <= 19 and luhn or kind == 3 and 9 <= len(digits) <= 15:
                out.append((kind, m.start(), m.end()))
    return out


@given(st.text(alphabet="a1.@-+ 025()%_9\n٣é", max_size=60))
@settings(max_examples=600, deadline=None)
def test_base_spans_match_the_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_base_spans_of_documents_and_hard_texts(spark):
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        assert pii.base_spans(r["text"]) == plain_spans(r["text"])
    for text in ("1" * 100_000, "a" * 100_000 + "@", "@" * 20_000, "1." * 50_000, "+1" * 40_000):
        pii.mentions(text, pii.base_spans(text))


def test_repeated_mention_takes_the_label(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    model = pii.fit(docs)
    text = "pay 4111 1111 1111 1111 now " + "word " * 300 + "again 4111.1111.1111.1111 and 7231.1111.2222.9999 end"
    base = pii.base_spans(text)
    assert [(k, text[s:e]) for k, s, e in base if k == 2] == [(2, "4111 1111 1111 1111")]
    added = pii.added_spans(text, base, model)
    assert [(k, text[s:e]) for k, s, e in added] == [(2, "4111.1111.1111.1111")]
    assert pii.redacted("a b@c.de x", pii.base_spans("a b@c.de x")) == "a [EMAIL] x"
    got = pii.find(docs, model)
    clean = got.where("base_sha256 = sha2('', 256) and spans != ''").count()
    assert clean == 0 and got.where("n_added > 0 and n_email + n_ip + n_card + n_phone = 0").count() == 0


def test_loopy_beliefs_equal_exact_marginals_on_a_tree():
    rng = np.random.default_rng(4)
    node, tables = rng.standard_normal((4, 3)), rng.standard_normal((3, 3, 3))
    edges = [(0, 1, tables[0]), (1, 2, tables[1]), (1, 3, tables[2])]
    joint = np.exp(sum(node[k].reshape([3 if j == k else 1 for j in range(4)]) for k in range(4))
                   + tables[0][:, :, None, None] + tables[1][None, :, :, None] + tables[2][None, :, None, :])
    joint /= joint.sum()
    want = np.array([joint.sum(tuple(j for j in range(4) if j != k)) for k in range(4)])
    assert np.allclose(pii.believe(node, edges, rounds=60), want, atol=1e-6)


# op10


def test_mix_against_plain_version(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "b", "é", None, "z"])) for k in range(400)]
    got = mixing.mix(frame(spark, rows, "doc_id long, text string, source string").repartition(4), key_buckets=16).collect()
    size = {}
    for _, text, source in rows:
        size[source] = size.get(source, 0) + len(text.split())
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, target, open_ = 1.5 * sum(size.values()), {}, set(order)
    while True:
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * size[s]]
        if not over:
            break
        target |= {s: 2.0 * size[s] for s in over}
        open_ -= set(over)
    target |= share
    source = {k: s for k, _, s in rows}
    taken = {}
    for r in got:
        assert r["target"] == pytest.approx(target[source[r["doc_id"]]]) and 0 <= r["extra"] <= r["size"]
        taken[source[r["doc_id"]]] = taken.get(source[r["doc_id"]], 0) + r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in order)
    docs = frame(spark, rows, "doc_id long, text string, source string")
    copies = mixing.mixed_documents(docs, small_sources=0).groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()
    assert all(abs(r["n"] - target[r["source"]]) <= 20.5 for r in copies)  # half of the longest document
    texts = {k: t for k, t, _ in rows}
    assert all(texts[r["doc_id"]] == r["text"] for r in mixing.mixed_documents(docs).collect())
    named = docs.select("*", *[F.lit(1).alias(c) for c in ("s", "Target", "epochs", "cut_key", "SIZE", "taken", "extra", "r", "n", "base", "budget")])
    assert mixing.mixed_documents(named).columns == named.columns and mixing.mix(named, keep_text=True).columns[:4] == ["doc_id", "text", "source", "s"]
    heavy = mixing.mix(docs, quality=F.when(F.col("doc_id") < 200, 8.0).otherwise(1.0)).withColumn("low", F.col("doc_id") < 200)
    share = {r["low"]: r["s"] for r in heavy.where("epochs < 2").groupBy("low").agg(F.avg(F.col("extra") / F.greatest("size", F.lit(1))).alias("s")).collect()}
    assert share[True] > share[False]
