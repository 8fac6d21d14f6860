"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rankfold.llm.common import checkpoint
from rankfold.llm import bottom_k, fast_sketch, html_layout, language, line_dedup, mixing, packing, pii, pivot_index, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, label string, cid int, spans string"
LONG = " ".join(f"w{i}" for i in range(30_000))


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", 1, "x") for r in rows], SCHEMA)


ROWS = [
    (1, "the cat sat on the mat and ate the rat today", "en", "a", 1),
    (1, "the cat sat on the mat and ate the rat today", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \n\t ", "fr", None, 3),
    (5, LONG, "en", "b", len(LONG)),
    (6, "12345 !!", "en", "b", 8),
    (None, "le chat est assis sur le tapis rouge de la maison", "fr", "c", 1),
    (7, "le chat est assis sur le tapis rouge de la maison", "fr", "c", 1),
    (8, "𝒳 émoji 😀 text with astral 😀😀 letters here", "fr", "a", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, ROWS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, ROWS).limit(0)


def by_id(df, *columns):
    return sorted(((r["doc_id"], *(r[c] for c in columns)) for r in df.collect()), key=str)


def test_language(docs, none):
    found = {(r["doc_id"], r["lang_pred"]) for r in language.identify(docs).collect()}
    assert {(2, "und"), (3, "und"), (4, "und"), (6, "und")} <= found and len(language.identify(docs).columns) == len(docs.columns) + 3
    assert language.identify(docs).where("score < 0 or score > 1 or score is null").count() == 0
    assert language.identify(none).count() == 0


def test_near_duplicates(docs, none):
    found = by_id(fast_sketch.near_duplicates(docs, width=2), "n_shingles", "component_id", "kept")
    assert len(found) == len(ROWS)
    assert (2, 0, 2, True) in found and (3, 0, 3, True) in found and (4, 0, 4, True) in found
    assert found.count((1, 10, 1, True)) == 2 and (5, 29_999, 5, True) in found
    assert (None, 10, 7, False) in found and (7, 10, 7, True) in found
    assert fast_sketch.near_duplicates(none).count() == 0


def test_pii(docs, none):
    model = pii.fit(docs)
    found = pii.find(docs, model)
    assert found.count() == len(ROWS) and found.where("spans != ''").count() == 0
    assert pii.find(none, pii.fit(none)).count() == 0


def test_mixing(docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert {r["doc_id"]: r["size"] for r in rows}[2] == 0
    assert sum({(r["source_size"], r["target"]) : r["target"] for r in rows}.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).columns == none.columns


def test_packing(docs, none):
    rows = packing.pack(packing.token_pieces(docs)).collect()
    assert len([r for r in rows if r["doc_id"] == 1]) == 2 and {r["length"] for r in rows if r["doc_id"] in (2, 3)} == {1}
    assert packing.pack(packing.token_pieces(none)).count() == 0


def test_lines(docs, none):
    rows = line_dedup.without_repeats(docs)
    assert rows.count() == len(ROWS) and rows.where("doc_id = 2 and text is null and n_units = 0").count() == 1
    assert rows.where("doc_id = 3 and text = '' and n_units = 0").count() == 1
    assert rows.where("doc_id is null and n_removed = 1 and removed_words = 11 and removed_chars = 49").count() == 1 and rows.where("doc_id = 7 and n_removed = 0").count() == 1
    assert line_dedup.without_repeats(none).count() == 0


def test_fingerprints(docs, none):
    rows = bottom_k.fingerprints(docs).collect()
    assert len(rows) == len(ROWS)
    assert len({r["fingerprint"] for r in rows if r["doc_id"] == 1}) == 1 and {r["fingerprint"] for r in rows if r["doc_id"] in (2, 3, 4)} == {""}
    assert bottom_k.fingerprints(none).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []),
            (9, [1.0, 0.0, 0.0]), (10, [-0.0, 1.0]), (11, [0.0, 1.0]), (None, [0.0, 3.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, n string")
    found = sorted([tuple(r) for r in pivot_index.near_vectors(df).collect()], key=str)
    assert found.count((1, 2, 1, True)) == 2 and (2, 2, 1, False) in found
    for k in (3, 4, 5, 6, 7, 8, 9):
        assert (k, 0, k, True) in found
    assert (10, 2, 10, True) in found and (11, 2, 10, False) in found and (None, 2, 10, False) in found
    assert pivot_index.near_vectors(df.limit(0)).count() == 0


def test_urls_and_pages(spark):
    rules = spark.createDataFrame([("net", "/", "block")], "rule_host string, rule_path string, action string")
    rows = [(1, None, None), (2, "nonsense", ""), (3, "http://a.NET", "<p>x"), (3, "http://a.NET/", "<p>x"), (4, "http:///x", None), (None, "https://b.net/q?x#y", "text")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, component string")
    found = sorted([tuple(r) for r in url_filter.judge(df, rules).drop("component").collect()], key=str)
    assert (1, "", "", None, "allow") in found and (2, "", "", None, "allow") in found and (4, "", "/x", None, "allow") in found
    assert (3, "a.net", "", None, "allow") in found and (3, "a.net", "/", "net/", "block") in found and (None, "b.net", "/q", "net/", "block") in found
    assert url_filter.judge(df.limit(0), rules).count() == 0
    text = {tuple(r) for r in html_layout.extract(df).collect()}
    assert (1, None, 0) in text and (2, "", 0) in text and (None, "text", 1) in text and html_layout.extract(df.limit(0)).count() == 0


def test_pipeline_stages(spark, docs, none):
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    for rows in (docs.select(*plain), none.select(*plain)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, rows, "")
            rows = checkpoint(out)
            if k < 4:
                assert rows.columns == plain
            if k == 1:
                assert rows.where(F.col("doc_id") == 1).count() <= 1
