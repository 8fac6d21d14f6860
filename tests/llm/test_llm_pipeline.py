"""The pipeline's stages, one after the other, against plain versions on the smallest table."""

import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from rankfold.llm import language, packing, pii
from rankfold.llm.common import checkpoint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(checkpoint(stage(spark, docs[-1], SF)))
    return docs


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_language_keeps_clean_documents(stages):
    before, after = rows(stages[0]), rows(stages[1])
    found = {r["doc_id"]: r for r in language.identify(stages[0]).collect()}
    assert set(after) == {k for k, r in found.items() if r["lang_pred"] != "und" and r["score"] >= 0.5}
    assert all(after[k]["lang"] == found[k]["lang_pred"] and after[k]["text"] == before[k]["text"] for k in after)


def test_one_document_of_each_group_stays(stages):
    def shingles(text):
        w = [x.lower() if x.isascii() else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in re.findall(r"[^\x20\x09-\x0D]+", text)]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    before, after = rows(stages[1]), rows(stages[2])
    sets = {k: shingles(r["text"]) for k, r in before.items()}
    parent = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(parent[a], parent[b]), min(parent[a], parent[b])
                parent = {k: new if v == old else v for k, v in parent.items()}
    assert set(after) == {k for k, v in parent.items() if v == k} and len(after) < len(before)


def test_personal_data_is_gone_and_the_rest_stays(stages):
    before, after = rows(stages[2]), rows(stages[3])
    assert set(before) == set(after)
    touched = 0
    for k, r in before.items():
        base = pii.base_spans(r["text"])
        touched += bool(base)
        assert (after[k]["text"] == r["text"]) == (not base) and after[k]["n_chars"] == len(after[k]["text"])
        assert not pii.base_spans(after[k]["text"])
    assert touched


def test_mix_meets_its_budget_and_pieces_hold_every_token(stages):
    words = lambda df: df.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).first()["n"]
    # whole documents only: each source ends within half a document of its target
    longest = stages[3].groupBy("source").agg(F.max(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).agg(F.sum("n")).first()[0]
    assert abs(words(stages[4]) - 1.5 * words(stages[3])) <= longest / 2
    before = {(r["doc_id"], r["text"]) for r in stages[3].collect()}
    assert all((r["doc_id"], r["text"]) in before for r in stages[4].collect())
    assert stages[4].groupBy("doc_id").count().agg(F.max("count").alias("c")).first()["c"] <= 2
    mine = packing.load_encoder()
    tokens = sum(len(mine.encode_ordinary(r["text"])) + 1 for r in stages[4].collect())
    placed = stages[5].agg(F.sum("length").alias("n"), F.countDistinct("sequence_id").alias("s")).first()
    assert placed["n"] == tokens and placed["s"] <= tokens / 1024 * 1.05 + 2


def test_run_gives_the_last_stage(spark, stages):
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, run.drop("sequence_id", "offset").collect()), key=str) == sorted(map(tuple, stages[5].drop("sequence_id", "offset").collect()), key=str)
