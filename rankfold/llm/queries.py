"""The registered query of every operator of this package: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.llm import bottom_k, collocations, fast_sketch, html_layout, language, line_dedup, mixing, packing, periodic_runs, pii, pivot_index, toxicity, url_filter
from rankfold.llm.common import WORD


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Host, path and action of the rules of the URL query.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def redirect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, action string")
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules).drop("component")


def pivot_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(_documents(spark, sf_dir).select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "mixture")


def fast_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fast_sketch.near_duplicates(_documents(spark, sf_dir), width=2, percent=80)


def layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(_documents(spark, sf_dir).select("doc_id", "text"))


def bottom_k_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom_k.fingerprints(_documents(spark, sf_dir))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(_documents(spark, sf_dir)))


def skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return pii.find(docs, pii.fit(docs)).drop("text")


def weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "epochs", "taken")


def _with_planted_period(docs: DataFrame) -> DataFrame:
    """The words of a tenth of the documents, chosen by a checksum of ``doc_id``, repeat with a period from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")

    def planted(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        word = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(word, " ")).otherwise(F.lit(""))

    # the words are bound once, as the variable of a lambda
    text = F.get(F.transform(F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))), planted), F.lit(0))
    return docs.withColumn("text", F.when(F.col("text").isNotNull() & (h % 10 == 0), text).otherwise(F.col("text")))


def periodic_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse_runs(_with_planted_period(_documents(spark, sf_dir).select("doc_id", "text")))
    top = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("p"))))
    listed = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    found = found.withColumn("_top", top)
    return found.select(
        "doc_id",
        "n_runs",
        (-F.col("_top.s")).alias("start"),
        F.col("_top.length").alias("length"),
        (-F.col("_top.p")).alias("period"),
        F.expr("1000 * _top.length div -_top.p").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("collapsed_sha256"),
    )


def lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    found = toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return found.withColumn("held_out", toxicity.held_out(5)).select("doc_id", "held_out", "score", "predicted", "n_hits", "n_quoted", "hits")


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir).select("lang", "text"))


QUERIES = {
    "op1_redirect_filter": redirect_filter,
    "op2_pivot_neighbours": pivot_neighbours,
    "op3_language_mixture": language_mixture,
    "op4_fast_similarity": fast_similarity,
    "op5_layout_text": layout_text,
    "op6_repeated_lines": repeated_lines,
    "op7_bottom_k_fingerprints": bottom_k_fingerprints,
    "op8_best_fit_packing": best_fit_packing,
    "op9_skip_chain_pii": skip_chain_pii,
    "op10_weighted_mix": weighted_mix,
    "op11_periodic_runs": periodic_word_runs,
    "op12_lexicon_toxicity": lexicon_toxicity,
    "op13_phrase_collocations": phrase_collocations,
}
