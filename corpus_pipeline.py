"""Corpus pipeline: language, near duplicates, personal data, mixing, packing.

``STAGES`` are applied in turn to ``documents``; each result is written as Parquet and read again as the
next stage's input.  All but the last return the columns of ``documents``.  No stage is expressible
in SQL as a whole (models, a tokenizer), so ``ORACLE_SQL`` is None and tests hold each stage against a
plain version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.llm import fast_sketch, language, mixing, packing, pii
from rankfold.llm.common import shared_folder

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in no known language and those whose main language has less than half; ``lang`` becomes the prediction."""
    known = language.identify(docs).where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= 0.5))
    return known.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group that shares 0.8 of its five-word shingles."""
    return fast_sketch.without_near_duplicates(docs, width=5, percent=80)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; ``n_chars`` follows the text."""
    found = pii.find(docs, pii.fit(docs), redact=True)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in weights 3, 1, 2, repeating, to 150% of the words; a document taken twice is two rows, and each is whole."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their place in a sequence."""
    return packing.pack(packing.token_pieces(docs))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("redact_pii", redact_pii),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; intermediate documents are Parquet tables in the shared checkpoint folder."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
