"""Corpus pipeline: reject toxic documents, keep one of each near-duplicate group, redact personal data,
mix sources, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last return the
columns of documents. Empty input gives empty output; null texts pass through every filter.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geogrid.llm import bpe, mixing, ngram_join, pii, quality_fm, toxicity
from geogrid.llm.session import remove, shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 1/2; the model learns from this input's labelled rows."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.toxicity_model(docs, quality_fm.training_rows(labels, 5, 0))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group linked by shingle Jaccard similarity of 0.75 or more."""
    return ngram_join.one_of_each(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with each found span replaced by its kind; ``n_chars``, where there is one, counts the new text."""
    clean = pii.redact(docs, pii.train(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the golden-ratio schedule takes them (not at all, once or twice)."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and what they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_decode(docs, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("personal data", redact_personal_data),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: Models and tokens are beyond SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder as Parquet and read again; what a stage has read is
    deleted once its own rows are written (the last one's input stays, as its rows are made on demand)."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k:
                remove(spark, f"{folder}/{k - 1}")
    return docs
