"""A training corpus from raw documents in five stages, each written as Parquet and read again by the next.

toxicity (documents that it rejects go), language (und and rejected guesses go), near duplicates (one document of each class stays),
mix (each document as often as the target weights take it), tokens (ids of every text).

Defined results: null and empty texts are clean, but have no language and go in the second stage; rows that repeat are
documents of their own until near duplicates leave one of them; ties are settled by doc_id and text. Columns besides those
of documents stay, whatever their names, until the last stage, which returns its own columns alone. Empty tables give
empty tables. Texts of any length pass whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import bpe, langid, mixing, neardup, toxicity
from tidemill.llm.common import scratch, table, unused
from tidemill.llm.queries import vocabulary_path


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the toxicity model predicts to be toxic."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    names = unused(docs.columns, "score"), unused(docs.columns, "predicted")
    return toxicity.score(docs, model, names=names).filter(F.col(names[1]) == 0).drop(*names)


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose language is undetermined or too uncertain."""
    names = tuple(unused(docs.columns, n) for n in ("lang_pred", "score", "accepted"))
    return langid.identify(docs, langid.learn(docs), names).filter(F.col(names[2])).drop(*names)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the smallest doc_id."""
    return neardup.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeated(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids of each document."""
    return bpe.encode(docs, vocabulary_path())


STAGES = [("toxicity", clean), ("language", in_a_language), ("near_duplicates", distinct), ("mix", mixed), ("tokens", encoded)]

# The first stage is a fitted model, which SQL can't express; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
