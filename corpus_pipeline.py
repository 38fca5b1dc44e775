"""From raw documents to packed training sequences, in stages that each store their result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from narrowlake.llm import mixing, packing, secrets, shingle_join, toxicity
from narrowlake.llm.common import drop, stage, stored, table
from narrowlake.llm.tokens import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


@stage
def reject_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled ones, does not reject."""
    return toxicity.clean(docs, table(spark, folder, "labels"))


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return shingle_join.one_of_each(docs, shingle_join.Rule(words=5, lower=8, upper=10))


@stage
def redact_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; the models are trained on these documents."""
    return secrets.clean(docs, secrets.train(docs))


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in the shares of the mix; a document that it takes twice stands there twice."""
    return mixing.mix(docs)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of the documents with their ids, and their places in training sequences."""
    return packing.pack(packing.pieces(docs, vocabulary("word_bpe_49k.json"), ids=True))


STAGES: list[tuple[str, Stage]] = [
    ("reject_toxic", reject_toxic),
    ("drop_near_copies", drop_near_copies),
    ("redact_secrets", redact_secrets),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Fitting a model, hashed ranks and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents table; each reads what the one before stored.

    Documents with null, empty, blank or very long texts, repeated rows and rows without an
    id pass through as each operator's docstring says: none is lost but toxic documents,
    copies, and what the mix leaves out; repeated rows are copies.  Tables that a stage
    made for itself are deleted when the next one starts.  An empty table gives no rows.
    """
    docs = table(spark, folder, "documents")
    for name, work in STAGES[:-1]:
        before, docs = docs, stored(work(spark, docs, folder), name)
        if hasattr(before, "stored_at"):
            drop(before)
    return STAGES[-1][1](spark, docs, folder)
