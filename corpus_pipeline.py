"""From raw documents to packed sequences: the stages of a training-data pipeline in their order.

Every stage takes documents with any further columns, whatever their names, and all but the last return the same
columns. A null text is an empty one to every decision and stays null. Documents without an id are judged like others;
of copies one with an id is kept before one without. Rows that repeat an id are documents of their own. Without any
documents the stages, and without usable labels the first, pass on what there is.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cityflow.llm.common import stored, table
from cityflow.llm.exact import drop_copies
from cityflow.llm.near import drop_similar
from cityflow.llm.packing import pack_documents
from cityflow.llm.pii import mask_pii
from cityflow.llm.toxicity import drop_toxic, learned

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    return drop_toxic(docs, learned(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the smallest id."""
    return drop_copies(docs, keep="smallest")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: pairs of similarity 0.8 or more by shingles of five words."""
    return drop_similar(docs, words=5)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return mask_pii(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequence each piece of the documents goes to."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("packing", packing),
]

#: A trained network, sampled splitters and a linear program are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet in the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
