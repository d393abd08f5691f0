"""A training corpus from ``documents``: toxic documents out, exact and near
copies out, sources mixed to target weights, the rest packed into sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; its result is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from newsloom.llm import bloom_dedup, minmax_dedup, mixing, packing, toxicity
from newsloom.llm.common import shared_table, table


def toxicity_filter(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model calls toxic go."""
    return toxicity.reject_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space the longest stays."""
    return bloom_dedup.deduplicate(docs)


def near_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minmax_dedup.keep_one(docs)


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 times)."""
    return mixing.mix(docs)


def pack_sequences(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 ids."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The tokenizer and the trained model can't be expressed in SQL; the tests
#: hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
