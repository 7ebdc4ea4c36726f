"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read back as the next one's ``docs``; all but the last return the columns of ``documents``.
Each works on all that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stationlake.llm import mixing, packing, simhash_dedup, suffix_dedup, toxicity
from stationlake.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at its threshold or above go."""
    return toxicity.reject(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component stays."""
    return simhash_dedup.keep_first(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also stand in a document with a smaller id are cut from the texts."""
    return suffix_dedup.strip(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, taken in part or left out to meet their source's target."""
    return mixing.apply(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the tokenised documents with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_passages),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: The classifier, the suffix arrays and the tokenizer have no SQL; tests/llm holds brute force against run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
