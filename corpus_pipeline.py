"""A corpus made ready for training: toxic documents, repeated lines and near duplicates go, the rest is packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import linededup, packing, simhash, toxicity
from tillroll.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from the labels among them, scores below 0.5."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"), threshold=0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match an earlier line; one that loses all its words that way goes."""
    done = linededup.deduplicate(docs, percent=80)
    left = F.expr("size(removed_lines) = 0 OR trim(BOTH ' \\t\\r\\n\\f\\u000B' FROM text) <> ''")
    return done.where(left).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints hang together at two bits or fewer, the first."""
    return simhash.keep_one(docs, words=3, max_bits=2)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_duplicates),
    ("packing", pack),
]
#: A trained model and a tokenizer have no SQL; the tests hold the pipeline against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
