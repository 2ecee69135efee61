"""Documents to packed training sequences: five stages, each over all rows the one before kept.

A row without doc_id names no document: the first stage leaves it out. Null and empty
texts stay and pack as their end id alone; repeated rows are documents of one group, of
which near_copies keeps every row of the smallest doc_id. Empty tables give empty
results, and other columns of the documents come through unread up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsleuth.llm import contamination, ngram_jaccard, packing, substring_dedup, toxicity
from netsleuth.llm.shared import written
from netsleuth.sources.tables import table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a doc_id whose toxicity score is below 0.5."""
    return toxicity.drop_toxic(docs.filter(F.col("doc_id").isNotNull()), table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group linked by five-word shingles at 0.8 or more."""
    return ngram_jaccard.keep_one(docs, width=5, num=8, den=10)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 50-word windows that a smaller doc_id also holds."""
    return substring_dedup.remove_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item occurs; an item of fewer words is one window."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents with their ids, placed in sequences of 4096 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_copies", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: The first and last stages are a trained model and a tokenizer, so tests take the place of SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is a written table that the next stage reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
