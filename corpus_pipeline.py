"""From raw documents to packed training sequences in five stages.

Each stage works on all rows that the one before kept.  All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annomill.llm import decontamination, lines, neighbours, packing, toxicity
from annomill.llm.queries import CATEGORIES, SEQUENCE_TOKENS, TOXIC_FROM, byte_vocabulary, piece_columns, table
from annomill.session import stored


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic stays below the limit."""
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), CATEGORIES)
    return toxicity.judge(docs, chain).where(F.col("p_toxic") < TOXIC_FROM).select(docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that repeat an earlier one up to one edit."""
    return lines.drop_repeats(docs).select(docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return neighbours.keep_one(docs).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    found = decontamination.find(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of one length."""
    return packing.pack(docs, *byte_vocabulary(), SEQUENCE_TOKENS).select(*piece_columns())


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Models and tokenizers cannot be written in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
