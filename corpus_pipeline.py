"""A training corpus from raw documents, stage by stage.

Every stage works on all that the one before has kept and stored. The first four return the columns of the documents,
the last one the pieces of the packed documents. Stages pass other columns of the documents on untouched; what nulls,
empty texts, repeated rows and empty tables give is said with each operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import line_dedup, mixing, packing, quality, simhash
from tripweave.llm.common import drop_staged, table
from tripweave.llm.queries import (
    FLATTEN,
    KEEP,
    LANGUAGES,
    SEQUENCE_TOKENS,
    TOPICS,
    topic_of,
    vocabulary_path,
)
from tripweave.session import stage


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules and the isolation forest accept."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least ten of them share."""
    return line_dedup.dedup_lines(docs, min_docs=10, min_chars=1)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of three words, at most three differing bits."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of documents whose tokens meet the targets of sources, languages and topics."""
    return mixing.sample(docs, LANGUAGES, TOPICS, topic_of(F.col("text")), KEEP, FLATTEN)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in a sequence."""
    return packing.pack_documents(docs, vocabulary_path(), SEQUENCE_TOKENS)


STAGES = [
    ("quality rules", good),
    ("line dedup", without_shared_lines),
    ("SimHash near-dedup", one_of_each),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed),
]

# The forest, the fingerprints, the token ids and the packing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each works on the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            drop_staged(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
