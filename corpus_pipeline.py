"""From raw documents to a packed training corpus, in stages of corpus operators.

Every stage works on all rows its predecessor kept and hands on the columns of ``documents``; the last one
returns the packed rows.  Rows, texts and nulls are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import decontam, mixing, quality, simhash, tokenfile
from tidewell.llm.common import read
from tidewell.llm.queries import tokenizer_path
from tidewell.session import settle


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.without_contained(docs, read(spark, sf_dir, "benchmark"))


def to_target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target shares of source, language and topic."""
    return mixing.sample_mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents in id files, and what reading these files gives for each document."""
    return tokenfile.round_trip(docs, tokenizer_path())


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", decontaminated),
    ("mixing", to_target_mix),
    ("token_ids", packed),
]

#: SQL can express neither the classifier's fit nor XXH64; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = settle(docs)
    return docs
