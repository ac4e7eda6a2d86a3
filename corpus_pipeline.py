"""From documents to packed training sequences, in five stages.

Each stage takes `(spark, docs, sf_dir)`; its result is written as Parquet and read again as the
next stage's `docs`. All but the last return the columns of `documents`.
"""

from pyspark.sql import DataFrame, SparkSession

from repotrends.llm import mixing, packing, quality, simhash, substrings
from repotrends.llm.common import stored, table
from repotrends.llm.queries import TOKENIZER


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), quality.rating(), grades=3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.drop_near_duplicates(docs, size=3, distance=2)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that repeat an earlier document's."""
    return substrings.cut_repeats(docs, window=13)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take_mix(docs, weights=(5, 2, 1), most=3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens."""
    return packing.pack(docs, TOKENIZER, capacity=2048)


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]

#: SQL has no counterpart of the trained and hashed stages; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table `documents`."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
