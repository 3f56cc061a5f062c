"""From raw documents to a sharded training set.

Each stage takes what the one before it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.decontamination import find_leaks
from strandline.llm.mixing import mix, repeated
from strandline.llm.near_dedup import Rule, one_of_each
from strandline.llm.shared import keep_rows, read_documents, settle
from strandline.llm.sharding import shard
from strandline.llm.toxicity import REJECTED, score_toxicity

MOST_REPETITIONS = 2.0
# The stages are fitted models, a search and permutations; SQL can't say what they do.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    scored = score_toxicity(docs, read_documents(spark, sf_dir, "labels"))
    return scored.filter(F.col("__toxicity.score") < REJECTED).drop("__toxicity")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose shingles of five words are alike to 0.8 or more."""
    return one_of_each(docs, Rule(5, 80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    leaks = settle(find_leaks(docs, read_documents(spark, sf_dir, "benchmark")), "leaks")
    return keep_rows(docs, leaks, drop=True)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, and those of small sources up to twice, as their weights say."""
    return repeated(mix(docs, repetition=MOST_REPETITIONS), docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return shard(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
