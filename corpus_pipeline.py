"""Corpus preparation in stages; each stage is written as Parquet and read by the next.

STAGES lists (name, function); a function takes (spark, docs, folder) and
returns a DataFrame. ORACLE_SQL is None, as SQL cannot express the stages. An empty
table passes through all stages; extra columns come through all but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortry.llm.common import table
from cohortry.llm.decontamination import without_leaks
from cohortry.llm.mixing import mix, repeated
from cohortry.llm.near_dedup import one_of_each
from cohortry.llm.sharding import shard_documents
from cohortry.llm.toxicity import model_for, without_toxic
from cohortry.session import checkpointed

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the toxicity model rejects go.

    NULL and empty texts are scored like any other; repeated rows go or stay together.
    """
    return without_toxic(docs, model_for(spark, docs, folder))


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id.

    Rows that repeat an id and its text stay once; texts without words are near
    nothing and stay; a group without any id keeps its rows.
    """
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold an item of the benchmark go.

    NULL and empty texts hold none; without items all stay.
    """
    return without_leaks(docs, table(spark, folder, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents drawn, and repeated where rare, so that sources, languages and topics meet their target weights.

    So a row may come out several times, 16 at most. NULL classes are one more class;
    NULL and empty texts share the fate of their cell; repeated rows share theirs.
    """
    return repeated(mix(docs)).select("row.*")


def sharding(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """What is left, in shards of near equal bytes: one place for each row.

    Equal texts, so also repeated rows, share a shard; NULL texts count one byte.
    """
    return shard_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written once and read back."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
