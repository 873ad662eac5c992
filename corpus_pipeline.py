"""Cleaning a corpus: the stages, each of them one operator, and their run."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tallybook.llm import decision_list, sampling, simhash, toxicity, winnowing
from tallybook.llm.common import table
from tallybook.session import ensure_checkpoint_dir, remove_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules or the learned list reject go."""
    return decision_list.kept_documents(docs, decision_list.learn(docs, table(spark, sf_dir, "labels")))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.clean_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go; a shared word or two is no passage."""
    return winnowing.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as the ids of a sampled segmentation."""
    return sampling.encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("toxicity", not_toxic),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("sentencepiece_sampling", encoding),
]

ORACLE_SQL = None  # the stages learn, hash and sample in ways SQL does not have


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages over ``documents``; each is written and read again.

    In a ``folder`` the caller names all stages' outputs stay; else they go to
    the shared folder, and each but the last is removed once the next is written.
    """
    docs = table(spark, sf_dir, "documents")
    own = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid4().hex}"
    before = None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder or own}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before and not folder:
            remove_folder(spark, before)
        before = path
    return docs
