"""From raw documents to a training mix: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import decontaminate, jaccard, line_dedup, mixing, toxicity
from tallyhouse.llm.common import library_for_workers, read, release, stored


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. The lexicon is learned from the labels of these documents."""
    library_for_workers(spark)
    return toxicity.not_toxic(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of three lines stay once in the corpus."""
    library_for_workers(spark)
    return line_dedup.without_repeated_lines(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 0.8 of their five-word shingles, directly or by others, one stays."""
    library_for_workers(spark)
    return jaccard.one_of_each(docs, k=5, percent=80)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten words in a row with a benchmark item go."""
    library_for_workers(spark)
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    library_for_workers(spark)
    return mixing.mix(docs)


STAGES = [
    ("toxicity", not_toxic),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", benchmark_free),
    ("mixing sources to target weights", mixed),
]

# Learned scores and a seeded selection are outside SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what a stage has read is removed once its rows are written.

    Null and empty texts are copies of nothing, hold no benchmark window and are taken 0
    times by the mix. Other cases are as each stage's operator states them.
    """
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
            if k:
                release(before)
    return docs
