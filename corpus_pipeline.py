"""The corpus pipeline: documents in, packed training sequences out.

Quality rules drop documents, the Jaccard join keeps one document of each group, substring dedup takes out passages that stand in an
earlier document, decontamination takes out benchmark passages, and packing cuts what is left into windows.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import decontaminate, jaccard, packing, quality, substring
from gleaner.llm.common import read, remove, scratch
from gleaner.session import ship_package, stage_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def scoped(step):
    """A stage whose own files go when the next stage begins; by then its result has been written."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with scratch(spark):
            return step(spark, docs, sf_dir)

    return run_step


@scoped
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, unchanged. Rows with one id are judged one by one; a null text never stays."""
    return quality.kept_rows(docs, read(spark, sf_dir, "labels")).select(*COLUMNS)


@scoped
def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, unchanged."""
    ship_package(spark)
    return jaccard.one_of_each(docs).select(*COLUMNS)


@scoped
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that also stand in a smaller one."""
    ship_package(spark)
    return _documents(substring.remove_repeats(docs)[0])


@scoped
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those that are mostly benchmark go as a whole."""
    ship_package(spark)
    return _documents(decontaminate.remove_spans(docs, read(spark, sf_dir, "benchmark")))


@scoped
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their ids."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: Tokenisation and BM25 packing have no SQL form; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. The result of a stage goes, too, once that of the next is written."""
    docs, before = read(spark, sf_dir, "documents"), []
    for number, (_, step) in enumerate(STAGES):
        path = stage_path(spark, f"pipeline-{number}")
        made = step(spark, docs, sf_dir)
        made.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        remove(spark, before)
        before = [path]
    return docs
