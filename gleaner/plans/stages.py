"""Shared stages: the prepared chunk table, the embedder fitted on it, and the question sets."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.text import chunk_key, core_text
from gleaner.operators import chunk, embed, rerank, search
from gleaner.session import read_source, staged

_prepared: dict[tuple[str, str], tuple[DataFrame, PipelineModel]] = {}
_frequencies: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_source(spark, f"{sf_dir}/{name}.parquet")


def chunk_table(documents: DataFrame) -> DataFrame:
    """Documents to chunk rows: key, doc_id, chunk_no, source, lang, content."""
    cleaned = documents.withColumn("text", core_text(F.col("text")))
    return chunk.chunk_rows(chunk.window_chunks(cleaned, "text"), "doc_id", ["source", "lang"])


def counted_chunks(documents: DataFrame) -> DataFrame:
    """Chunk rows with their term counts ``tf`` and number of terms ``n_terms``."""
    return embed.term_counts(chunk_table(documents), "content", size="n_terms")


def prepare(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, PipelineModel]:
    """The chunk table and its embedder, written once per application and then read from files."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _prepared:
        chunks = staged(counted_chunks(table(spark, sf_dir, "documents")), "chunks", compression="zstd")
        _prepared[key] = (chunks, embed.embedder(embed.fit_weights(chunks)))
    return _prepared[key]


def prepared_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term frequencies of the prepared chunks, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _frequencies:
        chunks, _ = prepare(spark, sf_dir)
        _frequencies[key] = staged(rerank.term_frequencies(chunks, "content"), "terms")
    return _frequencies[key]


def benchmark_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, question): each benchmark text is a question."""
    rows = table(spark, sf_dir, "benchmark")
    return rows.select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


def user_questions(turns: DataFrame) -> DataFrame:
    """(query_id, question): every user turn, with or without a reply."""
    asked = turns.where(F.col("role") == "user")
    return asked.select(chunk_key(F.col("conv_id"), F.col("turn")).alias("query_id"), F.col("text").alias("question"))


def chat_questions(turns: DataFrame) -> DataFrame:
    """Evaluation set from conversations: each user turn that got a reply, and the reply as the truth.

    (query_id, question, ground_truth, evolution_type, episode_done). The turns are looked up
    by their unique key (conv_id, turn), so a long conversation does not gather in one task.
    """
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    reply = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("ground_truth")
    )
    later = turns.select("conv_id", (F.col("turn") - 2).alias("turn"), F.lit(True).alias("_more"))
    pairs = asked.join(reply, ["conv_id", "turn"]).join(later, ["conv_id", "turn"], "left")
    return pairs.select(
        chunk_key(F.col("conv_id"), F.col("turn")).alias("query_id"),
        "question",
        "ground_truth",
        F.when(F.col("turn") <= 1, "first").otherwise("follow_up").alias("evolution_type"),
        F.col("_more").isNull().alias("episode_done"),
    )


def retrieve(
    chunks: DataFrame, model: PipelineModel, questions: DataFrame, k: int, columns: list[str] | None = None
) -> DataFrame:
    """Nearest chunks for question texts: (query_id, rank, score, key, columns)."""
    asked = embed.embed_text(questions.select("query_id", "question"), "question", model)
    corpus = embed.embed_counts(chunks.select("key", "tf"), model)
    found = search.nearest(corpus, asked, k, len(embed.weights_of(model)))
    return search.with_columns(found, chunks, columns) if columns else found
