"""Second look at retrieved passages: score them against their question and keep the best."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import terms
from gleaner.session import staged

# The usual BM25 parameters and the number of passages kept.
BM25_K1 = 1.2
BM25_B = 0.75
KEEP = 3


def term_frequencies(corpus: DataFrame, text: str) -> DataFrame:
    """(term, df) over the whole corpus: built and stored once, then used by every re-ranking.

    Counts are reduced in each task before the shuffle, so a term that stands in every
    chunk is one row per task, not one per chunk.
    """
    seen = corpus.select(F.explode_outer(F.array_distinct(terms(F.col(text)))).alias("term"))
    return seen.where(F.col("term").isNotNull()).groupBy("term").agg(F.count("*").alias("df"))


def bm25_scores(
    candidates: DataFrame, frequencies: DataFrame, n_chunks: int, mean_terms: float, text: str = "content"
) -> DataFrame:
    """(query_id, key, bm25) for candidates (query_id, key, question, text).

    ``frequencies`` is the stored ``term_frequencies`` of the corpus; ``n_chunks`` and
    ``mean_terms`` are its number of chunks and their mean number of terms.
    """
    parts = candidates.select(
        "query_id",
        "key",
        F.array_distinct(terms(F.col("question"))).alias("_q"),
        terms(F.col(text)).alias("_d"),
    )
    shared = F.filter("_d", lambda t: F.array_contains(F.col("_q"), t))
    hits = parts.select("query_id", "key", F.size("_d").alias("_length"), F.explode_outer(shared).alias("term"))
    tf = hits.where(F.col("term").isNotNull()).groupBy("query_id", "key", "_length", "term").agg(
        F.count("*").alias("tf")
    )
    # Few rows against the whole vocabulary: written out, so that the small side is known to be small.
    weighted = staged(tf, "hits").join(frequencies, "term")
    idf = F.log(1 + (n_chunks - F.col("df") + 0.5) / (F.col("df") + 0.5))
    length = 1 - BM25_B + BM25_B * F.col("_length") / mean_terms
    part = idf * F.col("tf") * (BM25_K1 + 1) / (F.col("tf") + BM25_K1 * length)
    scores = weighted.groupBy("query_id", "key").agg(F.round(F.sum(part), 6).alias("bm25"))
    return candidates.select("query_id", "key").join(scores, ["query_id", "key"], "left").select(
        "query_id", "key", F.coalesce("bm25", F.lit(0.0)).alias("bm25")
    )


def score_with(
    candidates: DataFrame,
    connect: Callable[[], Callable[[list[str], list[str]], list[float]]],
    text: str = "content",
) -> DataFrame:
    """(query_id, key, score) by a user model that scores lists of questions and passages."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = connect()
        for f in frames:
            made = score(f["question"].tolist(), f[text].tolist())
            yield pd.DataFrame({"query_id": f["query_id"], "key": f["key"], "score": made})

    source = candidates.select("query_id", "key", "question", text)
    return source.mapInPandas(run, "query_id bigint, key bigint, score double")


def best_of(scored: DataFrame, score: str, keep: int | None = KEEP) -> DataFrame:
    """Add ``new_rank`` per question by score, ties to the smaller key, and keep the first ones."""
    order = Window.partitionBy("query_id").orderBy(F.desc(score), "key")
    ranked = scored.withColumn("new_rank", F.row_number().over(order))
    return ranked if keep is None else ranked.where(F.col("new_rank") <= keep)


def order_changes(first: DataFrame, second: DataFrame) -> DataFrame:
    """(query_id, key, rank, new_rank, rank_delta, query_changed); a passage that rose has a positive delta."""
    both = first.select("query_id", "key", "rank").join(
        second.select("query_id", "key", "new_rank"), ["query_id", "key"]
    )
    delta: Column = F.col("rank") - F.col("new_rank")
    per_query = Window.partitionBy("query_id")
    return both.select(
        "query_id",
        "key",
        "rank",
        "new_rank",
        delta.alias("rank_delta"),
        (F.max(F.abs(delta)).over(per_query) > 0).alias("query_changed"),
    )
