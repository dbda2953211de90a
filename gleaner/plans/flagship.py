"""One question set end to end: search, prompt, and whether the planted passage was found."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators import answer, prompt, search
from gleaner.plans.stages import benchmark_questions, prepare, retrieve
from gleaner.session import ship_package


def ask(spark: SparkSession, sf_dir: str, k: int = 2) -> DataFrame:
    """(query_id, best_score, holds_question, answer, prompt) for every benchmark question."""
    ship_package(spark)
    chunks, model = prepare(spark, sf_dir)
    asked = benchmark_questions(spark, sf_dir)
    found = retrieve(chunks, model, asked, k, ["content"])
    best = found.groupBy("query_id").agg(F.max("score").alias("best_score"))
    ready = search.contexts(found, asked).join(best, "query_id", "left")
    answered = answer.best_sentence(ready, "question", "context")

    def flat(text):
        return F.regexp_replace(text, r"\s+", " ")

    context = prompt.stuffed(F.col("context"))
    return answered.select(
        "query_id",
        "best_score",
        F.contains(flat(context), flat(F.col("question"))).alias("holds_question"),
        prompt.guarded(F.col("answer"), F.col("best_score"), 0.3).alias("answer"),
        prompt.filled(context, F.col("question")).alias("prompt"),
    )
