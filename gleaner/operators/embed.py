"""Text to vectors.

The built-in embedder is lexical: terms are hashed into a fixed number of buckets,
weighted by tf-idf and scaled to length one. Counting, weighting and scaling are
spark.ml transformers, so they run per row in the JVM, without a shuffle. Only the
document frequencies need a pass over the corpus, and their size is the vector width.

A model of the user's own comes in through ``embed_with``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.text import hex_number, terms

# Vector width and the most inputs one model request may hold.
VECTOR_WIDTH = 1024
REQUEST_SIZE = 150


def term_counts(
    df: DataFrame, text: str, out: str = "tf", width: int = VECTOR_WIDTH, size: str | None = None
) -> DataFrame:
    """Add the sparse vector of hashed term counts of a text and, if ``size`` is given, its number of terms."""
    listed = df.withColumn("_terms", terms(F.col(text)))
    if size:
        listed = listed.withColumn(size, F.size("_terms"))
    buckets = F.transform("_terms", lambda t: (hex_number(t, 1, 8) % width).cast("string"))
    counter = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(width)], inputCol="_buckets", outputCol=out
    )
    return counter.transform(listed.withColumn("_buckets", buckets)).drop("_buckets", "_terms")


def fit_weights(counted: DataFrame, tf: str = "tf") -> np.ndarray:
    """Inverse document frequencies ``ln((n + 1) / (df + 1))`` of a counted corpus, one per bucket."""
    return IDF(inputCol=tf, outputCol="_tfidf").fit(counted).idf.toArray()


def embedder(weights: np.ndarray) -> PipelineModel:
    """The frozen model: weighting and scaling. Its weights are all it takes to make it again."""
    weighting = ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="tf", outputCol="_tfidf")
    return PipelineModel([weighting, Normalizer(inputCol="_tfidf", outputCol="_unit", p=2.0)])


def weights_of(model: PipelineModel) -> np.ndarray:
    return model.stages[0].getScalingVec().toArray()


def embed_counts(counted: DataFrame, model: PipelineModel, out: str = "embedding") -> DataFrame:
    """Term counts to ``array<float>`` vectors of length one; a text without terms gives a zero vector."""
    made = model.transform(counted).withColumn(out, vector_to_array("_unit", dtype="float32"))
    return made.drop("_tfidf", "_unit")


def embed_text(df: DataFrame, text: str, model: PipelineModel, out: str = "embedding") -> DataFrame:
    """Embed texts, such as questions, with the frozen weights of the corpus."""
    width = len(weights_of(model))
    return embed_counts(term_counts(df, text, "tf", width), model, out).drop("tf")


def model_id(model: PipelineModel) -> str:
    """Name of a model; it changes when any weight changes."""
    weights = weights_of(model)
    return f"hashed-tfidf-{len(weights)}-{hashlib.md5(weights.tobytes()).hexdigest()[:12]}"


def nonzero_weights(df: DataFrame, vector: str, *keep: str) -> DataFrame:
    """One row per bucket with a weight: the long form of a vector column."""
    long = df.select(*keep, F.posexplode_outer(vector).alias("bucket", "weight"))
    return long.where((F.col("bucket").isNotNull()) & (F.col("weight") != 0))


def request_batches(texts: Iterator[list], size: int = REQUEST_SIZE) -> Iterator[list]:
    """Re-cut a stream of lists into lists of exactly ``size``; only the last may be shorter."""
    held: list = []
    for part in texts:
        held.extend(part)
        while len(held) >= size:
            yield held[:size]
            held = held[size:]
    if held:
        yield held


def embed_with(
    df: DataFrame,
    key: str,
    text: str,
    connect: Callable[[], Callable[[list[str]], list[list[float]]]],
    request_size: int = REQUEST_SIZE,
    out: str = "embedding",
) -> DataFrame:
    """Embed with a user model: (key, text, embedding).

    ``connect`` runs once per task. Requests hold up to ``request_size`` texts in their
    order, across the borders of Arrow batches; an error in the model fails the task.
    """
    source = df.select(key, text)
    schema = T.StructType([*source.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embed = connect()
        rows = (list(zip(f[key], f[text])) for f in frames)
        for batch in request_batches(rows, request_size):
            vectors = embed([t for _, t in batch])
            if len(vectors) != len(batch):
                raise ValueError(f"model gave {len(vectors)} vectors for {len(batch)} texts")
            yield pd.DataFrame({key: [k for k, _ in batch], text: [t for _, t in batch], out: vectors})

    return source.mapInPandas(run, schema)


def split_by_width(df: DataFrame, vector: str, width: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose vector has the wanted width, and all others (also null vectors)."""
    fits = F.coalesce(F.size(vector) == width, F.lit(False))
    return df.where(fits), df.where(~fits)
