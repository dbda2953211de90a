"""Term vectors learned from the corpus: co-occurrence counts, positive PMI, randomised SVD.

Terms that stand near the same terms get near vectors, so a question can find a passage that says the same in other words. The
vocabulary is bounded (``VOCABULARY`` terms of the highest document frequency); pairs are counted in the tasks and summed by an
aggregate with map-side combining. The matrix stays a table. Its product with a thin dense matrix, vocabulary x (width +
oversampling), is one pass over the table: the thin matrix is bounded, so it may be broadcast, and the rows of the product
are made by the tasks that hold the rows of the table. Only thin matrices reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.text import terms
from gleaner.session import staged

VOCABULARY = 10_000
LEAST_DOCUMENTS = 20
LEAST_PAIRS = 5
WINDOW = 5
WIDTH, OVERSAMPLING, POWER_ROUNDS = 64, 16, 2
PLACES = 6


class Vocabulary(NamedTuple):
    terms: list[str]  #: by document frequency descending, then by term
    documents: np.ndarray  #: in how many documents each stands
    size: int  #: documents


def fit_vocabulary(docs: DataFrame, text: str, most: int = VOCABULARY, least: int = LEAST_DOCUMENTS) -> Vocabulary:
    counts = docs.select(F.explode(F.array_distinct(terms(F.col(text)))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    rows = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "term").limit(most).collect()
    return Vocabulary([r.term for r in rows], np.array([r.n for r in rows], float), docs.count())


def pair_counts(docs: DataFrame, text: str, vocabulary: Vocabulary, window: int = WINDOW) -> DataFrame:
    """``a, b, n``: how often the terms with numbers a and b stand at most ``window`` terms apart, in either order."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.terms)
    size = max(1, len(vocabulary.terms))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.string())
        for batch in batches:
            for start in range(0, batch.num_rows, 256):  # so that work arrays stay small
                lists = batch.column(0).slice(start, 256)
                numbers = pc.fill_null(pc.index_in(lists.flatten(), known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(len(lengths)), lengths)
                keys = []
                for apart in range(1, window + 1):
                    a, b = numbers[:-apart], numbers[apart:]
                    kept = (owner[:-apart] == owner[apart:]) & (a >= 0) & (b >= 0)
                    keys += [a[kept] * size + b[kept], b[kept] * size + a[kept]]
                found, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array((found // size).astype(np.int32)), pa.array((found % size).astype(np.int32)), pa.array(n)], names=["a", "b", "n"])

    counted = docs.select(F.coalesce(terms(F.col(text)), F.array().cast("array<string>"))).mapInArrow(count, "a int, b int, n bigint")
    return counted.groupBy("a", "b").agg(F.sum("n").alias("n"))


def positive_pmi(pairs: DataFrame, least: int = LEAST_PAIRS) -> DataFrame:
    """``a, b, n, value``: log(n N / (n_a n_b)) where it is positive and the pair stands ``least`` times or more."""
    pairs = staged(pairs, "pairs")
    sums = pairs.groupBy("a").agg(F.sum("n").alias("s"))
    total = pairs.agg(F.sum("n")).first()[0] or 0
    both = pairs.where(F.col("n") >= least).join(sums.withColumnRenamed("s", "s_a"), "a").join(sums.select(F.col("a").alias("b"), F.col("s").alias("s_b")), "b")
    value = F.round(F.log(F.col("n") * F.lit(float(total)) / (F.col("s_a").cast("double") * F.col("s_b"))), PLACES)
    return both.select("a", "b", "n", value.alias("value")).where("value > 0")


def product(matrix: DataFrame, thin: np.ndarray) -> np.ndarray:
    """``matrix`` (a, b, value) times a thin dense matrix. ``matrix`` is dealt by ``a``, so every row is made by one task."""
    shared = matrix.sparkSession.sparkContext.broadcast(thin)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, out = shared.value, {}
        for batch in batches:
            a, b, v = (batch.column(i).to_numpy() for i in range(3))
            for start in range(0, len(a), 4096):
                rows, place = np.unique(a[start : start + 4096], return_inverse=True)
                part = np.zeros((len(rows), right.shape[1]))
                np.add.at(part, place, right[b[start : start + 4096]] * v[start : start + 4096, None])
                for row, values in zip(rows.tolist(), part):
                    out[row] = out[row] + values if row in out else values
        if out:
            values = pa.array([x.tobytes() for x in out.values()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), values], names=["a", "row"])

    found = matrix.select("a", "b", "value").mapInArrow(multiply, "a int, row binary").toArrow()
    out = np.zeros((len(thin), thin.shape[1]))
    for a, row in zip(found["a"].to_pylist(), found["row"].to_pylist()):
        out[a] += np.frombuffer(row)
    shared.destroy()
    return out


def decompose(matrix: DataFrame, size: int, width: int = WIDTH, oversampling: int = OVERSAMPLING, rounds: int = POWER_ROUNDS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values of a symmetric matrix of ``size`` rows, and their vectors as columns."""
    dealt = staged(matrix.select("a", "b", "value").repartition("a"), "matrix")
    start = np.random.default_rng(seed).normal(size=(size, min(size, width + oversampling)))
    basis = np.linalg.qr(product(dealt, start))[0]
    for _ in range(rounds):
        basis = np.linalg.qr(product(dealt, basis))[0]
    values, vectors = np.linalg.eigh(basis.T @ product(dealt, basis))
    order = np.argsort(-np.abs(values), kind="stable")[:width]
    return np.abs(values[order]), basis @ vectors[:, order]


class Model(NamedTuple):
    vocabulary: Vocabulary
    vectors: np.ndarray  #: (terms, width)
    singular_values: np.ndarray

    @property
    def model_id(self) -> str:
        digest = hashlib.md5("\n".join(self.vocabulary.terms).encode() + np.round(self.vectors, PLACES).tobytes()).hexdigest()
        return f"distributional-{self.vectors.shape[1]}-{digest[:12]}"


def fit(docs: DataFrame, text: str, width: int = WIDTH, most: int = VOCABULARY, least: int = LEAST_DOCUMENTS, window: int = WINDOW) -> Model:
    vocabulary = fit_vocabulary(docs, text, most, least)
    size = len(vocabulary.terms)
    if size == 0:
        return Model(vocabulary, np.zeros((0, width)), np.zeros(0))
    values, vectors = decompose(positive_pmi(pair_counts(docs, text, vocabulary, window)), size, width)
    scaled = vectors * np.sqrt(values)
    # The sign of a singular vector is free; its largest entry is made positive.
    signs = np.sign(scaled[np.abs(scaled).argmax(axis=0), np.arange(scaled.shape[1])])
    return Model(vocabulary, np.pad(scaled * np.where(signs == 0, 1, signs), ((0, 0), (0, width - scaled.shape[1]))), values)


def embed_text(df: DataFrame, text: str, model: Model, out: str = "embedding") -> DataFrame:
    """``df`` with the text's vector: the sum of its terms' vectors, weighted by frequency and rarity, of length one.

    A text without a known term has the zero vector.
    """
    spark: SparkSession = df.sparkSession
    rarity = np.log((1 + model.vocabulary.size) / (1 + model.vocabulary.documents)) + 1
    shared = spark.sparkContext.broadcast((model.vocabulary.terms, model.vectors * rarity[:, None]))
    width = model.vectors.shape[1]

    @F.arrow_udf("array<double>")
    def vector(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = pa.array(shared.value[0], pa.string())
        for batch in batches:
            numbers = pc.fill_null(pc.index_in(batch.flatten(), known), -1).to_numpy(zero_copy_only=False)
            lengths = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            sums = np.zeros((len(lengths), width))
            kept = np.flatnonzero(numbers >= 0)
            for part in np.array_split(kept, len(kept) // 65_536 + 1):
                np.add.at(sums, owner[part], shared.value[1][numbers[part]])
            norms = np.linalg.norm(sums, axis=1, keepdims=True)
            unit = np.divide(sums, norms, out=np.zeros_like(sums), where=norms > 0)
            offsets = np.arange(0, unit.size + 1, width, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(unit.ravel()))

    return df.withColumn(out, vector(F.coalesce(terms(F.col(text)), F.array().cast("array<string>"))))
