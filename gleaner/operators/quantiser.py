"""Coarse buckets for vectors: centres in two levels, kept as a table.

The centres are trained on a sample of at most about ``SAMPLE`` different vectors, so training costs the same for any number of
rows (beyond the scan that takes the sample). The first level is a k-means of about the square root of the wanted
buckets; every cell of it is split by a k-means of its own, in a task of its own, into buckets in proportion to its
rows. A vector finds its bucket by descent: first the nearest centre of the upper level, then the nearest below it.

Centres of up to ``BROADCAST_BYTES`` go to every task. Beyond that only the upper level does, and the rows of an upper cell meet its
centres block by block (``blocks.paired``), so that no task holds all centres. Both ways give the same buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleaner.operators import blocks, search
from gleaner.session import staged

SAMPLE = 1 << 16
#: Sampled vectors for a centre, at least.
PER_CENTRE = 8
BROADCAST_BYTES = 32 << 20
ROUNDS = 8

SCHEMA = "bucket int, top int, centre array<double>, top_centre array<double>"


def bucket_count(rows: int) -> int:
    """About the square root of the rows, so that buckets and their number grow alike."""
    return max(1, round(rows**0.5))


def _sample(vectors: DataFrame, rows: int, most: int) -> DataFrame:
    """Different vectors, chosen by a hash: a vector that stands in many rows counts once."""
    steps = 1 << 30
    hashed = vectors.withColumn("_h", F.xxhash64("v"))
    if rows > most:
        hashed = hashed.where(F.pmod("_h", F.lit(steps)) < int(steps * (most / rows)))
    return staged(hashed.dropDuplicates(["_h"]).select("v"), "training")


def lloyd(points: np.ndarray, k: int, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of ``k`` groups of the points of one cell. A centre that loses all its points stays where it is."""
    rng = np.random.default_rng(seed)
    centres = points[np.sort(rng.choice(len(points), k, replace=False))].copy()
    for _ in range(rounds):
        own = nearest_of(points, centres)
        sums, counts = np.zeros_like(centres), np.bincount(own, minlength=k)
        np.add.at(sums, own, points)
        held = counts > 0
        centres[held] = sums[held] / counts[held, None]
    return centres


def nearest_of(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The number of the nearest centre of each point, the smaller one on ties; scores are made in steps."""
    step = max(1, search.SCORE_BYTES // (8 * max(1, len(centres))))
    parts = [search.score_matrix(points[i : i + step], centres, "l2").argmax(axis=1) for i in range(0, len(points), step)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def train(vectors: DataFrame, vector: str, rows: int, width: int, buckets: int | None = None, seed: int = 7, sample: int = SAMPLE) -> DataFrame:
    """The table of centres (``SCHEMA``): at most as many as there are different sampled vectors, and at least one."""
    spark = vectors.sparkSession
    points = _sample(vectors.select(F.col(vector).cast("array<double>").alias("v")), rows, sample)
    found = points.count()
    wanted = min(bucket_count(rows), found // PER_CENTRE) if buckets is None else min(buckets, found)
    if wanted < 2:
        return spark.createDataFrame([(0, 0, [0.0] * width, [0.0] * width)], SCHEMA)
    n_tops = max(1, round(wanted**0.5))
    features = points.select(array_to_vector("v").alias("features"))
    tops = np.array(KMeans(k=n_tops, seed=seed, maxIter=5, initMode="random").fit(features).clusterCenters()) if n_tops > 1 else np.zeros((1, width))
    placed = staged(points.withColumn("top", _nearest(spark, F.col("v"), tops)), "top-cells")
    counts = {r.top: r["count"] for r in placed.groupBy("top").count().collect()}
    split = {top: max(1, min(n, round(wanted * n / found))) for top, n in sorted(counts.items())}
    start = dict(zip(split, np.cumsum([0, *split.values()]).tolist()))

    def leaves(cell: pa.Table) -> pa.Table:
        top = cell["top"][0].as_py()
        # In a fixed order, so that the seed gives the same centres again.
        held = search.matrix(cell["v"])
        held = held[np.lexsort(held.T[::-1])]
        centres = lloyd(held, split[top], seed + top)
        n = len(centres)
        return pa.table(
            {
                "bucket": pa.array(start[top] + np.arange(n), pa.int32()), "top": pa.array([top] * n, pa.int32()),
                "centre": pa.array(centres.tolist(), pa.list_(pa.float64())), "top_centre": pa.array([tops[top].tolist()] * n, pa.list_(pa.float64())),
            }
        )

    return placed.groupBy("top").applyInArrow(leaves, SCHEMA)


def _nearest(spark: SparkSession, vector: Column, centres: np.ndarray) -> Column:
    shared = spark.sparkContext.broadcast(centres)

    @F.arrow_udf("int")
    def near(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((nearest_of(search.matrix(batch), shared.value) if len(batch) else np.zeros(0)).astype(np.int32))

    return near(vector)


def nearest_buckets(vector: Column, centres: DataFrame, n: int) -> Column:
    """The ``n`` nearest buckets of a vector of length one as a bitmap, in the order of ``index.bucket_order``. For centres that can be broadcast."""
    held = centres.orderBy("bucket").toArrow()
    numbers = held["bucket"].to_numpy()
    shared = centres.sparkSession.sparkContext.broadcast((numbers, search.matrix(held["centre"])))
    size = int(numbers.max()) + 1
    step = max(1, search.SCORE_BYTES // (8 * len(numbers)))

    @F.arrow_udf("binary")
    def near(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        numbers, below = shared.value
        for batch in batches:
            points, out = search.matrix(batch) if len(batch) else np.zeros((0, below.shape[1])), []
            for start in range(0, len(points), step):
                scores = np.round(search.score_matrix(points[start : start + step], below, "l2"), search.PLACES)
                order = np.argsort(-scores, axis=1, kind="stable")[:, :n]
                bits = np.zeros((len(scores), size), bool)
                np.put_along_axis(bits, numbers[order], np.take_along_axis(~np.isnan(scores), order, axis=1), axis=1)
                out += [row.tobytes() for row in np.packbits(bits, axis=1)]
            yield pa.array(out, pa.binary())

    return near(vector)


def _tops(centres: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = centres.groupBy("top").agg(F.first("top_centre").alias("c")).orderBy("top").collect()
    return np.array([r.top for r in rows]), np.array([r.c for r in rows])


def place(df: DataFrame, vector: str, centres: DataFrame, width: int, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with the column ``bucket``. Only the vectors pass through Python where the centres can be broadcast."""
    spark = df.sparkSession
    if centres.count() * width * 8 <= broadcast_bytes:
        held = centres.orderBy("bucket").toArrow()
        names, first = np.unique(held["top"].to_numpy(), return_index=True)
        tops = search.matrix(held["top_centre"].take(pa.array(first)))
        own, below = held["top"].to_numpy(), search.matrix(held["centre"])
        shared = spark.sparkContext.broadcast((names, tops, held["bucket"].to_numpy(), own, below))

        @F.arrow_udf("int")
        def descend(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                names, tops, buckets, own, below = shared.value
                points = search.matrix(batch) if len(batch) else np.zeros((0, tops.shape[1]))
                first, out = names[nearest_of(points, tops)], np.zeros(len(points), np.int32)
                for top in np.unique(first):
                    mine, cell = first == top, own == top
                    out[mine] = buckets[cell][nearest_of(points[mine], below[cell])]
                yield pa.array(out)

        return df.withColumn("bucket", descend(F.col(vector)))
    names, tops = _tops(centres)
    shared_tops = spark.sparkContext.broadcast(names)
    number = _nearest(spark, F.col(vector), tops)

    @F.arrow_udf("int")
    def name(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(shared_tops.value[batch.to_numpy(zero_copy_only=False).astype(np.int64)].astype(np.int32))

    rows = staged(df.withColumn("_top", name(number)), "descending")
    below = staged(centres.select(F.col("top").alias("_top"), "bucket", "centre"), "centres")
    out = StructType([*df.schema.fields, *spark.createDataFrame([], "bucket int").schema.fields])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        mine, theirs, found = left["_top"].to_numpy(), right["_top"].to_numpy(), []
        for top in np.intersect1d(mine, theirs):
            part, cell = left.filter(pa.array(mine == top)), right.filter(pa.array(theirs == top)).sort_by("bucket")
            best = nearest_of(search.matrix(part[vector]), search.matrix(cell["centre"]))
            found.append(part.drop_columns("_top").append_column("bucket", pa.array(cell["bucket"].to_numpy()[best], pa.int32())))
        return pa.concat_tables(found)

    size = F.lit(8 * width + 64)
    # All centres of an upper cell stay in one block: a row has to see them together.
    return blocks.paired(rows, below, "_top", size, F.lit(0), meet, out)
