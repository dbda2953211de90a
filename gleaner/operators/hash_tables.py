"""Approximate search by several independent hash tables of random projections.

Each table cuts one random direction into buckets of equal length (``BucketedRandomProjectionLSH``), so near vectors tend to
share a bucket. A query looks, in every table, into its own bucket and the ``radius`` buckets on both sides; the rows found in
any table are scored exactly. Candidates never become rows of pairs: the buckets are cells of ``search.nearest``,
which passes on the best k of each.

How many tables and how wide a radius is not guessed: ``choose`` measures on a sample of queries which share of the
true neighbours every combination finds, and takes the cheapest one that reaches the wanted recall. Where the data has no near
neighbours to speak of, that is nearly everything, and ``share`` says so: then exact search is the better plan.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators import search
from gleaner.session import staged

TABLES = 8
#: Length of a bucket, in standard deviations of the projection of a vector of length one.
BUCKET = 0.5
MOST_RADIUS = 12
RECALL_SAMPLE = 1000


class Choice(NamedTuple):
    tables: int
    radius: int
    recall: float  #: share of the sample's true neighbours that are found
    share: float  #: pairs that are scored, as a share of all pairs; above 1 it costs more than exact search


def fit(rows: DataFrame, vector: str, width: int, tables: int = TABLES, bucket: float = BUCKET, seed: int = 7) -> BucketedRandomProjectionLSHModel:
    """The random directions; only the width of the vectors is read."""
    one = rows.limit(1).select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    return BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket / width**0.5, numHashTables=tables, seed=seed).fit(one)


def hashed(rows: DataFrame, vector: str, model: BucketedRandomProjectionLSHModel) -> DataFrame:
    """``rows`` with ``hashes``, the bucket of the vector in every table."""
    own = model.transform(rows.withColumn("features", array_to_vector(F.col(vector).cast("array<double>"))))
    buckets = F.transform("hashes", lambda h: vector_to_array(h)[0].cast("int"))
    return own.withColumn("hashes", buckets).drop("features")


def choose(rows: DataFrame, queries: DataFrame, k: int, width: int, recall: float = 0.9, itself: bool = True, sample: int = RECALL_SAMPLE) -> Choice:
    """The cheapest tables and radius whose recall, with its lower confidence bound, reaches ``recall``.

    ``rows`` is (key, embedding, hashes), ``queries`` (query_id, embedding, hashes). At most ``sample`` queries are
    asked, and searched exactly.
    """
    asked = staged(queries.orderBy(F.xxhash64("query_id"), "query_id").limit(sample), "recall-sample")
    truth = search.nearest(rows, asked, k if itself else k + 1, width)
    if not itself:
        truth = search.ranked(truth.where("key <> query_id").drop("rank"), k)
    truth = staged(truth.select("query_id", "key"), "true-neighbours")
    pairs = rows.select("key", F.col("hashes").alias("_theirs")).join(F.broadcast(truth), "key").join(F.broadcast(asked.select("query_id", "hashes")), "query_id")
    # How far apart the two stand in the best of the first 1, 2, ... tables.
    apart = F.zip_with("hashes", "_theirs", lambda a, b: F.abs(a - b))
    nearest = F.transform(F.sequence(F.lit(1), F.size("hashes")), lambda n: F.array_min(F.slice(apart, F.lit(1), n)))
    found = pairs.select(F.posexplode(nearest).alias("tables", "radius")).groupBy("tables", "radius").count().collect()
    sizes = rows.select(F.posexplode("hashes").alias("table", "bucket")).groupBy("table", "bucket").count().collect()
    total, total_pairs = rows.count(), sum(r["count"] for r in found if r.tables == 0)
    best = None
    for tables in sorted({r.tables for r in found}):
        for radius in range(MOST_RADIUS + 1):
            share = sum(r["count"] for r in found if r.tables == tables and r.radius <= radius) / total_pairs
            if share - 1.645 * (share * (1 - share) / total_pairs) ** 0.5 < recall:
                continue
            own = {(r.table, r.bucket): r["count"] for r in sizes if r.table <= tables}
            met = sum(n * own.get((t, b + d), 0) for (t, b), n in own.items() for d in range(-radius, radius + 1))
            if best is None or met / total**2 < best.share:
                best = Choice(tables + 1, radius, share, met / total**2)
            break
    return best or Choice(len(found) and max(r.tables for r in found) + 1, MOST_RADIUS, 0.0, 1.0)


def nearest(rows: DataFrame, queries: DataFrame, k: int, width: int, choice: Choice, **limits: int) -> DataFrame:
    """(query_id, rank, score, key): the best k of the rows that share a bucket with the query, or stand beside one, in any table."""

    def cells(df: DataFrame, names: list[str], radius: int):
        some = df.select(*names, F.posexplode(F.slice("hashes", 1, choice.tables)).alias("table", "_own"))
        near = F.explode(F.sequence(F.col("_own") - radius, F.col("_own") + radius)) if radius else F.col("_own")
        return some.select(*names, "table", near.alias("bucket"))

    stored, asked = cells(rows, ["key", "embedding"], 0), cells(queries, ["query_id", "embedding"], choice.radius)
    return search.nearest(stored, asked, k, width, within=["table", "bucket"], overlapping=True, **limits)
