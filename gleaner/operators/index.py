"""A vector index as files: a base table in coarse buckets, change sets beside it, and metadata.

Layout below the index path::

    meta/             one row per published version (append only), with the schema of the rows
                      and, if the index makes its vectors from text, the model weights
    centres/          the centres of the buckets (``quantiser``)
    base-<version>/   key, columns, embedding (packed, as it was given), version; partitioned by bucket
    changes/sync=<n>/writer=<w>/batch=<b>/
                      upserted and deleted rows of batch b of a writer, the n-th set of the index

A sync writes only its change set, whatever the size of the base. A set belongs to its writer and
the writer's own batch number: a repeated batch finds its set and changes nothing, and two
writers never touch the same set. Every row has a version; for each key the highest
(version, sync, writer) counts, so a row that comes late or twice does not undo a newer one. A
set without versions of its own takes the present version of each key.
``compact`` folds the change sets into the next base and publishes it with a new
metadata row; a path that is being read is never written.

Vectors are written, shuffled and stored packed: values that are not zero with their places, in four bytes where that is all of a
value. They are scaled to length one when they are read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, ShortType, StructField, StructType

from gleaner.operators import embed, quantiser, search
from gleaner.operators.changes import repeated_keys, row_hash
from gleaner.session import let_go, staged

#: Queries that choose the number of probes; the sample and its true neighbours are broadcast.
RECALL_SAMPLE = 1000

#: Values that are scaled at a time.
SCALE_VALUES = 1 << 20
#: Rows that are packed at a time.
PACK_ROWS = 1024
#: From this share of the buckets on (one in ...) a query lists its buckets; below it is sent to each of them.
LISTED_SHARE = 8

META_SCHEMA = (
    "version bigint, mode string, model_id string, width int, columns array<string>, "
    "applied_sync bigint, buckets int, schema string, weights array<double>"
)


class Probing(NamedTuple):
    """How many buckets to search, and the share of true neighbours that the sample found in them."""

    probes: int
    recall: float


@dataclass(frozen=True, eq=False)
class Index:
    """Metadata of the newest published version."""

    path: str
    version: int
    mode: str
    model_id: str
    width: int
    columns: tuple[str, ...]
    applied_sync: int
    buckets: int
    schema: str
    weights: np.ndarray

    @property
    def base(self) -> str:
        return f"{self.path}/base-{self.version}"

    @property
    def row_schema(self) -> StructType:
        """Of the rows of the base, without opening one of its files."""
        return StructType.fromJson(json.loads(self.schema))

    def centres(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(quantiser.SCHEMA).parquet(f"{self.path}/centres")


def open_index(spark: SparkSession, path: str) -> Index | None:
    """The index at a path, or None if nothing was published there."""
    try:
        row = spark.read.schema(META_SCHEMA).parquet(f"{path}/meta").orderBy(F.desc("version")).first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if row is None:
        return None
    return Index(
        path, row.version, row.mode, row.model_id, row.width, tuple(row.columns), row.applied_sync,
        row.buckets, row.schema, np.array(row.weights),
    )


def _publish(spark: SparkSession, index: Index) -> Index:
    row = (
        index.version, index.mode, index.model_id, index.width, list(index.columns), index.applied_sync,
        index.buckets, index.schema, index.weights.tolist(),
    )
    spark.createDataFrame([row], META_SCHEMA).coalesce(1).write.mode("append").parquet(f"{index.path}/meta")
    return index


def _scaled(batch: pa.Array) -> pa.Array:
    """Lists of numbers as unit vectors; zero vectors and those with a null value stay as they are."""
    lengths = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    held = batch.flatten().cast(pa.float64())
    missing, flat = held.is_null().to_numpy(zero_copy_only=False), held.to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    scales = np.ones(len(lengths))
    for width in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == width)
        for part in np.array_split(at, len(at) * width // SCALE_VALUES + 1):
            places = (ends[part] - width)[:, None] + np.arange(width)
            # Summed in the order of the list.
            norms = np.sqrt(np.cumsum(flat[places] ** 2, axis=1)[:, -1])
            scales[part] = np.where((norms <= 0) | missing[places].any(axis=1), 1.0, norms)
    values = pa.array(flat / np.repeat(scales, lengths), mask=missing)
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32), mask=np.append(batch.is_null().to_numpy(zero_copy_only=False), False))
    return pa.ListArray.from_arrays(offsets, values)


def normalised(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Vectors scaled to length one, each list in one pass: in nested column expressions the length was made anew for every value."""

    @F.arrow_udf("array<double>")
    def scaled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _scaled(batch)

    return df.withColumn(vector, scaled(F.col(vector)))


def _packed_type(width: int) -> StructType:
    place = ShortType() if width <= 1 << 15 else IntegerType()
    return StructType([StructField("idx", ArrayType(place)), StructField("val", ArrayType(FloatType())), StructField("wide", ArrayType(DoubleType()))])


def _lists(lengths: np.ndarray, flat: pa.Array, null: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(null, False)), flat)


def _parts(batch: pa.Array) -> list[pa.Array]:
    return [batch.slice(start, PACK_ROWS) for start in range(0, max(1, len(batch)), PACK_ROWS)]


def _pack(batch: pa.Array, width: int) -> pa.StructArray:
    """Lists of ``width`` numbers, or nulls, as ``idx``, ``val`` and ``wide``: values in ``val`` if four bytes hold all of them, else in ``wide``; all of them and no places if most are not zero."""
    null = batch.is_null().to_numpy(zero_copy_only=False)
    held = batch.flatten().cast(pa.float64())
    missing = held.is_null().to_numpy(zero_copy_only=False).reshape(-1, width)
    made = np.zeros((len(batch), width))
    gaps = np.zeros((len(batch), width), bool)
    made[~null], gaps[~null] = held.to_numpy(zero_copy_only=False).reshape(-1, width), missing
    kept = (made != 0) | np.signbit(made) | gaps
    whole = 2 * kept.sum(axis=1) > width
    kept |= whole[:, None]
    kept[null] = False
    with np.errstate(over="ignore"):
        small = np.where(gaps, 0.0, made)
        four = ((small.astype(np.float32) == small) | np.isnan(small)).all(axis=1) & ~null
    places = np.nonzero(kept & ~whole[:, None])[1].astype(np.int16 if width <= 1 << 15 else np.int32)
    counts = kept.sum(axis=1)

    def values(mine: np.ndarray, kind) -> pa.ListArray:
        at = kept & mine[:, None]
        return _lists(np.where(mine, counts, 0), pa.array(made[at].astype(kind), mask=gaps[at]), ~mine)

    idx = _lists(np.where(whole | null, 0, counts), pa.array(places), null)
    columns = [idx, values(four, np.float32), values(~four & ~null, np.float64)]
    return pa.StructArray.from_arrays(columns, ["idx", "val", "wide"], mask=pa.array(null))


def _unpack(batch: pa.StructArray, width: int) -> pa.ListArray:
    """The lists that ``_pack`` was given, as doubles."""
    null = batch.is_null().to_numpy(zero_copy_only=False)
    made, gaps = np.zeros((len(batch), width)), np.zeros((len(batch), width), bool)
    idx, val, wide = (batch.field(name) for name in ("idx", "val", "wide"))
    own = np.where(null, 0, pc.fill_null(pc.list_value_length(idx), 0).to_numpy(zero_copy_only=False))
    for values in (val, wide):
        mine = values.is_valid().to_numpy(zero_copy_only=False) & ~null
        rows = np.flatnonzero(mine)
        if not len(rows):
            continue
        lists, places = values.take(pa.array(rows)), idx.take(pa.array(rows))
        counts = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat, at = lists.flatten(), np.repeat(rows, counts)
        dense = np.repeat(own[rows] == 0, counts)
        where = np.empty(len(flat), np.int64)
        where[~dense] = places.flatten().to_numpy(zero_copy_only=False)
        where[dense] = (np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts))[dense]
        empty = flat.is_null().to_numpy(zero_copy_only=False)
        made[at, where] = np.where(empty, 0.0, flat.cast(pa.float64()).to_numpy(zero_copy_only=False))
        gaps[at, where] = empty
    return _lists(np.where(null, 0, width), pa.array(made[~null].ravel(), mask=gaps[~null].ravel()), null)


def _stored(df: DataFrame, index: Index) -> DataFrame:
    """Rows as they are stored: with their bucket, and ``embedding`` packed."""
    width = index.width

    @F.arrow_udf(_packed_type(width))
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.concat_arrays([_pack(part, width) for part in _parts(batch)])

    made = normalised(df.withColumn("_unit", F.col("embedding")), "_unit").withColumn("embedding", packed(F.col("embedding")))
    return quantiser.place(made, "_unit", index.centres(df.sparkSession), width).drop("_unit")


def _unit_rows(stored: DataFrame, index: Index) -> DataFrame:
    """Stored rows with their vectors of length one."""
    width = index.width

    @F.arrow_udf("array<double>")
    def unpacked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.concat_arrays([_scaled(_unpack(part, width)) for part in _parts(batch)])

    return stored.withColumn("embedding", unpacked(F.col("embedding")))


def _write_base(df: DataFrame, path: str) -> None:
    # REBALANCE lets the runtime split a bucket that holds a large part of all rows.
    df.hint("rebalance", "bucket").write.option("compression", "zstd").partitionBy("bucket").parquet(path)


def _checked(df: DataFrame, vector: str, width: int) -> DataFrame:
    """Fail the job that reads a vector of another width, or one that holds a NaN."""
    message = F.concat(F.lit("vector holds NaN, key "), F.col("key").cast("string"))
    fitting = search.of_width(df, "key", vector, width)
    return fitting.withColumn(vector, F.when(F.exists(vector, F.isnan), F.raise_error(message)).otherwise(F.col(vector)))


def _unique(df: DataFrame, key: str) -> None:
    copies = repeated_keys(df.select(key), key).first()
    if copies is not None:
        raise ValueError(f"key {copies[0]} stands in {copies[1]} rows; keep one with changes.latest_per_key")


def create_from_vectors(
    rows: DataFrame,
    path: str,
    key: str,
    width: int,
    columns: list[str],
    model: str = "given",
    buckets: int | None = None,
    mode: str = "vectors",
    training: DataFrame | None = None,
    weights: np.ndarray | None = None,
    version: str | None = None,
) -> Index:
    """Build an index from precomputed vectors. A vector of another width and a repeated key are errors.

    ``version`` names a bigint column; without it all rows have version 0. The buckets are trained on a bounded sample of
    the rows, or of those of ``training`` if given; their number follows the square root of the rows if it is not given.
    """
    spark = rows.sparkSession
    number = F.col(version) if version else F.lit(0)
    table = rows.select(F.col(key).alias("key"), *columns, "embedding", number.cast("bigint").alias("version"))
    _unique(table, "key")
    trained = _checked(table if training is None else training.withColumn("key", F.lit(None)), "embedding", width)
    centres = quantiser.train(normalised(trained), "embedding", trained.count(), width, buckets)
    centres.write.mode("overwrite").parquet(f"{path}/centres")
    ready = _checked(table, "embedding", width)
    fields = [StructField("embedding", _packed_type(width)) if f.name == "embedding" else f for f in ready.schema.fields]
    schema = StructType([*fields, StructField("bucket", IntegerType())])
    weights = np.zeros(0) if weights is None else weights
    index = Index(path, 1, mode, model, width, tuple(columns), -1, 0, schema.json(), weights)
    index = replace(index, buckets=index.centres(spark).count())
    _write_base(_stored(ready, index).select(*schema.names), index.base)
    let_go(spark)
    return _publish(spark, index)


def create_from_text(
    counted: DataFrame, path: str, key: str, text: str, columns: list[str], tf: str = "tf", buckets: int | None = None
) -> Index:
    """Build an index that makes its own vectors; its weights are frozen and stored with it.

    ``counted`` is a stored table with term counts (``embed.term_counts``), since the
    weights and the vectors each read it once.
    """
    weights = embed.fit_weights(counted, tf)
    model = embed.embedder(weights)
    counted = counted.withColumnRenamed(tf, "tf")
    keep = [text, *[c for c in columns if c != text]]
    return create_from_vectors(
        embed.embed_counts(counted, model),
        path,
        key,
        len(weights),
        keep,
        embed.model_id(model),
        buckets=buckets,
        mode="text",
        weights=weights,
    )


def load_model(index: Index) -> PipelineModel:
    if index.mode != "text":
        raise ValueError("this index was built from given vectors and has no model")
    return embed.embedder(index.weights)


def current_rows(spark: SparkSession, index: Index) -> DataFrame:
    """The rows of the index: the base, overlaid with the change sets that came after it.

    The keys that changed are written out first, so Spark knows their size: as long as they
    can be broadcast, the base is scanned without a shuffle. ``compact`` keeps it that way.
    """
    return _unit_rows(_stored_rows(spark, index), index)


def _stored_rows(spark: SparkSession, index: Index) -> DataFrame:
    base = spark.read.schema(index.row_schema).parquet(index.base)
    changes = change_sets(spark, index)
    if changes is None:
        return base
    # Narrow first: only these decide which change counts. A key is unique within a set.
    order = ["version", "sync", "writer", "batch"]
    heads = changes.groupBy("key").agg(F.max(F.struct(*order)).alias("_head"))
    heads = staged(heads.select("key", F.col("_head.version").alias("_newer"), *[f"_head.{c}" for c in order[1:]]), "heads")
    marks = heads.select("key", "_newer")
    kept = base.join(marks, "key", "left").where("_newer IS NULL OR _newer < version").drop("_newer")
    late = base.select("key", "version").join(marks, "key").where("_newer < version").select("key")
    late = staged(late, "late")
    newest = changes.where(~F.col("deleted")).join(heads.select("key", *order[1:]), ["key", *order[1:]], "left_semi")
    return kept.unionByName(newest.join(late, "key", "left_anti").select(*base.columns))


def change_sets(spark: SparkSession, index: Index) -> DataFrame | None:
    try:
        changes = spark.read.option("basePath", f"{index.path}/changes").parquet(f"{index.path}/changes")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return changes.withColumn("writer", F.col("writer").cast("string")).where(F.col("sync") > index.applied_sync)


def write_changes(
    spark: SparkSession,
    index: Index,
    batch: int | None = None,
    upserts: DataFrame | None = None,
    deletes: DataFrame | None = None,
    version: str | None = None,
    writer: str | None = None,
) -> None:
    """Write one change set: rows to upsert (key, columns, embedding) and keys to delete.

    A key may stand in it once, as an upsert or as a delete. ``version`` names a bigint column of both; without it
    each key keeps its present version, and the later set counts. ``writer`` and ``batch`` name a set that may be
    repeated: if it is there, nothing is written. Without them it is a set of its own.
    """
    row = index.row_schema
    writer, batch = writer or f"w{uuid.uuid4().hex}", batch or 0
    changes = change_sets(spark, index)
    if changes is not None and not changes.where((F.col("writer") == writer) & (F.col("batch") == batch)).isEmpty():
        return
    number = F.col(version if version else "_version").cast("bigint").alias("version")
    both = [df.select("key") for df in (upserts, deletes) if df is not None]
    _unique(both[0] if len(both) == 1 else both[0].unionByName(both[1]), "key")
    if version is None:
        have = current_rows(spark, index).select("key", F.col("version").alias("_version"))

        def versioned(df: DataFrame | None) -> DataFrame | None:
            return None if df is None else df.join(have, "key", "left").withColumn("_version", F.coalesce("_version", F.lit(0)))

        upserts, deletes = versioned(upserts), versioned(deletes)
    parts = []
    if upserts is not None:
        table = upserts.select("key", *index.columns, "embedding", number)
        parts.append(_stored(_checked(table, "embedding", index.width), index).select(*row.names).withColumn("deleted", F.lit(False)))
    if deletes is not None:
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in row if f.name not in ("key", "version")]
        gone = deletes.select("key", number, *empty)
        parts.append(gone.select(*row.names).withColumn("deleted", F.lit(True)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    place = f"sync={last_sync(spark, index) + 1}/writer={writer}/batch={batch}"
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{index.path}/changes/{place}")


def last_sync(spark: SparkSession, index: Index) -> int:
    changes = change_sets(spark, index)
    newest = None if changes is None else changes.agg(F.max("sync")).first()[0]
    return index.applied_sync if newest is None else newest


def compact(spark: SparkSession, index: Index) -> Index:
    """Fold all change sets into the next base and publish it."""
    upto = last_sync(spark, index)
    if upto == index.applied_sync:
        return index
    following = replace(index, version=index.version + 1, applied_sync=upto)
    _write_base(_stored_rows(spark, index), following.base)
    return _publish(spark, following)


def create_or_sync(
    rows: DataFrame, path: str, key: str, width: int, columns: list[str], model: str = "given", buckets: int | None = None
) -> Index:
    """Create the index if there is none; otherwise bring it in step with ``rows``, the whole source.

    An index keeps its mode and model: vectors of two models cannot be compared.
    """
    index = open_index(rows.sparkSession, path)
    if index is None:
        return create_from_vectors(rows, path, key, width, columns, model, buckets=buckets)
    check_model(index, model, "vectors")
    ready = rows.select(F.col(key).alias("key"), *columns, "embedding")
    _sync(index, ready, normalised(ready), [*columns, "embedding"])
    return index


def create_or_sync_text(
    counted: DataFrame, path: str, key: str, text: str, columns: list[str], tf: str = "tf", buckets: int | None = None
) -> Index:
    """The same for an index that makes its own vectors; new rows are embedded with its frozen model."""
    index = open_index(counted.sparkSession, path)
    if index is None:
        return create_from_text(counted, path, key, text, columns, tf, buckets)
    check_model(index, index.model_id, "text")
    made = embed.embed_counts(counted.withColumnRenamed(tf, "tf"), load_model(index))
    ready = made.select(F.col(key).alias("key"), *index.columns, "embedding")
    _sync(index, ready, ready, list(index.columns))
    return index


def _sync(index: Index, source: DataFrame, compared: DataFrame, by: list[str]) -> None:
    """Write what was added, changed or removed since the last sync as one change set.

    Source and index meet by key and row hash only. The keys that differ are written out,
    so that Spark knows how few they are when it fetches their rows.
    """
    spark = source.sparkSession
    wanted = compared.select("key", row_hash(by).alias("_want"))
    have = current_rows(spark, index).select("key", row_hash(by).alias("_have"))
    differ = wanted.join(have, "key", "full_outer").where(~F.col("_want").eqNullSafe(F.col("_have")))
    keys = staged(differ.select("key", F.col("_want").isNull().alias("gone")), "to-sync")
    if keys.isEmpty():
        return
    write_changes(
        spark,
        index,
        upserts=source.join(keys.where("NOT gone").select("key"), "key", "left_semi"),
        deletes=keys.where("gone").select("key"),
    )


def check_model(index: Index, model: str, mode: str | None = None) -> None:
    if mode is not None and index.mode != mode:
        raise ValueError(f"index {index.path} is in mode {index.mode}, not {mode}")
    if index.model_id != model:
        raise ValueError(f"index {index.path} was made with {index.model_id}, not {model}")


def search_index(
    spark: SparkSession,
    index: Index,
    queries: DataFrame,
    k: int,
    model: str,
    probes: int | None = None,
    query_id: str = "query_id",
    vector: str = "embedding",
    where: Column | None = None,
    within: list[str] | None = None,
    **limits: int,
) -> DataFrame:
    """(query_id, rank, score, key). With ``probes``, only that many nearest buckets are searched. Where they are a large part of all,
    a query carries them as a bitmap and meets each block of rows once; a copy for each bucket would be many times the query set.

    ``where`` filters the rows before ranking; ``within`` names columns of rows and queries that must be equal.
    """
    check_model(index, model)
    rows = current_rows(spark, index)
    if where is not None:
        rows = rows.where(where)
    if probes is None:
        return search.nearest(rows, queries, k, index.width, query_id=query_id, vector=vector, within=within, **limits)
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("embedding"), *(within or []))
    # The centres are those of vectors of length one.
    ready = normalised(search.of_width(asked, "query_id", "embedding", index.width))
    if probes * LISTED_SHARE >= index.buckets and index.buckets * index.width * 8 <= quantiser.BROADCAST_BYTES:
        listing = ready.withColumn("_bins", quantiser.nearest_buckets(F.col("embedding"), index.centres(spark), probes))
        return search.nearest(rows, listing, k, index.width, within=within, listed=("bucket", "_bins"), **limits)
    near = bucket_order(spark, index, ready, probes).select("query_id", "bucket")
    spread = staged(ready.join(near, "query_id"), "probes")
    # At most as many values as the index has buckets; other partitions are not read.
    wanted = [row.bucket for row in spread.select("bucket").distinct().collect()]
    return search.nearest(
        rows, spread, k, index.width, where=F.col("bucket").isin(wanted), within=["bucket", *(within or [])], **limits
    )


def bucket_order(spark: SparkSession, index: Index, queries: DataFrame, n: int) -> DataFrame:
    """(query_id, bucket, place): the ``n`` nearest buckets of queries of length one, by a search among the centres."""
    centres = index.centres(spark).select(F.col("bucket").cast("bigint").alias("key"), F.col("centre").alias("embedding"))
    near = search.nearest(centres, queries, n, index.width, measure="l2")
    return near.select("query_id", F.col("key").cast("int").alias("bucket"), F.col("rank").alias("place"))


def choose_probes(
    spark: SparkSession,
    index: Index,
    queries: DataFrame,
    k: int,
    recall: float = 0.9,
    query_id: str = "query_id",
    vector: str = "embedding",
    itself: bool = True,
    sample: int = RECALL_SAMPLE,
) -> Probing:
    """The fewest buckets that hold the share ``recall`` of the ``k`` nearest rows of a query, measured against exact search.

    For at most ``sample`` queries (the smallest hashes of their ids) the true neighbours are found among all rows; how
    far down the query's order of buckets each neighbour's bucket stands gives the recall of every number of probes at
    once. The lower confidence bound of the share has to reach ``recall``, so a small sample takes more probes. With
    ``itself`` False a query is not its own neighbour, for rows that ask about themselves.
    """
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("embedding"))
    asked = asked.orderBy(F.xxhash64("query_id"), "query_id").limit(sample)
    asked = staged(normalised(search.of_width(asked, "query_id", "embedding", index.width)), "recall-sample")
    rows = current_rows(spark, index)
    truth = search.nearest(rows, asked, k if itself else k + 1, index.width)
    if not itself:
        truth = search.ranked(truth.where("key <> query_id").drop("rank"), k)
    truth = staged(truth.select("query_id", "key"), "true-neighbours")
    held = rows.select("key", "bucket").join(F.broadcast(truth), "key")
    places = held.join(bucket_order(spark, index, asked, index.buckets), ["query_id", "bucket"])
    counts = {r.place: r["count"] for r in places.groupBy("place").count().collect()}
    total, seen = sum(counts.values()), 0
    for probes in range(1, index.buckets + 1):
        seen += counts.get(probes, 0)
        share = seen / max(1, total)
        if share - 1.645 * (share * (1 - share) / max(1, total)) ** 0.5 >= recall:
            return Probing(probes, share)
    return Probing(index.buckets, 1.0)


def search_text(
    spark: SparkSession,
    index: Index,
    questions: DataFrame,
    k: int,
    columns: list[str] | None = None,
    where: Column | None = None,
    within: list[str] | None = None,
    probes: int | None = None,
) -> DataFrame:
    """Ask an index that makes its own vectors: (query_id, rank, score, key, columns) for (query_id, question) rows."""
    asked = embed.embed_text(questions, "question", load_model(index))
    found = search_index(spark, index, asked, k, index.model_id, probes, where=where, within=within)
    return search.with_columns(found, current_rows(spark, index), columns) if columns else found
