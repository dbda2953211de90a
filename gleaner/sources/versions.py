"""A table with versions: a log of commits, and the row changes of every version as files of their own.

Layout below the path::

    log/                one row per version (append only): version, folder, operation, counts
    changes/<folder>/   the row changes of one version: change, columns
    base/<folder>/      the rows of a version that was folded, named by its row in the log

A commit writes only rows that really change: an upsert that equals the present row is nothing. The feed of a range of versions
reads the change files of that range and nothing else; no snapshots are compared. A snapshot overlays the newest
base at or before it with the changes after that base. A folder counts once its row stands in the log, so a commit
that fails half-way leaves nothing to be seen. One writer at a time: two commits of one version are an error for every reader.
A commit that names a ``batch`` is made once, however often it is repeated.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.changes import row_hash
from gleaner.session import staged

LOG_SCHEMA = "version bigint, folder string, operation string, batch string, n_insert bigint, n_update bigint, n_delete bigint"


def log(spark: SparkSession, path: str) -> list:
    """The rows of the log in order; empty if there is no table at the path."""
    try:
        rows = spark.read.schema(LOG_SCHEMA).parquet(f"{path}/log").orderBy("version", "operation").collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    commits = [r.version for r in rows if r.operation != "fold"]
    if len(set(commits)) < len(commits):
        raise ValueError(f"{path} has two commits of one version; it takes one writer at a time")
    return rows


def newest(spark: SparkSession, path: str) -> int:
    """The newest version; 0 if there is none."""
    return max((r.version for r in log(spark, path)), default=0)


def _record(spark: SparkSession, path: str, *row) -> None:
    spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/log")


def _write(changes: DataFrame, path: str, operation: str, batch: str | None) -> int:
    spark, folder = changes.sparkSession, uuid.uuid4().hex
    place = f"{path}/changes/{folder}"
    changes.write.parquet(place)
    kinds = {r.change: r["count"] for r in spark.read.parquet(place).groupBy("change").count().collect()}
    version = newest(spark, path)
    if not kinds and version:
        return version
    _record(spark, path, version + 1, folder, operation, batch, kinds.get("insert", 0), kinds.get("update_post", 0), kinds.get("delete", 0))
    return version + 1


def create(rows: DataFrame, path: str, key: str) -> int:
    """Version 1: every row is an insert. Keys must be unique; a null or repeated key is an error."""
    if log(rows.sparkSession, path):
        raise ValueError(f"there is a table at {path}")
    _unique(rows, key)
    return _write(rows.withColumn("change", F.lit("insert")), path, "create", None)


def _unique(rows: DataFrame, key: str) -> None:
    wrong = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col(key).isNull() | (F.col("n") > 1)).first()
    if wrong is not None:
        raise ValueError(f"key {wrong[0]} stands in {wrong[1]} rows")


def commit(spark: SparkSession, path: str, key: str, upserts: DataFrame | None = None, deletes: DataFrame | None = None, batch: str | None = None) -> int:
    """Write the next version and return its number; without a change it is the present one.

    ``upserts`` has the columns of the table, ``deletes`` the key; a key may stand in one of them once. Deleting a
    key that is not there changes nothing. Only the present rows of the named keys are fetched; the keys are written out
    first, so that Spark knows how few they are.
    """
    rows = log(spark, path)
    if batch is not None and any(r.batch == batch for r in rows):
        return max(r.version for r in rows)
    table = snapshot(spark, path, key)
    columns = [c for c in table.columns if c != key]
    named = [df.select(key, *c) for df, c in ((upserts, [F.lit(True).alias("_up")]), (deletes, [F.lit(False).alias("_up")])) if df is not None]
    keys = named[0] if len(named) == 1 else named[0].unionByName(named[1])
    keys = staged(keys, "named-keys")
    _unique(keys, key)
    present = staged(table.join(keys.select(key), key, "left_semi").select(key, *columns, row_hash(columns).alias("_had")), "present")
    changes = present.join(keys.where("NOT _up").select(key), key, "left_semi").select(key, *columns, F.lit("delete").alias("change"))
    if upserts is not None:
        wanted = upserts.select(key, *columns).withColumn("_want", row_hash(columns))
        differ = wanted.select(key, "_want").join(present.select(key, "_had"), key, "left").where("_had IS NULL OR _had <> _want")
        differ = staged(differ.select(key, F.col("_had").isNull().alias("_new")), "differing")
        after = wanted.drop("_want").join(differ, key).withColumn("change", F.when(F.col("_new"), "insert").otherwise("update_post")).drop("_new")
        before = present.drop("_had").join(differ.where("NOT _new").select(key), key, "left_semi").withColumn("change", F.lit("update_pre"))
        changes = changes.unionByName(before).unionByName(after)
    return _write(changes, path, "commit", batch)


def _changes(spark: SparkSession, path: str, commits: list) -> DataFrame:
    """The change rows of some commits with their version, from the files of these commits only."""
    folders = [f"{path}/changes/{r.folder}" for r in commits]
    number = F.create_map(*[F.lit(x) for r in commits for x in (r.folder, r.version)])
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return spark.read.parquet(*folders).select("*", number[folder].alias("version"))


def feed(spark: SparkSession, path: str, start: int = 0, end: int | None = None) -> DataFrame:
    """Row changes of the versions after ``start`` up to ``end``: columns, change, version.

    ``change`` is insert, delete, update_pre or update_post.
    """
    commits = [r for r in log(spark, path) if r.operation != "fold"]
    some = [r for r in commits if start < r.version and (end is None or r.version <= end)]
    if not commits:
        raise ValueError(f"there is no table at {path}")
    return _changes(spark, path, some) if some else _changes(spark, path, commits[:1]).limit(0)


def net_feed(spark: SparkSession, path: str, key: str, start: int = 0, end: int | None = None) -> DataFrame:
    """The same as one step: for each key the row before the range and the row after it, without what came between.

    A key that ends as it began is left out.
    """
    every = feed(spark, path, start, end)
    columns = [c for c in every.columns if c not in ("change", "version")]
    own = [c for c in columns if c != key]
    slim = every.select(key, "change", "version", row_hash(own).alias("_hash"))
    place = F.struct("version", "change", "_hash")
    before, after = F.col("change").isin("update_pre", "delete"), F.col("change").isin("update_post", "insert")
    per_key = slim.groupBy(key).agg(F.min(place).alias("first"), F.max(place).alias("last"), F.min(F.when(before, place)).alias("pre"), F.max(F.when(after, place)).alias("post"))
    # "update_post" sorts before "update_pre", so the first and last change of a version are told by kind, not by order.
    had = F.col("pre").isNotNull() & (F.col("pre.version") == F.col("first.version")) & (F.col("first.change") != "insert")
    has = F.col("post").isNotNull() & (F.col("post.version") == F.col("last.version")) & (F.col("last.change") != "delete")
    ends = per_key.withColumns({"_had": had, "_has": has}).where("_had OR _has").where(~(F.col("_had") & F.col("_has") & (F.col("pre._hash") == F.col("post._hash"))))
    ends = staged(ends.select(key, "_had", "_has", "pre", "post"), "ends")

    def rows(side: str, own_side: str, other: str, alone: str, both: str) -> DataFrame:
        wanted = ends.where(own_side).select(key, F.col(f"{side}.version").alias("version"), F.col(f"{side}.change").alias("change"), F.when(F.col(other), both).otherwise(alone).alias("_kind"))
        return every.join(wanted, [key, "version", "change"]).select(*columns, F.col("_kind").alias("change"))

    return rows("pre", "_had", "_has", "delete", "update_pre").unionByName(rows("post", "_has", "_had", "insert", "update_post"))


def snapshot(spark: SparkSession, path: str, key: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the newest by default."""
    rows = log(spark, path)
    upto = max((r.version for r in rows), default=0) if version is None else version
    if not any(r.version == upto for r in rows):
        raise ValueError(f"{path} has no version {upto}")
    folded = [r for r in rows if r.operation == "fold" and r.version <= upto]
    since = max((r.version for r in folded), default=1)
    later = [r for r in rows if r.operation != "fold" and since < r.version <= upto]
    # Version 1 consists of inserts, so it is a base as it stands.
    place = f"{path}/base/{folded[-1].folder}" if folded else f"{path}/changes/{next(r.folder for r in rows if r.version == 1)}"
    base = spark.read.parquet(place).drop("change")
    if not later:
        return base
    changes = _changes(spark, path, later)
    # What a key is after its last change: nothing, or the row that the change brought.
    last = changes.where("change <> 'update_pre'").groupBy(key).agg(F.max("version").alias("version"))
    last = staged(last, "last-changes")
    brought = changes.where("change IN ('insert', 'update_post')").join(last, [key, "version"], "left_semi")
    return base.join(last.select(key), key, "left_anti").unionByName(brought.select(*base.columns))


def fold(spark: SparkSession, path: str, key: str) -> None:
    """Write the newest version as a base, so that snapshots need not go through all changes. The feed stays as it is."""
    version, folder = newest(spark, path), uuid.uuid4().hex
    snapshot(spark, path, key).write.parquet(f"{path}/base/{folder}")
    _record(spark, path, version, folder, "fold", None, 0, 0, 0)
