"""Keys and changes: one row per key, differences of two snapshots, upserts, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.session import staged


def latest_per_key(df: DataFrame, key: str, *version: str | Column) -> DataFrame:
    """Keep for each key the row with the highest version.

    Key, version and a hash of the row are reduced first, by an aggregate: copies of a frequent key are combined before
    the shuffle and no wide column takes part. The winners are then fetched. Rows that are equal in all columns
    are one row.
    """
    columns = df.columns
    order = F.struct(*[F.col(v).alias(f"v{i}") if isinstance(v, str) else v.alias(f"v{i}") for i, v in enumerate(version)], row_hash(columns).alias("h"))
    marked = df.withColumn("_order", order)
    newest = marked.groupBy(F.col(key).alias("_key")).agg(F.max("_order").alias("_best"), F.count("*").alias("_n"))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_order").eqNullSafe(F.col("_best"))
    won = marked.join(newest, same).select(*columns)
    return won.dropDuplicates([key])


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def row_hash(columns: list[str]) -> Column:
    """md5 over the named columns; a null differs from an empty string."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat_ws("\x1f", *parts))


def changes_between(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Row-level changes that lead from one snapshot to the next: (key, change, columns).

    ``change`` is insert, delete, update_pre or update_post. Keys must be unique on both
    sides. The snapshots are compared by key and row hash only; the rows themselves are
    fetched for the changed keys, which are written out first so that Spark knows how few
    they are.
    """

    def hashed(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, row_hash(columns).alias(name))

    both = hashed(old, "_old").join(hashed(new, "_new"), key, "full_outer")
    kind = (
        F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete").otherwise("update")
    )
    changed = staged(both.where(~F.col("_old").eqNullSafe(F.col("_new"))).select(key, kind.alias("change")), "changed")

    def rows(df: DataFrame, alone: str, updated: str) -> DataFrame:
        kinds = changed.where(F.col("change").isin(alone, "update"))
        named = F.when(F.col("change") == "update", updated).otherwise(F.col("change"))
        return df.select(key, *columns).join(kinds, key).select(key, named.alias("change"), *columns)

    return rows(old, "delete", "update_pre").unionByName(rows(new, "insert", "update_post"))


def upsert(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The table after replacing or adding ``rows``; the keys of ``rows`` must be unique."""
    return table.join(rows.select(key), key, "left_anti").unionByName(rows)


def delete_keys(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return table.join(keys.select(key), key, "left_anti")


def completeness(source: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """One row of counts: indexed, pending (not yet in the index), orphan (no longer in the source), complete.

    Taken from the keys themselves, so it never reports a guess.
    """
    have = source.groupBy(key).agg(F.lit(1).alias("_s")).join(
        index.groupBy(key).agg(F.lit(1).alias("_i")), key, "full_outer"
    )
    counts = have.agg(
        F.count_if(F.col("_s").isNotNull() & F.col("_i").isNotNull()).alias("indexed"),
        F.count_if(F.col("_i").isNull()).alias("pending"),
        F.count_if(F.col("_s").isNull()).alias("orphan"),
    )
    return counts.withColumn("complete", (F.col("pending") == 0) & (F.col("orphan") == 0))
