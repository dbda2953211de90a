"""Running totals and positions within groups that may be very large.

A plain window keeps a whole group in one task. Here a group is cut into blocks of the
order column: totals per (group, block) give the offset of each block, and the window
then runs inside one block only. The order column must be unique within its group.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 1_000_000


def block_splits(df: DataFrame, order: str, block_rows: int = BLOCK_ROWS) -> list[float]:
    """Values of ``order`` that cut the rows into blocks of about ``block_rows``."""
    blocks = -(-df.select(order).count() // block_rows)
    if blocks < 2:
        return []
    steps = [i / blocks for i in range(1, blocks)]
    cuts = df.select(F.percentile_approx(F.col(order).cast("double"), steps, 100 * blocks)).first()[0]
    return sorted(set(cuts))


def with_block(df: DataFrame, order: str, splits: list[float], out: str = "_block") -> DataFrame:
    if not splits:
        return df.withColumn(out, F.lit(0.0))
    edges = [float("-inf"), *splits, float("inf")]
    ready = df.withColumn("_order", F.col(order).cast("double"))
    return Bucketizer(splits=edges, inputCol="_order", outputCol=out).transform(ready).drop("_order")


def running_totals(
    df: DataFrame,
    group: list[str],
    order: str,
    totals: dict[str, Column],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add, per group in the given order, the sum of each value up to and including the row."""
    splits = block_splits(df, order, block_rows)
    rows = df.select("*", *[v.cast("bigint").alias(f"_v_{n}") for n, v in totals.items()])
    blocked = with_block(rows, order, splits)
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy(*group, "_block")
        .agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in totals])
        .select(
            *group,
            "_block",
            *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in totals],
        )
    )
    inside = Window.partitionBy(*group, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = blocked.join(offsets, [*group, "_block"]).select(
        "*", *[(F.sum(f"_v_{n}").over(inside) + F.col(f"_o_{n}")).alias(n) for n in totals]
    )
    return summed.drop("_block", *[f"{p}{n}" for n in totals for p in ("_v_", "_o_")])


def positions(
    df: DataFrame, group: list[str], order: str, out: str = "position", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add the position 1, 2, 3 ... of each row within its group."""
    return running_totals(df, group, order, {out: F.lit(1)}, block_rows)


def request_groups(
    df: DataFrame, group: list[str], order: str, size: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add ``batch_no``: rows of a group in order, ``size`` to a request, the last one possibly shorter."""
    placed = positions(df, group, order, "_position", block_rows)
    return placed.withColumn("batch_no", F.floor((F.col("_position") - 1) / size)).drop("_position")
