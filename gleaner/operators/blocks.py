"""Every row with every query of its cell, block by block on the cluster.

Neither side passes the driver and no pair of rows is a row of a table. Both sides of a cell are dealt into blocks of about
``block_bytes``; row block i goes to the groups (i, 0), (i, 1), ... and query block j to (0, j), (1, j), ..., so that each pair
of blocks meets in one group of a cogroup. A group holds one block of each side, whatever the size of the tables or of a
cell; small cells share a group. With S row and Q query blocks the shuffle moves the rows Q times and the queries S times:
that is the least for a product of two sides that fit no task, and a block of queries is as large as memory allows.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleaner.session import staged

BLOCK_BYTES = 8 << 20

#: Names of the place of a row in the grid; not to be used by the tables.
PLACE = ["_bin", "_i", "_j"]


def grid(rows: DataFrame, queries: DataFrame, cell: str, row_bytes: Column, query_bytes: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(cell, _s, _q, _bin): the number of row and query blocks of each cell that has both, and the group of small cells."""

    def blocks(df: DataFrame, size: Column, name: str) -> DataFrame:
        return df.groupBy(cell).agg(F.sum(size.cast("bigint")).alias(f"{name}_bytes")).withColumn(
            name, F.greatest(F.lit(1), F.ceil(F.col(f"{name}_bytes") / block_bytes)).cast("int")
        )

    cells = staged(blocks(rows, row_bytes, "_s").join(blocks(queries, query_bytes, "_q"), cell), "grid")
    small = (F.col("_s") == 1) & (F.col("_q") == 1)
    held = cells.where(small).agg(F.sum(F.col("_s_bytes") + F.col("_q_bytes"))).first()[0] or 0
    shared = F.pmod(F.xxhash64(cell), F.lit(-(-held // block_bytes) or 1))
    return cells.select(cell, "_s", "_q", F.when(small, shared).otherwise(F.xxhash64(cell)).alias("_bin"))


def paired(
    rows: DataFrame,
    queries: DataFrame,
    cell: str,
    row_bytes: Column,
    query_bytes: Column,
    meet: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str | StructType,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``meet`` of every pair of blocks. It gets the columns of both sides and may find several cells in them.

    Both tables have to be stored ones: their blocks are dealt by position, which a repeated task has to find again. So a block is
    as large as the next, also if one key, or one row, stands in a third of the table.
    """
    places = grid(rows, queries, cell, row_bytes, query_bytes, block_bytes)

    def dealt(df: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        placed = df.withColumn("_at", F.monotonically_increasing_id()).join(places, cell)
        placed = placed.withColumn(mine, F.pmod(F.xxhash64("_at"), F.col(own)).cast("int"))
        placed = placed.withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return placed.select(*df.columns, F.col("_bin").alias("_bin"), "_i", "_j")  # a column of its own on each side

    left = dealt(rows, "_s", "_q", "_i", "_j").groupBy(*PLACE)
    right = dealt(queries, "_q", "_s", "_j", "_i").groupBy(*PLACE)
    return left.cogroup(right).applyInArrow(lambda a, b: meet(a.drop_columns(PLACE), b.drop_columns(PLACE)), schema)
