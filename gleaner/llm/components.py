"""Connected components of an edge table, by alternating large-star and small-star rounds.

Each round replaces edges by edges to a smaller node of the same component; the number of edges never
grows, and the rounds end when every node points at the smallest node of its component. A round is one
aggregate with map-side combining and one equi-join per node, so a hub with very many edges is a skewed
join key, which adaptive execution splits; no component is ever gathered in one task. Between rounds the
edges are a table in the shared folder, so a lost executor costs tasks of one round only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gleaner.llm.common import stage


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table, and a mark of them that is taken while they are written."""
    seen = Observation()
    marked = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("mark"))
    table = stage(marked, "edges")
    return table, (seen.get["n"], seen.get["mark"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node it knows."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
    linked = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return linked.filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = least.select("u", F.col("least").alias("v"))
    return linked.unionByName(own).filter("u != v").distinct()


def components(edges: DataFrame, u: str, v: str, most_rounds: int = 100) -> DataFrame:
    """``node, component`` for every node that has an edge to another node; component is its smallest node.

    Nulls and self-links are ignored, repeated and reversed edges count once, no edges give no rows.
    """
    pairs = edges.select(F.col(u).alias("a"), F.col(v).alias("b")).filter("a is not null and b is not null and a != b")
    now, seen = _written(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(most_rounds):
        if not seen[0]:
            break
        now, mark = _written(_small_star(_large_star(now)))
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    children = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return children.unionByName(roots)
