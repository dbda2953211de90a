"""Reply trees to conversations.

Messages point at the message they answer. Root-to-leaf paths are found by self-joins that double the distance in each
round (a path of n turns takes log2 n rounds), branches are ranked by their mean score, and each chosen path is written
as one conversation with a loss mask.

The template writes a turn as ``<turn role="ROLE">``, a line end, the text, ``</turn>`` and a line end. A backslash, ``<``
and, in roles, ``"`` are escaped by a backslash, so no text can open or close a turn and every text can be read back.

Defined results: null texts and roles are empty. A message whose parent is null or absent is a root. Messages in a circle
hang on no root and are in no path. Of messages with the same conversation and id the smallest row counts. Ties of score go
to the smaller leaf id. Empty tables give no conversations. Extra columns are ignored. A conversation is one output row, so one
path has to fit a task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import stage
from gleaner.session import stage_path

OPEN, MIDDLE, CLOSE = '<turn role="', '">\n', "</turn>\n"
TRAINED_ROLE = "assistant"

_TURN = re.compile(r'<turn role="((?:[^"\\]|\\.)*)">\n([^<\\]*(?:\\.[^<\\]*)*)</turn>\n', re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)


def escape(text: Column, quotes: bool = False) -> Column:
    marked = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\<"))
    return F.replace(marked, F.lit('"'), F.lit('\\"')) if quotes else marked


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


def turns_as_tree(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Linear conversations as trees: each turn answers the one before it. Equal turn numbers stand by role and text."""
    narrow = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("_turn"), "role", "text")
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("_turn", "role", F.xxhash64("text")))
    numbered = narrow.withColumn("node", place.cast("bigint"))
    return numbered.select("conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


JUMPS = "conv_id bigint, node bigint, up bigint, depth bigint, total double"


def _climb(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Depth and summed score of every node that hangs on a root, and the tables of jumps over 1, 2, 4 ... parents.

    A round joins only nodes that are still below a root, so a few long threads cost no work for the many short ones.
    """
    spark = nodes.sparkSession
    parents = nodes.select("conv_id", F.col("node").alias("parent"), F.lit(True).alias("_there"))
    known = nodes.select("conv_id", "node", "parent", "score").join(parents, ["conv_id", "parent"], "left")
    # ``up`` is the ancestor at the present distance, null beyond the root; depth and total cover the nodes below it.
    first = known.select("conv_id", "node", F.when(F.col("_there"), F.col("parent")).alias("up"), F.lit(1).cast("bigint").alias("depth"), F.col("score").alias("total"))
    paths, jumps, open_before = [], [], None
    following = first
    while True:
        paths.append(stage_path(spark, "chat-jump"))
        following.write.parquet(paths[-1])
        now = spark.read.schema(JUMPS).parquet(paths[-1])
        done = spark.read.schema(JUMPS).parquet(*paths).filter("up is null")
        still_open = now.filter("up is not null")
        n = still_open.count()
        if not n or n == open_before:
            return done.select("conv_id", "node", "depth", "total"), jumps
        open_before = n
        jumps.append(still_open.select("conv_id", "node", "up"))
        above = done.unionByName(still_open).select("conv_id", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), F.col("total").alias("_total"))
        following = still_open.join(above, ["conv_id", "up"]).select(
            "conv_id", "node", F.col("_up").alias("up"), (F.col("depth") + F.col("_depth")).alias("depth"), (F.col("total") + F.col("_total")).alias("total")
        )


def choose_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``conv_id, leaf, branch, n_turns, score, depth, role, text``: the turns of the best ``branches`` paths of each conversation.

    ``messages`` has conv_id, node, parent, score, role, text. Branch 1 is the best.
    """
    one = F.min(F.struct("parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    nodes = stage(
        messages.withColumn("conv_id", F.coalesce(F.col("conv_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint")))
        .filter("node is not null").groupBy("conv_id", "node").agg(one.alias("_m")).select("conv_id", "node", "_m.*"),
        "chat-nodes",
    )
    reached, jumps = _climb(nodes)
    reached = stage(reached, "chat-depth")
    answered = nodes.select("conv_id", F.col("parent").alias("node")).filter("node is not null").distinct()
    leaves = reached.join(answered, ["conv_id", "node"], "left_anti").withColumn("mean", F.col("total") / F.col("depth"))
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("mean"), "node"))
    chosen = leaves.withColumn("branch", rank).filter(F.col("branch") <= branches)
    path = stage(chosen.select("conv_id", F.col("node").alias("leaf"), "branch", F.col("depth").alias("n_turns"), F.col("mean").alias("score"), "node"), "chat-paths")
    for jump in reversed(jumps):
        # Every distance to the leaf is a sum of different powers of two, so no node is met twice.
        further = path.join(jump, ["conv_id", "node"]).select("conv_id", "leaf", "branch", "n_turns", "score", F.col("up").alias("node"))
        path = stage(path.unionByName(further), "chat-paths")
    placed = path.join(reached.select("conv_id", "node", "depth"), ["conv_id", "node"])
    return placed.join(nodes.select("conv_id", "node", "role", "text"), ["conv_id", "node"]).drop("node")


def format_paths(turns: DataFrame, trained: str = TRAINED_ROLE) -> DataFrame:
    """``conv_id, leaf, branch, score, formatted, loss``; ``loss`` holds [a, b) spans of code points of the formatted text."""
    head = F.concat(F.lit(OPEN), escape(F.col("role"), quotes=True), F.lit(MIDDLE))
    pieces = turns.select("conv_id", "leaf", "branch", "score", "depth", (F.col("role") == trained).alias("_loss"), head.alias("_head"), escape(F.col("text")).alias("_body"))
    size = F.length("_head") + F.length("_body") + len(CLOSE)
    before = Window.partitionBy("conv_id", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("_head")
    spanned = pieces.withColumn("_a", start.cast("bigint")).withColumn("_b", F.col("_a") + F.length("_body"))
    turn = F.struct("depth", F.concat("_head", "_body", F.lit(CLOSE)).alias("piece"), "_loss", F.col("_a").alias("a"), F.col("_b").alias("b"))
    grouped = spanned.groupBy("conv_id", "leaf", "branch", "score").agg(F.sort_array(F.collect_list(turn)).alias("_t"))
    return grouped.select(
        "conv_id", "leaf", "branch", "score",
        F.array_join(F.transform("_t", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter("_t", lambda t: t["_loss"]), lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"))).alias("loss"),
    )


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}: {formatted[at:at + 40]!r}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def read_back(conversations: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` from the formatted texts alone."""
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, formatted, loss in zip(*(c.to_pylist() for c in batch.columns)):
                turns = parse(formatted)
                trained = "".join(unescape(formatted[x["a"] : x["b"]]) for x in loss)
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                rows.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(trained), hashlib.sha256(trained.encode()).hexdigest(), len(formatted)))
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [x.split()[0] for x in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)], names=names)

    return conversations.select("conv_id", "formatted", "loss").mapInArrow(digest, schema)
