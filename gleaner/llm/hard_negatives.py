"""Hard-negative mining by Fagin's threshold algorithm.

Vectors become integers (floor of ``scale`` times each component), so that scores, the inner products, are exact. Rows are dealt
into blocks; a block has one candidate list per dimension, sorted by its value. For an anchor the lists are read in step, from
the top where the anchor's component is positive and from the bottom where it is negative; every row that comes up is scored
in full (random access). The threshold is the score of a row that would have the last value read in every list: no unread row
can exceed it. A window of scores is closed once the threshold is strictly below its kth score (strictly, since ties go to the
smaller id) or below its lower end; an anchor stops when all its windows are closed, and a block stops with its last
anchor. The best k of the blocks are merged by a rank per window, so a block passes on at most k rows of each.

Two passes: the first finds the positives of each anchor (best rows of its label, one window without ends), the second its
negatives (best rows of other labels with a score between ``low`` and ``high`` percent of a positive's). Anchors and rows
meet block by block on the cluster (``blocks.paired``); neither side passes the driver.

Defined results: rows with a null id, label or vector, or with a null or non-finite component take no part. Rows of different
widths never meet; the score of empty vectors is 0. Repeated rows count one by one, but a row with the anchor's id is neither
its positive nor its negative, and a positive that stands in several rows is listed once; of several anchor rows with one id,
that with the smallest label, then vector, asks. Ties go to the smaller id. A negative positive score leaves an empty window.
A component outside 32 bits after scaling, and a score outside 64 bits, is an error. Empty tables give no rows. Extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import stage
from gleaner.operators import blocks

SCALE = 256
N_POSITIVES, N_NEGATIVES = 5, 10
LOW_PERCENT, HIGH_PERCENT = 30, 90

#: Rows that a list gives up in the first step; each step reads twice as many as the one before.
FIRST_STEP = 8
#: Scores that are held at once.
SCORES = 2 << 20

NONE = np.iinfo(np.int64).min
MOST = np.iinfo(np.int64).max


def integer_rows(df: DataFrame, key: str, vector: str, label: Column | str, scale: int = SCALE) -> DataFrame:
    """``id, label, x, width`` of the rows that take part; x is an array of int."""
    named = df.select(F.col(key).cast("bigint").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("int").alias("label"), F.col(vector).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    named = named.filter("id is not null and label is not null and v is not null").filter(~bad)

    def scaled(x: Column) -> Column:
        y = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double") * scale) < float(1 << 31), y.cast("int")).otherwise(F.raise_error(F.lit("component does not fit 32 bits")).cast("int"))

    return named.select("id", "label", F.transform("v", scaled).alias("x"), F.size("v").alias("width"))


def _products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Anchors x rows, exact."""
    a, r, width = int(np.abs(anchors).max(initial=0)), int(np.abs(rows).max(initial=0)), anchors.shape[1]
    bound = a * r * max(width, 1)
    if bound < 1 << 53:  # every partial sum is an integer that a double holds
        return (anchors.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    if bound < 1 << 62:
        return anchors @ rows.T
    exact = anchors.astype(object) @ rows.T.astype(object)
    if exact.size and max(abs(int(exact.max())), abs(int(exact.min()))) >= 1 << 62:
        raise OverflowError("a score does not fit 64 bits")
    return exact.astype(np.int64)


def _best_of(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best k of each line, and their columns; the smaller column on ties."""
    n = scores.shape[1]
    k = min(k, n)
    if int(np.abs(np.where(scores == NONE, 0, scores)).max(initial=0)) < (1 << 62) // max(n, 1):
        # Score and column in one number: no ties are left, and the best need no full sort.
        both = np.where(scores == NONE, NONE, scores * n + np.arange(n - 1, -1, -1))
        top = np.sort(np.partition(both, n - k, axis=1)[:, n - k :], axis=1)[:, ::-1] if k else both[:, :0]
        found = top != NONE
        return np.where(found, np.floor_divide(top, n), NONE), np.where(found, n - 1 - np.mod(top, n), 0)
    column = n - 1 - np.argsort(scores[:, ::-1], axis=1, kind="stable")[:, ::-1][:, :k]
    return np.take_along_axis(scores, column, axis=1), column


class Lists:
    """The sorted candidate lists of a block of rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        by_id = np.argsort(ids, kind="stable")  # so that the smaller place is the smaller id
        self.ids, self.labels, self.x = ids[by_id], labels[by_id], x[by_id]
        self.order = np.argsort(self.x, axis=0, kind="stable")
        self.value = np.take_along_axis(self.x, self.order, axis=0)

    def search(self, ids: np.ndarray, labels: np.ndarray, a: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(anchors, windows, k) scores and ids: the best rows of the same label, or of the others, with a score in each window."""
        n, (m, windows) = len(self.ids), low.shape
        best, place = np.full((m, windows, k), NONE), np.zeros((m, windows, k), np.int64)
        live = np.flatnonzero((low <= high).any(axis=1))
        seen = np.zeros(n, bool)
        at, step = 0, FIRST_STEP
        while len(live) and at < n:
            to = min(n, at + step)
            read = seen.copy()
            read[self.order[n - to : n - at, (a[live] > 0).any(axis=0)].ravel()] = True
            read[self.order[at:to, (a[live] < 0).any(axis=0)].ravel()] = True
            if to == n:
                read[:] = True  # a list that no anchor has a sign for holds rows of score 0, too
            new = np.flatnonzero(read & ~seen)
            seen = read
            scores = _products(a[live], self.x[new])
            wanted = (self.labels[new] == labels[live, None]) == same
            wanted &= self.ids[new] != ids[live, None]
            for w in range(windows):
                fits = wanted & (scores >= np.maximum(low[live, w], best[live, w, -1])[:, None]) & (scores <= high[live, w, None])
                lines = np.flatnonzero(fits.any(axis=1))
                if len(lines):
                    self._merge(best, place, live[lines], w, np.where(fits[lines], scores[lines], NONE), new, k)
            threshold = _threshold(a[live], self.value[n - to], self.value[to - 1])
            closed = (low[live] > high[live]) | (threshold[:, None] < best[live, :, -1]) | (threshold[:, None] < low[live])
            live = live[~closed.all(axis=1)]
            at, step = to, 2 * step
        return best, self.ids[place] if n else place

    @staticmethod
    def _merge(best: np.ndarray, place: np.ndarray, lines: np.ndarray, w: int, scores: np.ndarray, new: np.ndarray, k: int) -> None:
        top, column = _best_of(scores, k)
        all_scores = np.hstack([best[lines, w], top])
        all_places = np.hstack([place[lines, w], new[column]])
        order = np.lexsort((all_places, -all_scores), axis=1)
        # NONE is its own negative, so it would sort first.
        order = np.take_along_axis(order, np.argsort(np.take_along_axis(all_scores, order, axis=1) == NONE, axis=1, kind="stable"), axis=1)[:, :k]
        best[lines, w] = np.take_along_axis(all_scores, order, axis=1)
        place[lines, w] = np.take_along_axis(all_places, order, axis=1)


def _threshold(a: np.ndarray, top: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    return _products(np.maximum(a, 0), top[None])[:, 0] + _products(np.minimum(a, 0), bottom[None])[:, 0]


def _vectors(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), width)


_FOUND = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("found_id", pa.int64()), ("score", pa.int64())])


def _search_blocks(rows: DataFrame, anchors: DataFrame, same: bool, k: int, block_bytes: int) -> DataFrame:
    """The best rows of every block for each window of each anchor.

    ``anchors`` has ``windows``, an array of (positive_id, positive_score, low, high).
    """

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        mine, theirs = left["width"].to_numpy(), right["width"].to_numpy()
        for width in np.intersect1d(mine, theirs).tolist():
            block, asking = left.filter(pa.array(mine == width)), right.filter(pa.array(theirs == width))
            lists = Lists(block["id"].to_numpy(), block["label"].to_numpy(), _vectors(block["x"], width))
            step = max(1, SCORES // block.num_rows)
            for start in range(0, asking.num_rows, step):
                part = asking.slice(start, step)
                windows = part["windows"].to_pylist()
                most = max(map(len, windows))
                low, high = np.full((len(windows), most), 1), np.zeros((len(windows), most), np.int64)
                for i, own in enumerate(windows):
                    low[i, : len(own)], high[i, : len(own)] = [x["low"] for x in own], [x["high"] for x in own]
                ids = part["id"].to_numpy()
                score, row = lists.search(ids, part["label"].to_numpy(), _vectors(part["x"], width), low, high, same, k)
                i, w, j = np.nonzero(score != NONE)
                given = [windows[a][b] for a, b in zip(i.tolist(), w.tolist())]
                found.append(
                    pa.table([ids[i], [x["positive_id"] for x in given], [x["positive_score"] for x in given], row[i, w, j], score[i, w, j]], schema=_FOUND)
                )
        return pa.concat_tables(found) if found else _FOUND.empty_table()

    size = F.size("x").cast("bigint") * 8 + 32
    schema = "anchor_id bigint, positive_id bigint, positive_score bigint, found_id bigint, score bigint"
    return blocks.paired(rows, anchors, "width", size, size + 160, meet, schema, block_bytes)


def mine(
    df: DataFrame,
    key: str,
    vector: str,
    label: Column | str,
    is_anchor: Column,
    scale: int = SCALE,
    positives: int = N_POSITIVES,
    negatives: int = N_NEGATIVES,
    low: int = LOW_PERCENT,
    high: int = HIGH_PERCENT,
    block_bytes: int = blocks.BLOCK_BYTES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on the column ``id``, the key.
    """
    rows = stage(integer_rows(df, key, vector, label, scale), "integer-vectors")
    asking = rows.filter(is_anchor).groupBy("id").agg(F.min(F.struct("label", "x", "width")).alias("r")).select("id", "r.*")
    everything = F.array(F.struct(F.lit(None).cast("bigint").alias("positive_id"), F.lit(None).cast("bigint").alias("positive_score"), F.lit(NONE + 1).alias("low"), F.lit(MOST).alias("high")))
    asking = stage(asking, "anchors")
    near = _search_blocks(rows, asking.withColumn("windows", everything), True, positives, block_bytes)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "found_id")
    chosen = near.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= positives)
    # ceil(low * score / 100) and floor(high * score / 100), in whole numbers
    ends = [(-F.floor(-F.col("score") * F.lit(low).cast("decimal(20,0)") / 100)).cast("bigint"), F.floor(F.col("score") * F.lit(high).cast("decimal(20,0)") / 100).cast("bigint")]
    window = F.struct(F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"), ends[0].alias("low"), ends[1].alias("high"))
    per_anchor = chosen.select(F.col("anchor_id").alias("id"), window.alias("w")).groupBy("id").agg(F.collect_set("w").alias("windows"))
    wanting = stage(asking.join(per_anchor, "id"), "windows")
    far = _search_blocks(rows, wanting, False, negatives, block_bytes)
    order = Window.partitionBy("anchor_id", "positive_id", "positive_score").orderBy(F.desc("score"), "found_id")
    ranked = far.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
