"""Hard negatives against all scores, and the early end of the threshold algorithm."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import hard_negatives as hn
from gleaner.session import ship_package


def brute(rows, every):
    ready = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ready.append((i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    anchors = {}
    for i, label, x in sorted(ready):
        if i % every == 0:
            anchors.setdefault(i, (label, x))
    out = []
    for a, (label, x) in anchors.items():
        scored = [(-sum(map(int.__mul__, x, y)), i, other) for i, other, y in ready if i != a and len(y) == len(x)]
        positives = sorted((s, i) for s, i, other in scored if other == label)[:5]
        for s, p in set(positives):
            low = sorted((t, i) for t, i, other in scored if other != label and 30 * -s <= 100 * -t <= 90 * -s)[:10]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(low)]
    return sorted(out)


def mined(df, every, **limits):
    rows = hn.mine(df, "vec_id", "embedding", "label", F.col("id") % every == 0, **limits)
    return sorted(tuple(r) for r in rows.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def frame(spark, rows):
    ship_package(spark)
    data = [(i, v, label, "clash", -1, "w") for i, v, label in rows]
    return spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int, x string, id int, width string")


@pytest.mark.parametrize("block_bytes", [8 << 20, 3000])
def test_by_brute_force(spark, block_bytes):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist(), int(rng.integers(3))) for i in range(160)]
    for i in range(30, 90):  # a vector with a third of all rows: many ties
        rows[i] = (i, rows[30][1], i % 3)
    rows[40] = (40, [0.0] * 6, 1)
    rows += [(200, rows[30][1], 0), (200, rows[30][1], 0), (205, rows[30][1], 1), (205, rows[30][1], 1), (210, rows[2][1], 2), (210, rows[2][1], 0)]
    rows += [(None, rows[0][1], 1), (220, None, 1), (230, rows[0][1], None), (240, [1.0, None], 1), (250, [float("nan")] * 6, 0), (260, [float("inf")] * 6, 0)]
    rows += [(300, [], 1), (301, [], 1), (302, [], 0), (310, [1.0, 2.0], 1), (311, [1.0, 2.0], 1), (312, [0.5, 1.0], 0)]
    rows += [(-10, rows[1][1], 2), (320, [-1.0] * 6, 7), (321, [1.0] * 6, 7)]
    assert mined(frame(spark, rows), 10, block_bytes=block_bytes) == brute(rows, 10)


def test_empty_tables_and_large_components(spark):
    assert mined(frame(spark, []), 1) == []
    assert mined(frame(spark, [(1, [1.0], 0)]), 1) == []
    wide = [(0, [4e6, 4e6], 0), (1, [4e6, 4e6], 0), (2, [2e6, 2e6], 1)]
    assert mined(frame(spark, wide), 10) == brute(wide, 10) != []
    with pytest.raises(Exception, match="32 bits"):
        mined(frame(spark, [(0, [1e30], 0), (1, [1.0], 0)]), 1)


def test_lists_are_left_early_and_nothing_is_lost():
    """Rows with a few strong dimensions each: an anchor reads a small part of them, and its best rows are right."""
    rng = np.random.default_rng(6)
    n, width = 4000, 4
    x = np.floor(rng.pareto(1.0, size=(n, width)) * 100).astype(np.int64).clip(0, 1 << 20)
    ids, labels = rng.permutation(n).astype(np.int64), rng.integers(0, 2, n)
    lists, scored = hn.Lists(ids, labels, x), []
    plain = hn._products
    hn._products = lambda a, r: scored.append(len(r)) or plain(a, r)
    try:
        score, row = lists.search(np.array([-1]), np.array([1]), np.array([[3, 1, 2, 1]]), np.full((1, 1), hn.NONE + 1), np.full((1, 1), hn.MOST), True, 5)
    finally:
        hn._products = plain
    own = labels == 1
    want = sorted(zip((-(x[own] @ np.array([3, 1, 2, 1]))).tolist(), ids[own].tolist()))[:5]
    assert list(zip((-score[0, 0]).tolist(), row[0, 0].tolist())) == want
    assert max(scored) < n / 4 and sum(scored) < n / 2
