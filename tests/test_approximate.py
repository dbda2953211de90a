"""Coarse buckets in two levels, hash tables, and the recall that chooses their settings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.operators import hash_tables, index, quantiser, search
from gleaner.plans.catalog import REGISTERED
from gleaner.session import stage_path, staged


def keyed(spark, folder):
    return spark.read.parquet(f"{folder}/embeddings.parquet").select(F.col("vec_id").alias("key"), "embedding")


def pairs(df):
    return {(r.query_id, r.key) for r in df.collect()}


def test_recall_is_held_at_two_sizes(spark):
    for folder in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        rows = REGISTERED["F5_recall_by_query"](spark, folder).collect()
        for way in ("buckets", "tables"):
            own = [r for r in rows if r.way == way]
            assert len(own) >= 5 and all(r.n_true == 5 for r in own)
            assert sum(r.n_found for r in own) >= 0.9 * sum(r.n_true for r in own), (folder, way)
        assert all(r.buckets_held and r.tables_held for r in REGISTERED["F5_recall_held"](spark, folder).collect())


def test_recall_is_told_for_every_query(spark, tmp_path):
    vectors = np.random.default_rng(4).normal(size=(130, 64))
    rows = [(7 * i + 1, v.tolist(), 0) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    told = REGISTERED["F5_recall_by_query"](spark, str(tmp_path)).collect()
    assert sorted((r.query_id, r.way) for r in told) == sorted((i, way) for i, _, _ in rows for way in ("buckets", "tables"))
    assert all(r.n_true == 5 for r in told)


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 1000, "block_bytes": 30_000}])
def test_all_hash_buckets_give_the_exact_result(spark, small, limits):
    rows = keyed(spark, small)
    rows = staged(hash_tables.hashed(rows, "embedding", hash_tables.fit(rows, "embedding", 64, tables=3)), "t")
    asked = rows.withColumnRenamed("key", "query_id")
    exact = search.nearest(rows, asked, 5, 64)
    wide = hash_tables.nearest(rows, asked, 5, 64, hash_tables.Choice(3, 40, 1.0, 1.0), **limits)
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, exact.collect()))
    few = hash_tables.nearest(rows, asked, 5, 64, hash_tables.Choice(2, 1, 0.0, 0.0), **limits)
    found = {}
    vectors = np.array([r.embedding for r in rows.orderBy("key").collect()], float)
    hashes = np.array([r.hashes for r in rows.orderBy("key").collect()])
    for q in range(0, len(vectors), 50):
        near = (np.abs(hashes[:, :2] - hashes[q, :2]) <= 1).any(axis=1)
        score = np.round(vectors @ vectors[q] / np.linalg.norm(vectors, axis=1) / np.linalg.norm(vectors[q]), 6)
        found[q] = sorted(np.flatnonzero(near), key=lambda i: (-score[i], i))[:5]
    got = {q: [r.key for r in few.where(F.col("query_id") == q).orderBy("rank").collect()] for q in list(found)[:3]}
    assert got == {q: found[q] for q in got}


def test_the_choice_is_the_cheapest_that_holds_and_near_copies_are_cheap(spark):
    """Groups of near copies: a few buckets are enough, and the measured recall is the real one."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 16))
    data = [(i, (centres[i % 60] + 0.01 * rng.normal(size=16)).tolist()) for i in range(600)]
    data = [(i, (np.array(v) / np.linalg.norm(v)).tolist()) for i, v in data]
    rows = spark.createDataFrame(data, "key bigint, embedding array<double>")
    rows = staged(hash_tables.hashed(rows, "embedding", hash_tables.fit(rows, "embedding", 16)), "t")
    asked = rows.withColumnRenamed("key", "query_id")
    choice = hash_tables.choose(rows, asked, 5, 16, 0.9, itself=False)
    assert choice.recall >= 0.9 and choice.share < 0.4
    exact = pairs(search.ranked(search.nearest(rows, asked, 6, 16).where("key <> query_id").drop("rank"), 5))
    got = pairs(hash_tables.nearest(rows, asked, 6, 16, choice))
    assert len(exact & got) / len(exact) >= 0.9
    made = index.create_from_vectors(rows.drop("hashes"), stage_path(spark, "ix"), "key", 16, [])
    probing = index.choose_probes(spark, made, asked, 5, 0.9, itself=False)
    assert probing.probes <= made.buckets / 3 and probing.recall >= 0.9
    assert len(exact & pairs(index.search_index(spark, made, asked, 6, "given", probes=probing.probes))) / len(exact) >= 0.9


def test_centres_cost_a_bounded_sample(spark):
    """Many copies of few vectors count once; more rows than the sample leave the number of sampled vectors bounded."""
    rows = spark.range(4000).select((F.col("id") % 7).cast("double").alias("a"), F.lit(1.0).alias("b")).select(F.array("a", "b").alias("v"))
    assert quantiser.train(rows, "v", 4000, 2, buckets=50).count() == 7
    assert quantiser.train(rows, "v", 4000, 2).count() == 1
    spread = staged(spark.range(4000).select(F.array(F.rand(3), F.rand(4)).alias("v")), "t")
    assert 350 < quantiser._sample(spread, 4000, 500).count() < 650
    centres = quantiser.train(spread, "v", 4000, 2, sample=500)
    assert 20 <= centres.count() <= 64


@pytest.mark.parametrize("buckets", [1, 2, 30])
def test_descent_on_the_cluster_equals_descent_with_all_centres(spark, small, buckets):
    rows = keyed(spark, small).withColumn("label", F.lit("x"))
    n = rows.count()
    centres = staged(quantiser.train(rows, "embedding", n, 64, buckets=buckets), "centres")
    assert centres.count() <= buckets + 6
    near = {r.key: r.bucket for r in quantiser.place(rows, "embedding", centres, 64).collect()}
    far = quantiser.place(rows, "embedding", centres, 64, broadcast_bytes=0)
    assert {r.key: r.bucket for r in far.collect()} == near and len(near) == n
    assert far.columns == [*rows.columns, "bucket"]
    held = centres.collect()
    for r in rows.limit(40).collect():
        top = min({(float(np.linalg.norm(np.array(r.embedding) - c.top_centre)), c.top) for c in held})[1]
        best = min((float(np.linalg.norm(np.array(r.embedding) - c.centre)), c.bucket) for c in held if c.top == top)[1]
        assert near[r.key] == best
