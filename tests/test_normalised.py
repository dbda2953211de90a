import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gleaner.functions.vectors import norm, unit
from gleaner.operators import index
from gleaner.session import stage_path


def test_vectors_are_scaled_in_one_pass_and_to_the_same_values(spark):
    rng = np.random.default_rng(1)
    data = [(i, rng.normal(size=64).tolist()) for i in range(50)]
    data += [(900, None), (901, []), (902, [0.0, 0.0]), (903, [1.0, None, 2.0]), (904, [float("nan"), 1.0]), (905, [float("inf"), 1.0])]
    for element in ("float", "double"):
        df = spark.createDataFrame(data, f"k int, v array<{element}>")
        made = index.normalised(df, "v")
        plain = df.withColumn("n", norm(F.col("v"))).select("k", unit(F.col("v"), F.col("n")).alias("w"))
        assert made.join(plain, "k").where(F.col("v").eqNullSafe(F.col("w"))).count() == len(data)
        # A filter above it must not bring the length into the function of every value.
        picked = made.withColumn("h", F.xxhash64("v")).where("h % 2 = 0")
        assert "lambda" not in picked._jdf.queryExecution().toString().split("== Optimized Logical Plan ==")[1]


def test_stored_vectors_are_packed_and_come_back_as_they_were():
    rng = np.random.default_rng(3)
    few = np.zeros((40, 64))
    few[np.arange(40), rng.integers(0, 64, 40)] = rng.normal(size=40)
    floats = rng.normal(size=(5, 64)).astype(np.float32).astype(float).tolist()
    lists = [None, *few.tolist(), *few.astype(np.float32).astype(float).tolist(), None, *floats, *rng.normal(size=(5, 64)).tolist(), [0.0] * 64, [-0.0] * 64]
    lists += [[1.0, None, *[0.0] * 62], [None] * 64, [float("inf"), 1e300, *[0.0] * 62], None]
    given = pa.array(lists, pa.list_(pa.float64()))
    held = index._pack(given, 64)
    assert index._unpack(held, 64).to_pylist() == lists
    assert np.signbit(index._unpack(held, 64).to_pylist()[-5][0])
    assert [len(r["val"] or r["wide"]) for r in held.to_pylist()[1:41]] == [1] * 40
    assert all(r["wide"] is None for r in held.to_pylist()[41:81])
    for start, n in ((3, 50), (0, 1), (5, 0)):
        assert index._unpack(held.slice(start, n), 64).to_pylist() == lists[start : start + n]
        assert index._unpack(index._pack(given.slice(start, n), 64), 64).to_pylist() == lists[start : start + n]
    single = index._pack(pa.array(lists[1:41], pa.list_(pa.float32())), 64)
    assert all(r["wide"] is None and len(r["idx"]) == 1 for r in single.to_pylist())


def test_an_index_writes_no_dense_vectors(spark, monkeypatch):
    vectors = np.zeros((30, 64))
    vectors[np.arange(30), np.arange(30)] = 2.0
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "key bigint, embedding array<float>")
    written, write = [], index._write_base
    monkeypatch.setattr(index, "_write_base", lambda df, path: written.append(df) or write(df, path))
    made = index.create_from_vectors(rows, stage_path(spark, "ix"), "key", 64, [])
    index.write_changes(spark, made, upserts=rows.where("key < 3").withColumn("embedding", F.reverse("embedding")))
    after = index.compact(spark, made)
    for df in written:
        assert [(list(r.embedding.val), r.embedding.wide) for r in df.collect()] == [([2.0], None)] * 30
    assert {r.key: r.embedding.index(1.0) for r in index.current_rows(spark, after).collect()} == {i: 63 - i if i < 3 else i for i in range(30)}
