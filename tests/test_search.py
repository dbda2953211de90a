import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleaner.operators import blocks, search
from gleaner.plans.stages import benchmark_questions, prepare, retrieve
from gleaner.session import staged


def frames(spark, rows, queries, groups=None):
    def make(matrix, name, group):
        data = [(i, v.tolist(), int(group[i]) if group is not None else 0) for i, v in enumerate(matrix)]
        return spark.createDataFrame(data, f"{name} bigint, embedding array<float>, label int")

    g = groups or (None, None)
    return make(rows, "key", g[0]).repartition(3), make(queries, "query_id", g[1])


def brute(rows, queries, k, measure, groups=None):
    rows, queries = rows.astype(np.float32).astype(float), queries.astype(np.float32).astype(float)
    out = []
    for q, v in enumerate(queries):
        scored = []
        for i, r in enumerate(rows):
            if groups is not None and groups[0][i] != groups[1][q]:
                continue
            if measure == "cosine":
                n = np.linalg.norm(r) * np.linalg.norm(v)
                s = r @ v / n if n else 0.0
            elif measure == "dot":
                s = r @ v
            else:
                s = -np.linalg.norm(r - v)
            scored.append((-round(float(s), 6), i))
        out += [(q, n + 1, i) for n, (_, i) in enumerate(sorted(scored)[:k])]
    return out


def found(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "key").collect())


#: One scan with all queries, blocks of both sides that fit one pair, and many small blocks.
PLANS = [{}, {"broadcast_bytes": 8 * 8 * 7}, {"broadcast_bytes": 8 * 8 * 7, "block_bytes": 600}]


@pytest.mark.parametrize("measure", search.MEASURES)
@pytest.mark.parametrize("limits", PLANS)
def test_both_plans_by_brute_force(spark, measure, limits):
    rng = np.random.default_rng(3)
    rows, queries = rng.normal(size=(60, 8)), rng.normal(size=(20, 8))
    rows[5] = 0.0
    rows[20:45] = rows[20]  # a group of copies with nearly half of all rows: ties go to the smaller key
    queries[3] = rows[20]
    corpus, asked = frames(spark, rows, queries)
    got = search.nearest(corpus, asked, 4, 8, measure=measure, **limits)
    assert found(got) == brute(rows, queries, 4, measure)


@pytest.mark.parametrize("limits", PLANS)
def test_search_within_a_skewed_group(spark, limits):
    rng = np.random.default_rng(4)
    rows, queries = rng.normal(size=(50, 8)), rng.normal(size=(18, 8))
    groups = (np.where(np.arange(50) < 35, 1, np.arange(50) % 3), np.arange(18) % 4)
    corpus, asked = frames(spark, rows, queries, groups)
    got = search.nearest(corpus, asked, 3, 8, within=["label"], **limits)
    assert found(got) == brute(rows, queries, 3, "cosine", groups)


def test_blocks_pair_every_row_with_every_query_of_its_cell_once(spark):
    """A hot cell, small cells, cells of one side only; no block above its size."""
    cells = [1] * 300 + [2] * 40 + [3, 4, 5, 6] + [8] * 9
    rows = staged(spark.createDataFrame([(str(c), i) for i, c in enumerate(cells)], "cell string, a int"), "t")
    queries = staged(spark.createDataFrame([(str(c), i) for i, c in enumerate([1] * 70 + [2, 2, 3, 4, 7, 8])], "cell string, b int"), "t")

    def meet(left, right):
        both = left.to_pandas().merge(right.to_pandas(), on="cell")[["a", "b"]]
        return pa.Table.from_pandas(both.assign(n=len(left), m=len(right)).astype("int32"), preserve_index=False)

    size = F.lit(10)
    got = blocks.paired(rows, queries, "cell", size, size, meet, "a int, b int, n int, m int", block_bytes=250).toPandas()
    want = rows.join(queries, "cell").select("a", "b").toPandas()
    assert sorted(zip(got.a, got.b)) == sorted(zip(want.a, want.b))
    assert got.n.max() <= 60 and got.m.max() <= 60


def test_a_large_query_set_stays_on_the_cluster(spark, small, monkeypatch):
    rows = spark.read.parquet(f"{small}/embeddings.parquet")
    monkeypatch.setattr(search, "_by_scan", None)
    got = search.nearest(rows, rows, 5, key="vec_id", query_id="vec_id", width=64, broadcast_bytes=1000, block_bytes=40_000)
    monkeypatch.undo()
    assert found(got) == found(search.nearest(rows, rows, 5, key="vec_id", query_id="vec_id", width=64))


def test_filter_comes_before_the_rank(spark):
    rows = np.eye(8)
    corpus, asked = frames(spark, rows, rows[:1])
    got = search.nearest(corpus, asked, 2, 8, where=F.col("key") >= 6)
    assert found(got) == [(0, 1, 6), (0, 2, 7)]
    none = search.nearest(corpus, asked, 2, 8, where=F.col("key") > 100)
    assert found(none) == []
    listed = search.passages(
        none.withColumn("f", F.lit("")).withColumn("t", F.lit("")), asked, "f", "t"
    ).first()
    assert listed.passages == []


def test_wrong_widths_and_missing_vectors_are_refused(spark):
    data = [(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, None), (4, [])]
    corpus = spark.createDataFrame(data, "key bigint, embedding array<float>")
    asked = corpus.select(F.col("key").alias("query_id"), "embedding")
    right, one = corpus.where("key = 1"), asked.where("query_id = 1")
    assert found(search.nearest(right, one, 5, 2)) == [(1, 1, 1)]
    assert found(search.nearest(corpus.limit(0), one, 5, 2)) == []
    assert found(search.nearest(corpus.limit(0), asked.limit(0), 5, 2)) == []
    for key in (2, 3, 4):
        with pytest.raises(Exception, match="not 2 wide, key"):
            search.nearest(corpus.where(F.col("key").isin(1, key)), one, 5, 2).collect()
        with pytest.raises(Exception, match="not 2 wide, query_id"):
            search.nearest(right, asked.where(F.col("query_id") == key), 5, 2).collect()


def test_questions_without_results_stay(spark):
    asked = spark.createDataFrame([(1, "a"), (2, "b")], "query_id bigint, question string")
    hits = spark.createDataFrame([(1, 1, 0.5, 7, "text")], "query_id bigint, rank int, score double, key bigint, content string")
    got = {r.query_id: (r.question, r.context) for r in search.contexts(hits, asked).collect()}
    assert got == {1: ("a", ["text"]), 2: ("b", [])}


def test_unknown_measure(spark):
    with pytest.raises(ValueError):
        search.nearest(None, None, 1, 2, measure="manhattan")


def test_wide_text_does_not_pass_the_rank(spark, small):
    chunks, model = prepare(spark, small)
    plan = retrieve(chunks, model, benchmark_questions(spark, small), 2)._jdf.queryExecution().toString()
    assert "content" not in plan.split("== Physical Plan ==")[1]


def test_no_cross_join_in_search_plans(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet")
    for limits in PLANS:
        got = search.nearest(rows, rows, 5, key="vec_id", query_id="vec_id", width=64, **limits)
        plan = got._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_planted_passages_are_found(spark):
    folder = "/root/testdata/sf0.01"
    chunks, model = prepare(spark, folder)
    asked = benchmark_questions(spark, folder).toPandas()
    docs = pd.read_parquet(f"{folder}/documents.parquet")
    truth = {
        (q.query_id, d.doc_id) for q in asked.itertuples() for d in docs.itertuples() if q.question in d.text
    }
    hits = retrieve(chunks, model, benchmark_questions(spark, folder), 5, ["doc_id"]).toPandas()
    questions = {q for q, _ in truth}
    recalled = {q for q, d in zip(hits.query_id, hits.doc_id) if (q, d) in truth}
    assert len(questions) == 20 and len(recalled) >= 14
