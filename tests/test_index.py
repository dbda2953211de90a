import pytest
from pyspark.sql import functions as F

from gleaner.operators import changes, embed, index, search
from gleaner.plans.stages import chunk_table, counted_chunks
from gleaner.session import stage_path, staged
from gleaner.streaming.sync import file_stream, sync_stream


@pytest.fixture
def rows(spark, small):
    return spark.read.parquet(f"{small}/embeddings.parquet")


@pytest.fixture
def made(spark, rows):
    return index.create_from_vectors(rows, stage_path(spark, "ix"), "vec_id", 64, ["label"], buckets=8)


def best(df):
    return sorted((r.query_id, r.rank, r.key) for r in df.collect())


def test_reopened_index_is_the_same(spark, made):
    again = index.open_index(spark, made.path)
    assert (again.version, again.mode, again.columns, again.width) == (1, "vectors", ("label",), 64)
    assert again == made or (again.buckets, again.row_schema) == (made.buckets, made.row_schema)
    assert again.centres(spark).count() == again.buckets == 8
    assert index.open_index(spark, stage_path(spark, "nothing")) is None


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 8 * 64 * 150}])
def test_all_buckets_give_the_exact_result_and_fewer_give_most_of_it(spark, rows, made, limits):
    asked = rows.withColumnRenamed("vec_id", "query_id")
    exact = best(search.nearest(rows, rows, 5, key="vec_id", query_id="vec_id", width=64))
    assert best(index.search_index(spark, made, asked, 5, made.model_id, probes=8, **limits)) == exact
    some = best(index.search_index(spark, made, asked, 5, made.model_id, probes=4, **limits))
    pairs = {(q, k) for q, _, k in exact}
    assert len(pairs & {(q, k) for q, _, k in some}) / len(pairs) > 0.6


def test_another_model_or_mode_is_refused(spark, rows, made):
    asked = rows.withColumnRenamed("vec_id", "query_id")
    with pytest.raises(ValueError, match="was made with"):
        index.search_index(spark, made, asked, 5, "another model")
    with pytest.raises(ValueError, match="was made with"):
        index.create_or_sync(rows, made.path, "vec_id", 64, ["label"], model="another model")
    with pytest.raises(ValueError, match="no model"):
        index.load_model(made)


def test_a_wrong_width_fails_the_build(spark, rows):
    wrong = rows.withColumn("embedding", F.when(F.col("vec_id") == 3, F.slice("embedding", 1, 5)).otherwise(F.col("embedding")))
    with pytest.raises(Exception, match="not 64 wide"):
        index.create_from_vectors(wrong, stage_path(spark, "ix"), "vec_id", 64, ["label"])


def test_repeated_and_late_changes(spark, rows, made):
    def version(n, label):
        return rows.where("vec_id < 10").select(
            F.col("vec_id").alias("key"), F.lit(label).alias("label"), "embedding", F.lit(n).alias("v")
        )

    index.write_changes(spark, made, 0, upserts=version(5, 50), version="v", writer="w")
    index.write_changes(spark, made, 0, upserts=version(5, 50), version="v", writer="w")
    index.write_changes(spark, made, 1, upserts=version(4, 40), version="v", writer="w")
    index.write_changes(spark, made, 2, deletes=version(9, 0).where("key = 2"), version="v", writer="w")

    def check(now):
        table = index.current_rows(spark, now)
        assert table.count() == table.select("key").distinct().count() == 499
        assert table.where("label = 50").count() == 9 and table.where("label = 40").count() == 0

    check(made)
    folded = index.compact(spark, made)
    assert (folded.version, folded.applied_sync) == (2, 2)
    check(index.open_index(spark, made.path))
    assert index.compact(spark, folded).version == 2


def test_stream_equals_batch_and_a_second_run_adds_nothing(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    counted = staged(counted_chunks(docs), "counted")
    path, checkpoint = stage_path(spark, "ix"), stage_path(spark, "cp")
    made = index.create_from_text(counted.where("doc_id % 2 = 0"), path, "key", "content", ["doc_id"], buckets=4)
    model = index.load_model(made)

    def prepare(batch):
        rows = embed.embed_text(chunk_table(batch), "content", model)
        return rows.select("key", "doc_id", "content", "embedding", F.lit(1).alias("version"))

    for _ in range(2):
        stream = file_stream(spark, small, docs.schema, glob="documents.parquet").withColumn("version", F.lit(1))
        sync_stream(stream, made, prepare, checkpoint, "doc_id", "version").awaitTermination()
    assert index.last_sync(spark, made) == 0
    got = index.current_rows(spark, made)
    want = index.normalised(embed.embed_counts(counted, model))

    def shape(df):
        return {(r.key, r.content, round(sum(r.embedding), 3)) for r in df.collect()}

    assert shape(got) == shape(want)
    counts = changes.completeness(counted, got, "key").first()
    assert counts.complete and counts.indexed == counted.count()


def test_text_index_is_created_then_synced(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    counted = staged(counted_chunks(docs), "counted")
    path = stage_path(spark, "ix")
    for given, sets in ((counted, None), (counted, None), (counted.where("doc_id <> 5"), 0)):
        made = index.create_or_sync_text(given, path, "key", "content", ["doc_id"], buckets=4)
        changed = index.change_sets(spark, made)
        assert (None if changed is None else index.last_sync(spark, made)) == sets
        assert index.current_rows(spark, made).count() == given.count()
    with pytest.raises(ValueError, match="in mode text"):
        index.create_or_sync(counted, path, "key", 1024, ["doc_id"])


def test_copies_can_be_indexed(spark, rows):
    one = rows.where("vec_id = 1").select("embedding")
    copies = spark.range(50).join(one).select(F.col("id").alias("vec_id"), F.lit(1).alias("label"), "embedding")
    mixed = copies.unionByName(rows.where("vec_id >= 490").select("vec_id", "label", "embedding"))
    for source in (copies, mixed):
        made = index.create_from_vectors(source, stage_path(spark, "ix"), "vec_id", 64, ["label"])
        asked = source.withColumnRenamed("vec_id", "query_id")
        got = index.search_index(spark, made, asked, 3, made.model_id, probes=made.buckets)
        assert best(got) == best(search.nearest(source, source, 3, key="vec_id", query_id="vec_id", width=64))


def test_changes_reach_an_index_with_versions(spark, rows):
    """A plain sync of an index that was built with high versions is not lost, and a second one writes nothing."""
    versioned = rows.withColumn("v", F.lit(1000) + F.col("vec_id"))
    path = stage_path(spark, "ix")
    made = index.create_from_vectors(versioned, path, "vec_id", 64, ["label"], buckets=4, version="v")
    changed = rows.withColumn("label", F.when(F.col("vec_id") < 8, 77).otherwise(F.col("label"))).where("vec_id <> 9")
    for _ in range(2):
        index.create_or_sync(changed, path, "vec_id", 64, ["label"])
    assert index.change_sets(spark, made).count() == 9
    now = index.current_rows(spark, made)
    assert now.where("label = 77").count() == 8 and now.where("key = 9").isEmpty()


def test_writers_do_not_overwrite_each_other(spark, rows, made):
    keys = rows.select(F.col("vec_id").alias("key"), "label", "embedding")
    index.write_changes(spark, made, deletes=keys.where("key = 1").select("key"))
    index.write_changes(spark, made, 0, upserts=keys.where("key = 2").withColumn("label", F.lit(90)), writer="stream")
    index.write_changes(spark, made, 0, upserts=keys.where("key = 3").withColumn("label", F.lit(91)), writer="other")
    index.write_changes(spark, made, 0, upserts=keys.where("key = 2").withColumn("label", F.lit(90)), writer="stream")
    for now in (made, index.compact(spark, made)):
        table = index.current_rows(spark, now)
        assert table.where("key = 1").isEmpty()
        assert {(r.key, r.label) for r in table.where("label >= 90").collect()} == {(2, 90), (3, 91)}


def test_a_value_that_moves_between_null_columns_is_a_change(spark, rows):
    path = stage_path(spark, "ix")
    few = rows.where("vec_id < 5").select("vec_id", "embedding")
    first = few.select("*", F.lit(None).cast("string").alias("a"), F.lit("x").alias("b"))
    second = few.select("*", F.lit("x").alias("a"), F.lit(None).cast("string").alias("b"))
    index.create_or_sync(first, path, "vec_id", 64, ["a", "b"], buckets=2)
    made = index.create_or_sync(second, path, "vec_id", 64, ["a", "b"])
    assert index.current_rows(spark, made).where("a = 'x' AND b IS NULL").count() == 5


def test_repeated_keys_and_nan_are_refused(spark, rows):
    twice = rows.unionByName(rows.where("vec_id = 3"))
    with pytest.raises(ValueError, match="key 3 stands in 2 rows"):
        index.create_from_vectors(twice, stage_path(spark, "ix"), "vec_id", 64, ["label"], buckets=2)
    nan = rows.withColumn("embedding", F.transform("embedding", lambda x, i: F.when(i == 5, float("nan")).otherwise(x)))
    with pytest.raises(Exception, match="holds NaN"):
        index.create_from_vectors(nan, stage_path(spark, "ix"), "vec_id", 64, ["label"], buckets=2)


def test_probing_does_not_depend_on_the_length_of_the_query(spark, rows, made):
    asked = rows.withColumnRenamed("vec_id", "query_id")
    short = asked.withColumn("embedding", F.transform("embedding", lambda x: (x * 0.01).cast("float")))
    got, want = (best(index.search_index(spark, made, q, 5, made.model_id, probes=2)) for q in (short, asked))
    assert len(set(got) & set(want)) > 0.99 * len(want)


def test_filters_on_an_index_search(spark, rows, made):
    asked = rows.withColumnRenamed("vec_id", "query_id")
    exact = search.nearest(rows, rows, 5, 64, key="vec_id", query_id="vec_id", within=["label"], where=F.col("label") != 2)
    for probes in (None, 8):
        got = index.search_index(spark, made, asked, 5, made.model_id, probes=probes, within=["label"], where=F.col("label") != 2)
        assert best(got) == best(exact)


def test_large_scores_and_wrong_queries(spark):
    table = spark.createDataFrame([(i, [1e7 * i, 1e7]) for i in range(1, 4)], "key bigint, embedding array<double>")
    asked = spark.createDataFrame([(1, [1e7, 0.0])], "query_id bigint, embedding array<double>")
    assert best(search.nearest(table, asked, 3, 2, measure="dot")) == [(1, 1, 3), (1, 2, 2), (1, 3, 1)]
    wrong = spark.createDataFrame([(1, [1.0]), (2, None)], "query_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="not 2 wide, query_id"):
        search.nearest(table, wrong, 3, 2)


def test_a_stream_removes_what_a_document_no_longer_holds(spark):
    schema = "doc_id bigint, text string, source string, lang string, version int"
    words = " ".join(f"w{i}" for i in range(1200))
    first = spark.createDataFrame([(1, words, "s", "en", 1), (2, words, "s", "en", 1), (3, "kept", "s", "en", 1)], schema)
    made = index.create_from_text(staged(counted_chunks(first), "c"), stage_path(spark, "ix"), "key", "content", ["doc_id"], buckets=1)
    model, folder, checkpoint = index.load_model(made), stage_path(spark, "in"), stage_path(spark, "cp")

    def prepare(batch):
        rows = chunk_table(batch).join(batch.select("doc_id", "version"), "doc_id")
        return embed.embed_text(rows, "content", model).select("key", "doc_id", "content", "embedding", "version")

    later = spark.createDataFrame([(1, "short now", "s", "en", 2), (2, "", "s", "en", 2), (3, "too late", "s", "en", 0)], schema)
    for delivery in (first, later):
        delivery.write.mode("append").parquet(folder)
        stream = file_stream(spark, folder, first.schema)
        sync_stream(stream, made, prepare, checkpoint, "doc_id", "version", owner="doc_id").awaitTermination()
    assert sorted((r.doc_id, r.content) for r in index.current_rows(spark, made).collect()) == [(1, "short now"), (3, "kept")]
