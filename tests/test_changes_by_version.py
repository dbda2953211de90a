"""The commit log and its feed, the stream with keyed state, and raw files as a stream."""

import os
import random
from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gleaner.operators import changes, index
from gleaner.session import stage_path
from gleaner.sources import versions
from gleaner.streaming import raw_files
from gleaner.streaming.keyed import newest, sync_keyed
from gleaner.streaming.sync import file_stream


def as_set(df):
    return sorted(map(repr, (tuple(r) for r in df.select("id", "change", "a", "b").collect())))


def frame(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], "id bigint, a string, b int")


def test_feed_equals_the_differences_of_all_pairs_of_versions(spark):
    rng, path = random.Random(4), stage_path(spark, "versions")
    state = {i: (rng.choice(["x", "y", None]), rng.choice([1, None])) for i in range(30)}
    states = [dict(state)]
    assert versions.create(frame(spark, state), path, "id") == 1
    for step in range(4):
        gone = set(rng.sample(sorted(state), 5)) | {900 + step}  # deleting what is not there changes nothing
        new = {i: (rng.choice(["x", "y", None]), rng.choice([1, 2, None])) for i in rng.sample(range(45), 14) if i not in gone}
        number = versions.commit(spark, path, "id", frame(spark, new), spark.createDataFrame([(g,) for g in gone], "id bigint"), batch=f"b{step}")
        assert number == step + 2
        assert versions.commit(spark, path, "id", frame(spark, new), batch=f"b{step}") == number  # the same batch again
        state = {i: v for i, v in (state | new).items() if i not in gone}
        states.append(dict(state))
        if step == 1:
            versions.fold(spark, path, "id")
    for v, want in enumerate(states, 1):
        assert sorted(map(tuple, versions.snapshot(spark, path, "id", v).select("id", "a", "b").collect()), key=repr) == sorted(((k, *x) for k, x in want.items()), key=repr)
    for a in range(1, 5):
        step = changes.changes_between(frame(spark, states[a - 1]), frame(spark, states[a]), "id", ["a", "b"])
        assert as_set(versions.feed(spark, path, a, a + 1)) == as_set(step)
    for a, b in ((1, 5), (2, 4), (1, 3)):
        jump = changes.changes_between(frame(spark, states[a - 1]), frame(spark, states[b - 1]), "id", ["a", "b"])
        assert as_set(versions.net_feed(spark, path, "id", a, b)) == as_set(jump)
    assert versions.net_feed(spark, path, "id", 0, 5).where("change <> 'insert'").count() == 0
    assert versions.feed(spark, path, 5).count() == 0


def test_feed_reads_the_files_of_its_versions_only(spark):
    path = stage_path(spark, "versions")
    versions.create(frame(spark, {1: ("a", 1), 2: ("b", 2)}), path, "id")
    versions.commit(spark, path, "id", frame(spark, {1: ("c", 1)}))
    versions.commit(spark, path, "id", frame(spark, {2: ("c", 1)}))
    folders = {r.version: r.folder for r in versions.log(spark, path)}
    read = versions.feed(spark, path, 1, 2).inputFiles()
    assert read and all(folders[2] in f for f in read)


def test_versions_without_change_and_wrong_keys(spark):
    path = stage_path(spark, "versions")
    with pytest.raises(ValueError, match="no table"):
        versions.feed(spark, path)
    versions.create(frame(spark, {1: ("a", None)}), path, "id")
    assert versions.commit(spark, path, "id", frame(spark, {1: ("a", None)})) == 1
    for wrong in ([(None, "x", 1)], [(1, "x", 1), (1, "y", 1)]):
        with pytest.raises(ValueError, match="stands in"):
            versions.commit(spark, path, "id", spark.createDataFrame(wrong, "id bigint, a string, b int"))
    with pytest.raises(ValueError, match="no version 7"):
        versions.snapshot(spark, path, "id", 7)
    with pytest.raises(ValueError, match="there is a table"):
        versions.create(frame(spark, {}), path, "id")
    log = spark.read.schema(versions.LOG_SCHEMA).parquet(f"{path}/log")
    log.union(log).coalesce(1).write.mode("append").parquet(f"{path}/log")
    with pytest.raises(ValueError, match="two commits"):
        versions.feed(spark, path)


def test_keyed_state_settles_late_repeated_and_shrinking_rows_without_the_base(spark):
    """A source row has ``n`` chunks; the index's base files are not there at all."""
    base = spark.createDataFrame([(-1, 0, 0, [1.0, 0.0])], "key bigint, doc bigint, no int, embedding array<double>")
    made = index.create_from_vectors(base, stage_path(spark, "ix"), "key", 2, ["doc", "no"])
    blind = replace(made, version=99)
    folder, checkpoint = stage_path(spark, "in"), stage_path(spark, "checkpoint")
    key = lambda doc, no: doc * 100 + no

    def prepare(rows):
        some = rows.where("n > 0").select("doc", "v", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("no"))
        return some.select(key(F.col("doc"), F.col("no")).alias("key"), "doc", "no", F.array(F.lit(1.0), F.col("v").cast("double")).alias("embedding"), "v")

    deliveries = [
        [(1, 3, 1), (2, 2, 1), (3, 1, 1), (None, 1, 1), (4, 1, None)],
        [(1, 1, 2), (2, 5, 0), (2, 2, 1), (5, 2, 1), (5, 4, 3), (5, 1, 2)],  # shrinks, late, again, three versions at once
        [(3, 0, 5), (1, 2, 1)],  # empty, late
        [(3, 2, 6)],  # back again
    ]
    for rows in deliveries:
        spark.createDataFrame(rows, "doc bigint, n int, v bigint").coalesce(1).write.mode("append").parquet(folder)
        stream = file_stream(spark, folder, "doc bigint, n int, v bigint")
        sync_keyed(stream, blind, prepare, F.col("n"), key, checkpoint, "doc", "v").awaitTermination()
    got = sorted((r.doc, r.no, r.version) for r in index.current_rows(spark, made).where("doc > 0").collect())
    assert got == [(1, 0, 2), (2, 0, 1), (2, 1, 1), (3, 0, 6), (3, 1, 6), *[(5, i, 3) for i in range(4)]]


def test_files_are_loaded_once_and_replaced_ones_again(spark, tmp_path):
    folder, table, checkpoint = tmp_path / "in", stage_path(spark, "raw"), stage_path(spark, "checkpoint")
    (folder / "deep").mkdir(parents=True)
    (folder / "a.txt").write_bytes(b"one")
    (folder / "deep" / "b.txt").write_bytes(b"b")
    (folder / "empty.txt").write_bytes(b"")
    (folder / "skip.bin").write_bytes(b"no")

    def sync():
        found = raw_files.sync_files(spark, str(folder), table, checkpoint, glob="*.txt")
        return sorted((r.path.rsplit("/", 1)[1], r.length, r.kind, r.batch) for r in found.collect()), raw_files.loads(spark, table).count()

    assert sync() == ([("a.txt", 3, "new", 0), ("b.txt", 1, "new", 0)], 2)
    assert sync() == ([("a.txt", 3, "new", 0), ("b.txt", 1, "new", 0)], 2)
    (folder / "a.txt").write_bytes(b"other")
    (folder / "c.txt").write_bytes(b"new")
    os.utime(folder / "deep" / "b.txt", (1, 1))  # touched, but the same bytes
    assert sync() == ([("a.txt", 5, "replaced", 0), ("b.txt", 1, "new", 0), ("c.txt", 3, "new", 1)], 4)
    (folder / "a.txt").write_bytes(b"third")
    os.utime(folder / "a.txt", (2, 2))
    assert sync()[0][0] == ("a.txt", 5, "replaced", 1)
    assert {bytes(r.content) for r in raw_files.current_files(spark, table).collect()} == {b"third", b"b", b"new"}
    paths = [r.path for r in raw_files.manifest(spark, table).collect()]
    expected = spark.createDataFrame([(p,) for p in [*paths[1:], "file:/gone"]], "path string")
    assert sorted(map(tuple, raw_files.check_manifest(spark, table, expected).collect())) == sorted([(paths[0], "extra"), ("file:/gone", "missing")])


def test_a_repeated_file_batch_replaces_itself(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one")
    table = stage_path(spark, "raw")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    for _ in range(2):
        raw_files._write(files, table, "new", 0)
    assert raw_files.loads(spark, table).count() == 1
    assert raw_files.loads(spark, stage_path(spark, "nothing")).count() == 0




def test_a_key_that_comes_once_is_settled_without_sorting(monkeypatch):
    """Nearly every group of a stream is one row, and sorting it cost more than all the rest."""
    row = pd.DataFrame({"doc": [1], "v": [3], "_order": [7]})
    many = pd.DataFrame({"doc": [1, 1, 1], "v": [2, 3, 3], "_order": [9, 8, 6]})
    assert newest(iter([row, many, row]), "v")[1] == (3, 8)
    assert newest(iter([row.iloc[:0]]), "v") == (None, None)
    monkeypatch.setattr(pd.DataFrame, "sort_values", None)
    best, rank = newest(iter([row]), "v")
    assert rank == (3, 7) and best.equals(row)
