"""Raw files as a stream: each file is loaded once, with its bytes, and a manifest says what was loaded when.

New files come through Spark's ``binaryFile`` source, whose checkpoint remembers them. That source never looks again at a
path it knows, so a second step compares the folder's listing (names, lengths, times; no bytes) with the manifest and
loads the files that were replaced. The sources only name the files; their bytes are read and stored in pieces (``files.read_pieces``), so a
file may be larger than a row or a task. Every batch is a folder of loads and one of pieces, each written as a whole and named by its
number: a batch that is repeated after a failure replaces itself, so a file stands in the table once. Files without bytes are not rows of
Spark's file sources, so they are not loaded.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.sources import files as sources
from gleaner.sources.files import manifest_difference, scan_files
from gleaner.session import staged

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
LOAD_READ = "path string, modificationTime timestamp, length bigint, digest string, kind string, batch bigint"
PIECE_READ = f"{sources.PIECES}, kind string, batch bigint"


def _pieces(table: str) -> str:
    return f"{table}/_pieces"  # a name that readers of the table pass over


def _write(files: DataFrame, table: str, kind: str, batch: int) -> None:
    """Store the pieces of the files that ``files`` names by ``path``, then their loads."""
    place = f"kind={kind}/batch={batch}"
    made = sources.read_pieces(files.sparkSession, [r.path for r in files.select("path").collect()], f"{_pieces(table)}/{place}")
    loaded = made.where("digest IS NOT NULL").select("path", "modificationTime", "length", "digest")
    loaded.write.mode("overwrite").parquet(f"{table}/{place}")


def loads(spark: SparkSession, table: str) -> DataFrame:
    """All loads: path, modificationTime, length, digest, kind (new or replaced), batch. Their bytes are ``current_pieces``."""
    try:
        return spark.read.schema(LOAD_READ).option("basePath", table).parquet(table)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LOAD_READ)
        raise


def manifest(spark: SparkSession, table: str) -> DataFrame:
    """The newest load of each path: path, modificationTime, length, digest, kind, batch. The bytes are not read."""
    narrow = loads(spark, table)
    own = [c for c in narrow.columns if c != "path"]
    # A path is new once and replaced after that; "replaced" sorts after "new".
    newest = narrow.groupBy("path").agg(F.max(F.struct("kind", "batch", *[c for c in own if c not in ("kind", "batch")])).alias("m"))
    return newest.select("path", *[f"m.{c}" for c in own])


def current_pieces(spark: SparkSession, table: str) -> DataFrame:
    """The newest bytes of each path: path, modificationTime, length, piece, content. In the order of ``piece`` they are the file."""
    wanted = manifest(spark, table).select("path", "kind", "batch")
    stored = spark.read.schema(PIECE_READ).option("basePath", _pieces(table)).parquet(_pieces(table)).where("digest IS NULL")
    return stored.join(wanted, ["path", "kind", "batch"], "left_semi").select("path", "modificationTime", "length", "piece", "content")


def current_files(spark: SparkSession, table: str) -> DataFrame:
    """The newest bytes of each path, with the columns of a file scan: a row for each file, which has to fit a task."""

    def whole(pieces: pa.Table) -> pa.Table:
        ordered = pieces.sort_by("piece")
        first = ordered.slice(0, 1).select(["path", "modificationTime", "length"])
        return first.append_column("content", pa.array([b"".join(ordered["content"].to_pylist())], pa.binary()))

    return current_pieces(spark, table).groupBy("path").applyInArrow(whole, FILE_SCHEMA)


def load_new(spark: SparkSession, folder: str, table: str, checkpoint: str, glob: str | None = None, files_per_batch: int | None = None) -> None:
    """Load the files that the stream has not seen, and end."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def write(batch: DataFrame, number: int) -> None:
        _write(batch, table, "new", number)

    reader.load(folder).select("path").writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def load_replaced(spark: SparkSession, folder: str, table: str, glob: str | None = None) -> int:
    """Load the files whose length or time differs from the manifest and whose bytes differ, too; their number."""
    known = manifest(spark, table)
    listed = scan_files(spark, folder, glob).select("path", "modificationTime", "length")
    told = known.select("path", F.col("modificationTime").alias("_time"), F.col("length").alias("_length"), "digest")
    touched = staged(listed.join(told, "path").where("modificationTime <> _time OR length <> _length").select("path", F.col("digest").alias("_old")), "touched")
    if touched.isEmpty():
        return 0
    told = sources.file_digests(spark, touched)
    files = staged(told.join(touched, "path").where(F.col("digest") != F.col("_old")).select("path"), "replaced")
    found = files.count()
    if found:
        last = loads(spark, table).where("kind = 'replaced'").agg(F.max("batch")).first()[0]
        _write(files, table, "replaced", 0 if last is None else last + 1)
    return found


def sync_files(spark: SparkSession, folder: str, table: str, checkpoint: str, glob: str | None = None) -> DataFrame:
    """Load what is new and what was replaced, and give the manifest."""
    load_new(spark, folder, table, checkpoint, glob)
    load_replaced(spark, folder, table, glob)
    return manifest(spark, table)


def check_manifest(spark: SparkSession, table: str, expected: DataFrame) -> DataFrame:
    """(path, status): files of the expected list that were never loaded, and loaded ones that are not on it."""
    return manifest_difference(expected, manifest(spark, table), "path")
