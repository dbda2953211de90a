"""Files as rows: binary scans, the bytes of files of any size in pieces, one named file, and manifest checks.

A row cannot hold 2 GB, and a row of some hundred MB takes several times its size of memory. ``read_pieces`` reads a file as the lines
between its line feeds, in one task and in order, and joins them again: a task holds one piece, and the digest is made on the way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import settings, stage_path

PIECE_BYTES = 1 << 20
#: For rows of a piece each: the writer looks at its size after every row, not after each hundredth.
PIECE_WRITER = {
    "parquet.block.size": str(16 << 20), "parquet.enable.dictionary": "false", "parquet.page.size.row.check.min": "1",
    "parquet.page.size.check.estimate": "false", "parquet.block.size.row.check.min": "1",
}
#: Names that Spark's reader of lines would unpack. These files are read as a whole.
PACKED_NAMES = (".bz2", ".deflate", ".gz", ".lz4", ".snappy", ".zst")
BYTE_ORDER_MARK = b"\xef\xbb\xbf"
#: ``piece`` counts from 0; the last row of a file has its digest and no bytes.
PIECES = "path string, modificationTime timestamp, length bigint, piece int, content binary, digest string"


def scan_files(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    modified_after: str | None = None,
) -> DataFrame:
    """One row per file below ``path``: path, modificationTime, length, content.

    Spark reads the bytes only if ``content`` is used later; a file of 2 GB or more has none (``file_digests``, ``read_pieces``).
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(path)


class _Cutting:
    """One file that is being read: its digest so far, and the bytes that are not yet a piece."""

    def __init__(self, path: str, time: pa.Scalar, size: int, digest: str, piece_bytes: int, keep: bool, whole: bool):
        self.path, self.time, self.size, self.piece_bytes, self.keep, self.whole = path, time, size, piece_bytes, keep, whole
        # The reader of lines leaves out a byte order mark at the start; whether there was one is known at the end.
        self.digests = [hashlib.new(digest), hashlib.new(digest, BYTE_ORDER_MARK)]
        self.read, self.pieces, self.held, self.begun = 0, 0, bytearray(), False

    def _row(self, piece: int, content: bytes | None, digest: str | None = None) -> pa.RecordBatch:
        columns = [[self.path], pa.array([self.time.as_py()], self.time.type), pa.array([self.size], pa.int64()), pa.array([piece], pa.int32()), pa.array([content], pa.binary()), pa.array([digest], pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, list) else c for c in columns], names=["path", "modificationTime", "length", "piece", "content", "digest"])

    def _feed(self, data: bytes) -> None:
        for digest in self.digests:
            digest.update(data)
        self.read += len(data)
        if self.keep:
            self.held += data

    def _full(self, least: int) -> Iterator[pa.RecordBatch]:
        while len(self.held) >= least:
            piece = bytes(self.held[: self.piece_bytes])
            del self.held[: self.piece_bytes]
            yield self._row(self.pieces, piece)
            self.pieces += 1

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        if self.begun and not self.whole:
            self._feed(b"\n")
        self.begun = True
        self._feed(b"\n".join(lines.to_pylist()))
        yield from self._full(self.piece_bytes)

    def ended(self) -> Iterator[pa.RecordBatch]:
        # A line feed at the end starts no line.
        if self.size - self.read in (1, 1 + len(BYTE_ORDER_MARK)):
            self._feed(b"\n")
        marked = self.size - self.read == len(BYTE_ORDER_MARK)
        if not marked and self.size != self.read:
            raise ValueError(f"{self.path}: {self.read} of {self.size} bytes were read")
        if marked and self.keep:
            yield self._row(-1, BYTE_ORDER_MARK)
        yield from self._full(1)
        yield self._row(self.pieces, None, self.digests[marked].hexdigest())


def read_pieces(spark: SparkSession, paths: list[str], to: str, digest: str = "sha256", piece_bytes: int = PIECE_BYTES, keep: bool = True) -> DataFrame:
    """The bytes of files as rows of ``PIECES``, written to the path ``to``; without ``keep`` only the row with the digest.

    A digest is made from the first byte to the last, so a file is read by one task; different files are read side by side.
    """
    def reading(kind: str, names: list[str]) -> DataFrame:
        reader = spark.read.format(kind).option("recursiveFileLookup", "true").option("__globPaths__", "false")
        return (reader.option("lineSep", "\n") if kind == "text" else reader).load(names)

    def scanned(names: list[str]):
        tiny = F.collect_list(F.when(F.col("length") <= len(BYTE_ORDER_MARK), F.col("path")))
        return reading("binaryFile", names).agg(F.max("length").alias("most"), F.sum("length").alias("total"), tiny.alias("tiny")).first()

    def cut(whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                start = 0
                for end in pc.run_end_encode(batch.column("path")).run_ends.to_pylist():
                    path = batch.column("path")[start].as_py()
                    path = path if whole else unquote(path)  # the metadata of a row has it as a URI
                    if now is None or now.path != path:
                        if now is not None:
                            yield from now.ended()
                        now = _Cutting(path, batch.column("modificationTime")[start], batch.column("length")[start].as_py(), digest, piece_bytes, keep, whole)
                    yield from now.add(batch.column("content").slice(start, end - start))
                    start = end
            if now is not None:
                yield from now.ended()

        return run

    found = spark.createDataFrame([], PIECES)
    at = {"spark.sql.execution.arrow.maxRecordsPerBatch": 10_000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 * PIECE_BYTES}
    packed = {p for p in paths if p.lower().endswith(PACKED_NAMES)}
    plain = set(paths) - packed
    if plain:
        sizes = scanned(sorted(plain))
        # No file is cut, and small ones share a task.
        most = max(sizes.most, sizes.total // (2 * spark.sparkContext.defaultParallelism))
        at |= {"spark.sql.files.maxPartitionBytes": most + 1, "spark.sql.files.minPartitionNum": 1}
        # A file of a byte order mark alone has no line.
        packed, plain = packed | set(sizes.tiny), plain - set(sizes.tiny)
    if plain:
        meta = F.col("_metadata")
        told = [meta["file_path"].alias("path"), meta["file_modification_time"].alias("modificationTime"), meta["file_size"].alias("length")]
        lines = reading("text", sorted(plain)).select(*told, F.col("value").cast("binary").alias("content"))
        found = found.unionByName(lines.mapInArrow(cut(False), PIECES))
    if packed:
        rows = reading("binaryFile", sorted(packed)).select("path", "modificationTime", "length", "content")
        found = found.unionByName(rows.mapInArrow(cut(True), PIECES))
    with settings(spark, at):
        found.write.mode("overwrite").options(**PIECE_WRITER).parquet(to)
    return spark.read.schema(PIECES).parquet(to)


def file_digests(spark: SparkSession, files: DataFrame, digest: str = "sha256") -> DataFrame:
    """(path, modificationTime, length, digest) of files of any size; ``files`` names them by ``path``."""
    made = read_pieces(spark, [r.path for r in files.select("path").collect()], stage_path(spark, "digests"), digest, keep=False)
    return made.select("path", "modificationTime", "length", "digest")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def named_file(raw: DataFrame, path: str | Column) -> DataFrame:
    """The row of one file of a raw table."""
    return raw.where(F.col("path") == (path if isinstance(path, Column) else F.lit(path)))


def manifest_difference(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Rows (key, status): ``missing`` is expected but not there, ``extra`` is there but not expected."""
    want, have = expected.select(key).distinct(), present.select(key).distinct()
    missing = want.join(have, key, "left_anti").select(key, F.lit("missing").alias("status"))
    extra = have.join(want, key, "left_anti").select(key, F.lit("extra").alias("status"))
    return missing.unionByName(extra)
