"""Training-order materialisation of token sequences.

Documents are tokenised and laid end to end, per task, into sequences of ``length`` ids; the last one of a task is padded with
the closing id. Sequence i of N gets the slot P(i), where P is a keyed permutation of 0..N-1: a balanced Feistel network over
the next even power of two, walked along its cycle until it is below N. Slots are cut into shards of ``per_shard`` records;
a shard is one file of fixed stride in slot order, so the record of slot s begins at byte (s mod per_shard) * stride of shard
s div per_shard, and a reader can go on at any slot. The stride is the ids' bytes and one line end, the shortest separator
with which Spark's text sink writes bytes as they are. A manifest says what each slot holds.

Defined results: null text is empty; an empty text is its closing id. Every row is a document, also with a repeated or null id.
No documents give no sequences and no shards. Extra columns are ignored. A document has to fit a task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import words as wd
from gleaner.llm.common import small_batches, stage
from gleaner.llm.tokens import END, Vocabulary, encoder

LENGTH = 1024
PER_SHARD = 4096
KEY = 0x5DEECE66D
#: Of an Arrow batch, of which the JVM and the Python worker of each task hold a few.
BATCH_BYTES = 8 << 20
ROUNDS = 6

U = np.uint64

SEQUENCES = "part int, place bigint, ids binary, n_ids int, pieces array<struct<doc_id:bigint,start:bigint,length:bigint>>"


class Permutation:
    """A keyed permutation of 0 .. n - 1."""

    def __init__(self, n: int, key: int, rounds: int = ROUNDS) -> None:
        self.n = n
        self.half = U(max(1, -(-(max(n, 2) - 1).bit_length() // 2)))
        self.mask = (U(1) << self.half) - U(1)
        self.keys = wd.mix(np.arange(1, rounds + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(key & 0xFFFFFFFFFFFFFFFF))

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys:
            left, right = right, left ^ (wd.mix(right + key) & self.mask)
        return left << self.half | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1]:
            left, right = right ^ (wd.mix(left + key) & self.mask), left
        return left << self.half | right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        out = step(x.astype(U))
        while (beyond := np.flatnonzero(out >= U(self.n))).size:
            out[beyond] = step(out[beyond])
        return out.astype(np.int64)

    def slots(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, self._once)

    def indices(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self._back)


def sequences(docs: DataFrame, vocabulary: Vocabulary, length: int) -> DataFrame:
    """Sequences by task (``part``) and place in it, with the pieces of documents that they hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        part, place = TaskContext.get().partitionId(), 0
        open_ids, open_pieces = np.zeros(0, encode.kind), []

        def record(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64())]))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["part", "place", "ids", "n_ids", "pieces"])

        for batch in wd.slices(batches):
            rows = []
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids, start = encode.ids(text), 0
                while start < len(ids):
                    took = min(len(ids) - start, length - len(open_ids))
                    open_ids = np.concatenate((open_ids, ids[start : start + took]))
                    open_pieces.append({"doc_id": name, "start": start, "length": took})
                    start += took
                    if len(open_ids) == length:
                        rows.append((part, place, open_ids.tobytes(), length, open_pieces))
                        place, open_ids, open_pieces = place + 1, open_ids[:0], []
            if rows:
                yield record(rows)
        if len(open_ids):
            padded = np.full(length, END, encode.kind)
            padded[: len(open_ids)] = open_ids
            yield record([(part, place, padded.tobytes(), len(open_ids), open_pieces)])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SEQUENCES)


def _indexed(made: DataFrame, starts: DataFrame) -> DataFrame:
    # One row of two numbers per task.
    return made.join(F.broadcast(starts), "part").withColumn("index", F.col("first") + F.col("place")).drop("first", "part", "place")


def _slotted(indexed: DataFrame, permutation: Permutation) -> DataFrame:
    """``slot`` added."""
    shape = indexed.withColumn("slot", F.lit(0).cast("bigint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = permutation.slots(batch.column("index").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(slot)], names=shape.names)

    return indexed.mapInArrow(run, shape)


def _dealt(indexed: DataFrame, permutation: Permutation, per_shard: int, length: int, width: int) -> DataFrame:
    """``shard, slot, value`` with all records of a shard in one partition.

    Records cross the shuffle packed and compressed by task and shard. A shard has at most ``per_shard`` records, so
    unpacking one is a task of bounded size.
    """
    size = length * width

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            slot = permutation.slots(batch.column("index").to_numpy(zero_copy_only=False))
            ids = batch.column("ids")
            shard = slot // per_shard
            order = np.argsort(slot, kind="stable")
            starts = np.flatnonzero(np.diff(shard[order], prepend=-1))
            rows = []
            for a, b in zip(starts, np.append(starts[1:], len(order))):
                at = order[a:b]
                blob = b"".join([ids[int(i)].as_buffer().to_pybytes() for i in at])
                rows.append((int(shard[at[0]]), slot[at].tobytes(), squeeze.compress(blob)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.binary(), pa.binary()])], names=["shard", "slots", "packed"])

    def unpack(table: pa.Table) -> pa.Table:
        open_up = zstandard.ZstdDecompressor()
        slots, records = [], []
        for at, blob in zip(table.column("slots"), table.column("packed")):
            slots.append(np.frombuffer(at.as_buffer(), np.int64))
            records.append(np.frombuffer(open_up.decompress(blob.as_buffer().to_pybytes()), np.uint8).reshape(-1, size))
        slot, body = np.concatenate(slots), np.ascontiguousarray(np.concatenate(records))
        value = pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(slot), [None, pa.py_buffer(body)])
        shard = pa.array(np.full(len(slot), table.column("shard")[0].as_py(), np.int64))
        return pa.table({"shard": shard, "slot": pa.array(slot), "value": pc.cast(value, pa.binary())})

    packed = indexed.mapInArrow(pack, "shard bigint, slots binary, packed binary")
    return packed.groupBy("shard").applyInArrow(unpack, "shard bigint, slot bigint, value binary")


def stride_of(length: int, width: int) -> int:
    return length * width + 1


def write_training_order(
    docs: DataFrame, path: str, vocabulary: Vocabulary | None = None, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY
) -> int:
    """Write ``<path>/shards/shard=K/`` and ``<path>/manifest``; the number of sequences is returned."""
    vocabulary = vocabulary or Vocabulary.byte_bpe_50k()
    with small_batches(docs.sparkSession, size=BATCH_BYTES):  # not where records are dealt: larger batches pack better
        made = stage(sequences(docs, vocabulary, length), "sequences")
    # One row per task that wrote sequences, put in order on the cluster's side of a small sort.
    counts = made.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()
    starts, n = [], 0
    for row in counts:
        starts.append((row.part, n))
        n += row.n
    spark = docs.sparkSession
    first = spark.createDataFrame(starts, "part int, first bigint")
    order = Permutation(n, key)
    held = _slotted(_indexed(made.drop("ids"), first), order)
    held.select("slot", "index", "n_ids", "pieces").write.option("compression", "zstd").parquet(f"{path}/manifest")
    shards = max(1, -(-n // per_shard))
    dealt = _dealt(_indexed(made.select("part", "place", "ids"), first), order, per_shard, length, encoder(vocabulary).kind.itemsize)
    # The text sink writes bytes as they are; within a file records stand in the order of their slots.
    rows = dealt.sortWithinPartitions("shard", "slot").select("shard", F.col("value").cast("string").alias("value"))
    rows.write.partitionBy("shard").text(f"{path}/shards")
    return n


RECORDS = "slot bigint, shard bigint, byte_offset bigint, ids binary"


def read_training_order(spark: SparkSession, path: str, first_slot: int = 0, length: int = LENGTH, per_shard: int = PER_SHARD, width: int = 2) -> DataFrame:
    """``slot, shard, byte_offset, ids`` of all records from ``first_slot`` on; shards before it are not opened."""
    stride = stride_of(length, width)
    files = spark.read.format("binaryFile").load(f"{path}/shards")
    if "shard" not in files.columns:  # nothing was written
        return spark.createDataFrame([], RECORDS)
    files = files.filter(F.col("shard") >= first_slot // per_shard)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                raw = content.as_buffer()
                if len(raw) % stride:
                    raise ValueError(f"shard {shard} has {len(raw)} bytes, which is no multiple of {stride}")
                table = np.frombuffer(raw, np.uint8).reshape(-1, stride)
                slot = shard * per_shard + np.arange(len(table))
                from_here = np.flatnonzero(slot >= first_slot)
                for a in range(0, len(from_here), 1024):
                    at = from_here[a : a + 1024]
                    body = np.ascontiguousarray(table[at, : stride - 1])
                    ids = pa.FixedSizeBinaryArray.from_buffers(pa.binary(stride - 1), len(at), [None, pa.py_buffer(body)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slot[at]), pa.array(np.full(len(at), shard, np.int64)), pa.array(at * stride), pc.cast(ids, pa.binary())], names=["slot", "shard", "byte_offset", "ids"]
                    )

    return files.select(F.col("shard").cast("bigint").alias("shard"), "content").mapInArrow(run, RECORDS)


def digests(records: DataFrame, width: int = 2) -> DataFrame:
    """``ids_crc32`` over four-byte ids in place of the ids."""
    schema = "slot bigint, shard bigint, byte_offset bigint, ids_crc32 bigint"
    kind = f"<u{width}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = [zlib.crc32(np.frombuffer(x.as_buffer(), kind).astype("<u4").tobytes()) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], names=["slot", "shard", "byte_offset", "ids_crc32"])

    return records.mapInArrow(run, schema)
