"""Fixed-size tables of marks about 64-bit hashes, counted exactly on the cluster.

Tasks send fingerprints of hashes (the leading bits say which range, 32 bits more are kept) packed by range; each range is
sorted and counted, and its part of the mark table is made where it was counted. The driver puts the parts together and
broadcasts the table, whose size is a constant of this module and does not grow with the data. Several hashes share a
slot, and a slot holds the largest of their marks. A user of the table therefore must be right under too large marks;
too many shared slots only cost work.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import stage

#: Slots of a table: one byte each, 32 MB.
SLOT_BITS = 25
#: Bytes of text for each range; a range's fingerprints are one task's work.
RANGE_BYTES = 96 << 20
#: Fingerprints that a task gathers before it sends them.
GATHERED = 1 << 20

U = np.uint64


def range_bits(docs: DataFrame, text: str = "text") -> int:
    """log2 of the number of ranges, from the bytes of text and the parallelism."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return max(int(-(-size // RANGE_BYTES)).bit_length(), (4 * cores).bit_length())


def send(values: np.ndarray, bits: int, flags: np.ndarray | None = None) -> pa.RecordBatch:
    """Fingerprints of hashes by range. With flags, the lowest bit of a fingerprint is the flag."""
    shown = (values >> U(32 - bits)).astype(np.uint64)
    if flags is not None:
        shown = (shown & ~U(1)) | flags.astype(np.uint64)
    shown.sort()
    ids = (shown >> U(32)).astype(np.int64)
    low = shown.astype(np.uint32)
    starts = np.flatnonzero(np.diff(ids, prepend=-1))
    ends = np.append(starts[1:], len(ids))
    parts = [low[a:b].tobytes() for a, b in zip(starts, ends)]
    return pa.RecordBatch.from_arrays([pa.array(ids[starts].astype(np.int32)), pa.array(parts, pa.binary())], names=["range", "prints"])


SENT = "range int, prints binary"


class Gatherer:
    """Collects hashes of slices and sends them in large pieces."""

    def __init__(self, bits: int) -> None:
        self.bits, self.values, self.flags, self.n = bits, [], [], 0

    def add(self, values: np.ndarray, flags: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        self.values.append(values)
        if flags is not None:
            self.flags.append(flags)
        self.n += len(values)
        if self.n >= GATHERED:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        values, flags, n = self.values, self.flags, self.n
        self.values, self.flags, self.n = [], [], 0
        if n:
            values, flags = np.concatenate(values), np.concatenate(flags) if flags else None
            yield send(values, self.bits, flags)


def levels_of_counts(prints: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """0 for a fingerprint seen once, then twice the binary logarithm of its count, at most 255."""
    return np.minimum(np.floor(2 * np.log2(counts)), 255).astype(np.uint8)


def flagged_and_repeated(prints: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """1 for a fingerprint that was seen twice or more, at least once with its flag."""
    return ((counts >= 2) & (np.add.reduceat(prints & 1, starts) > 0)).astype(np.uint8)


def mark_table(
    sent: DataFrame, bits: int, rule: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], flags: bool = False
) -> Broadcast:
    """The broadcast table of ``rule`` over all sent fingerprints."""
    slice_bits = max(0, SLOT_BITS - bits)

    def count(table: pa.Table) -> pa.Table:
        column = table.column("prints").combine_chunks()
        _, places, data = column.buffers()
        at = np.frombuffer(places, np.int32)[column.offset : column.offset + len(column) + 1]
        prints = np.frombuffer(data, np.uint32, (at[-1] - at[0]) // 4, at[0]).copy()
        prints.sort()
        named = prints >> 1 if flags else prints
        starts = np.flatnonzero(np.concatenate(([True], named[1:] != named[:-1])))
        counts = np.diff(np.append(starts, len(prints)))
        marks = rule(prints, starts, counts)
        slots = (prints[starts] >> (32 - slice_bits)).astype(np.int64) if slice_bits else np.zeros(len(starts), np.int64)
        made = np.zeros(1 << slice_bits, np.uint8)
        np.maximum.at(made, slots[marks > 0], marks[marks > 0])
        return pa.table({"range": table.column("range")[:1].combine_chunks(), "marks": pa.array([zlib.compress(made, 1)], pa.binary())})

    made = sent.groupBy("range").applyInArrow(count, "range int, marks binary")
    whole = np.zeros(1 << SLOT_BITS, np.uint8)
    # Written first, so that a lost driver connection or executor does not repeat the count; then read part by part. Parts are
    # packed until the driver's Python has them, since the JVM copies each row several times, and large arrays cost its heap most.
    for row in stage(made, "marks").toLocalIterator():
        part = np.frombuffer(zlib.decompress(row.marks), np.uint8)
        at = (row.range << slice_bits) if bits <= SLOT_BITS else row.range >> (bits - SLOT_BITS)
        np.maximum(whole[at : at + len(part)], part, out=whole[at : at + len(part)])
    return sent.sparkSession.sparkContext.broadcast(whole)


def look_up(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    return table[(values >> U(64 - SLOT_BITS)).astype(np.int64)]
