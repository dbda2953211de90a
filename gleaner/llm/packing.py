"""Lexical retrieval packing.

Documents are tokenised, routed and packed into windows of ``length`` ids. Documents of one shard stand in a BM25 inverted
index over their token ids; document frequencies, their number and the mean length are those of all documents. A window
starts with a seed; the index returns the seed's best unused neighbours, which fill the window in that order. The
neighbour that does not fit is cut, its rest opens the next window and is that window's seed. So only the last window of
a task is padded.

Shards: a lexical route (most frequent id, then the smallest hash over three consecutive ids) puts near copies and texts of
one language next to each other; range partitions of (route, document) have equal sizes whatever the number of documents of a
route, and a task cuts its range into shards of at most ``shard_ids`` ids. The query of a seed are all its distinct ids.

Defined results: null text is empty; an empty text is its closing id. Every row of the input is a document of its own, also
with a repeated or null id. Ties of score go to the document that comes first in the shard. No documents give no rows.
Extra columns are ignored. A document has to fit a task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm import words as wd
from gleaner.llm.common import stage
from gleaner.llm.tokens import Vocabulary, encoder

LENGTH = 1024
K1, B = 1.2, 0.75
#: An id that stands in more than one of so many documents of a shard has a line of its own.
DENSE_SHARE = 16
#: Ids of a shard's documents; also about the ids of a task.
SHARD_IDS = 4 << 20

TOKENS = "doc_id bigint, route bigint, n bigint, ids binary"


def _route(ids: np.ndarray, found: np.ndarray, counts: np.ndarray) -> int:
    """``found`` are the document's different ids, ``counts`` how often each stands there, the closing id included."""
    often = int(found[(counts - (found == ids[-1])).argmax()]) if len(ids) > 1 else 0
    wide = ids.astype(np.uint64)
    least = int(wd.window_hashes(wide, min(3, len(ids))).min() >> np.uint64(33))
    return often << 31 | least


#: Route of the rows that hold a task's document frequencies instead of a document.
_FREQUENCIES = -1


def tokenised(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Documents with their ids, and per task a few rows of document frequencies, so that no second pass counts them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        total = np.zeros(own.size, np.int64)
        for part in wd.slices(batches):
            ids = [own.ids(t) for t in part.column("text").to_pylist()]
            routes = []
            for x in ids:
                found, counts = np.unique(x, return_counts=True)
                total[found] += 1
                routes.append(_route(x, found, counts))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(routes, pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
                names=["doc_id", "route", "n", "ids"],
            )
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([None], pa.int64()), pa.array([_FREQUENCIES], pa.int64()), pa.array([0], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["doc_id", "route", "n", "ids"]
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, TOKENS)


def document_frequencies(tokens: DataFrame, size: int) -> np.ndarray:
    """In how many documents each id stands. At most one row per id of the vocabulary reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for x in batch.column("ids"):
                total += np.frombuffer(x.as_buffer(), np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    counted = tokens.filter(F.col("route") == _FREQUENCIES).select("ids").mapInArrow(run, "id bigint, n bigint")
    rows = counted.groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return out


class Shard:
    """BM25 inverted index over the ids of some documents, with the statistics of all."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float) -> None:
        self.n = len(docs)
        terms, weights, owners, self.queries = [], [], [], []
        for i, ids in enumerate(docs):
            found, tf = np.unique(ids, return_counts=True)
            weight = idf[found] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / mean))
            terms.append(found)
            weights.append(weight.astype(np.float32))
            owners.append(np.full(len(found), i, np.int32))
            self.queries.append(found)
        terms = np.concatenate(terms)
        order = np.argsort(terms, kind="stable")
        self.owners, self.weights = np.concatenate(owners)[order], np.concatenate(weights)[order]
        self.at = np.searchsorted(terms[order], np.arange(len(idf) + 1))
        # Ids of many documents have a line of weights instead of a list.
        often = np.flatnonzero(np.diff(self.at) > max(16, self.n // DENSE_SHARE))
        self.line = np.full(len(idf), -1, np.int32)
        self.line[often] = np.arange(len(often))
        self.lines = np.zeros((len(often), self.n), np.float32)
        for line, t in enumerate(often.tolist()):
            a, b = self.at[t], self.at[t + 1]
            self.lines[line, self.owners[a:b]] = self.weights[a:b]
        #: The documents that still have scores, in order.
        self.live = np.arange(self.n)

    def keep(self, wanted: np.ndarray) -> None:
        """Go on with fewer documents: those of ``wanted``, a flag for each of the shard."""
        kept = wanted[self.live]
        place = np.cumsum(kept) - 1
        held = kept[self.owners]
        self.at = np.concatenate(([0], np.cumsum(held)))[self.at]
        self.owners, self.weights = place[self.owners[held]].astype(np.int32), self.weights[held]
        self.lines, self.live = np.ascontiguousarray(self.lines[:, kept]), self.live[kept]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 score of every live document of the shard for all terms of the seed."""
        asked = self.queries[seed]
        line = self.line[asked]
        out = self.lines[line[line >= 0]].sum(axis=0, dtype=np.float32)
        rare = asked[line < 0].astype(np.int64)
        a, n = self.at[rare], self.at[rare + 1] - self.at[rare]
        places = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return out + np.bincount(self.owners[places], weights=self.weights[places], minlength=len(self.live)).astype(np.float32)


class Packer:
    """Fills windows of one task; the open window goes on from shard to shard."""

    def __init__(self, length: int, first_sequence: int) -> None:
        self.length, self.sequence, self.offset = length, first_sequence, 0

    def place(self, size: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the pieces of a document of so many ids."""
        start = 0
        while start < size:
            took = min(size - start, self.length - self.offset)
            yield start, took, self.sequence, self.offset
            start += took
            self.offset += took
            if self.offset == self.length:
                self.sequence, self.offset = self.sequence + 1, 0

    def order(self, shard: Shard, sizes: list[int]) -> Iterator[tuple[int, list[tuple[int, int, int, int]]]]:
        """Documents of a shard in the order in which they are placed, with their pieces."""
        unused = np.ones(shard.n, bool)
        following = 0  # all before it are used
        seed, ranked = -1, iter(())
        for _ in range(shard.n):
            chosen = -1
            if self.offset and seed >= 0:
                chosen = next((d for d in ranked if unused[d]), -1)
            if chosen < 0:
                while not unused[following]:
                    following += 1
                chosen = following
            unused[chosen] = False
            window, opens = self.sequence, self.offset == 0
            pieces = list(self.place(sizes[chosen]))
            yield chosen, pieces
            if seed < 0 or opens or self.sequence != window:
                # What is open now was opened by this document.
                seed, ranked = chosen, self._neighbours(shard, chosen, unused) if self.offset else iter(())

    @staticmethod
    def _neighbours(shard: Shard, seed: int, unused: np.ndarray, most: int = 16) -> Iterator[int]:
        """Unused neighbours, the best first. Beyond the first few the whole list is ordered."""
        left = unused[shard.live]
        if 2 * np.count_nonzero(left) < len(left):
            shard.keep(unused)
            left = unused[shard.live]
        live = shard.live
        scores = np.where(left, shard.scores(seed), 0)
        if len(live) > 4 * most:
            edge = np.partition(scores, len(live) - most)[len(live) - most]
            top = np.flatnonzero(scores > edge)
            best = top[np.argsort(-scores[top], kind="stable")]
            yield from live[best[scores[best] > 0]].tolist()
            rest = np.flatnonzero((scores <= edge) & (scores > 0))
        else:
            rest = np.flatnonzero(scores > 0)
        yield from live[rest[np.argsort(-scores[rest], kind="stable")]].tolist()


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


def pack(
    docs: DataFrame, vocabulary: Vocabulary | None = None, length: int = LENGTH, shard_ids: int = SHARD_IDS, with_ids: bool = True
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``.

    ``ids`` are the piece's ids as unsigned little-endian integers (two bytes, four for vocabularies above 65,536);
    null without ``with_ids``. ``ids_crc32`` is taken over four-byte ids.
    """
    vocabulary = vocabulary or Vocabulary.byte_bpe_50k()
    own = encoder(vocabulary)
    kind, size = own.kind, own.size
    tokens = stage(tokenised(docs, vocabulary), "tokens")
    frequencies = document_frequencies(tokens, size)
    tokens = tokens.filter(F.col("route") != _FREQUENCIES)
    n_docs, n_ids = tokens.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    idf = np.log1p((n_docs - frequencies + 0.5) / (frequencies + 0.5))
    # One number per id of the vocabulary.
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    mean = n_ids / max(1, n_docs)
    tasks = max(1, -(-n_ids // shard_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(length, TaskContext.get().partitionId() << 40)
        names, arrays, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not arrays:
                return
            shard = Shard(arrays, shared.value, mean)
            rows = []
            for d, pieces in packer.order(shard, [len(x) for x in arrays]):
                for start, took, sequence, offset in pieces:
                    part = arrays[d][start : start + took]
                    rows.append((names[d], start, took, zlib.crc32(part.astype("<u4").tobytes()), len(arrays[d]), sequence, offset, part.tobytes() if with_ids else None))
            types = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[x.split()[0] for x in PIECES.split(", ")])

        for batch in batches:
            for name, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                ids = np.frombuffer(raw, kind)
                if arrays and held + len(ids) > shard_ids:
                    yield from flush()
                    names, arrays, held = [], [], 0
                names.append(name)
                arrays.append(ids)
                held += len(ids)
        yield from flush()

    routed = tokens.select("doc_id", "route", "ids").repartitionByRange(tasks, "route", "doc_id")
    return routed.sortWithinPartitions("route", "doc_id", "ids").select("doc_id", "ids").mapInArrow(run, PIECES)
