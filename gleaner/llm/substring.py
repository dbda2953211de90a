"""Removal of passages that stand in an earlier document, by fixed-block anchors.

A document's word blocks at places 0, b, 2b ... are its anchors. With windows of ``2b - 1`` words every window holds
exactly one anchor of its own document, and every shared window also holds an anchor of the other document.

1. Index and probe: every rolling block of b words of every document is sent with a flag that says whether it is an
   anchor. Where the two meet (an anchor and one more occurrence), the anchor is marked in a table of fixed size.
2. Extend: a marked anchor is extended to both sides, to the windows that hold it. They are compared exactly by a 64-bit
   hash of all their words, over all documents, and a window that also starts in a document with a smaller id is
   flagged. Windows next to each other join to the maximal repeat; their words are removed.

Windows that meet inside one task are decided there; only the first document of each window per task is sent on. So a
passage that stands in a third of all documents costs at most one entry per gathered piece, not per document.

Defined results: null text has no words and stays null; empty text stays empty. Windows are judged on the input. Rows with the
same document id are one document for the comparison, and each keeps or loses its own words. A null id is larger than any
other. Word case and marks count; what separates words does not. A text without removed words is kept as it is. Input columns
pass through unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm import marks
from gleaner.llm import words as wd
from gleaner.llm.common import fresh, stage

BLOCK = 7
U = np.uint64

_LATEST = (1 << 63) - 1


def _anchors(docs: DataFrame, bits: int, block: int) -> DataFrame:
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = marks.Gatherer(bits)
        for part in wd.slices(batches):
            cut = wd.words(part.column("text"))
            hashes = wd.window_hashes(cut.hash, block)
            ok = wd.within_text(cut, block)
            place = (np.arange(len(cut.hash)) - np.repeat(cut.first[:-1], cut.counts))[: len(hashes)]
            yield from out.add(hashes[ok], (place % block == 0)[ok])
        yield from out.flush()

    return docs.select("text").mapInArrow(blocks, marks.SENT)


class _Windows:
    """Candidate windows of a task: hash, row number and place; and the rows' keys."""

    def __init__(self) -> None:
        self.hash, self.row, self.place, self.docs, self.keys, self.rows, self.n = [], [], [], [], [], 0, 0

    def add(self, docs: np.ndarray, keys: np.ndarray, hashes: np.ndarray, rows: np.ndarray, places: np.ndarray) -> None:
        self.docs.append(docs)
        self.keys.append(keys)
        self.hash.append(hashes)
        self.row.append((rows + self.rows).astype(np.int32))
        self.place.append(places.astype(np.int32))
        self.rows += len(docs)
        self.n += len(hashes)


WINDOWS = "range int, hash binary, row binary, place binary, docs binary, keys binary"
FLAGGED = "key bigint, doc bigint, places binary"


def _decide(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of (hash, document) and, in that order, whether a smaller document has the same hash."""
    order = np.lexsort((docs, hashes))
    h, d = hashes[order], docs[order]
    new = np.concatenate(([True], h[1:] != h[:-1]))
    least = d[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))]
    return order, d > least


def _by_row(rows: np.ndarray, places: np.ndarray, docs: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((places, rows))
    rows, places = rows[order], places[order].astype(np.int32)
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    ends = np.append(starts[1:], len(rows))
    parts = [places[a:b].tobytes() for a, b in zip(starts, ends)]
    return pa.RecordBatch.from_arrays([pa.array(keys[rows[starts]]), pa.array(docs[rows[starts]]), pa.array(parts, pa.binary())], names=["key", "doc", "places"])


def _windows(docs: DataFrame, table, bits: int, block: int) -> DataFrame:
    """Windows around marked anchors: those decided in their task as flagged places, the others by range of their hash."""
    width = 2 * block - 1

    def flush(w: _Windows) -> Iterator[pa.RecordBatch]:
        if not w.n:
            return
        hashes, rows, places = np.concatenate(w.hash), np.concatenate(w.row), np.concatenate(w.place)
        docs, keys = np.concatenate(w.docs), np.concatenate(w.keys)
        order, later = _decide(hashes, docs[rows])
        done = order[later]
        none = pa.nulls
        if len(done):
            flagged = _by_row(rows[done], places[done], docs, keys)
            n = flagged.num_rows
            yield pa.RecordBatch.from_arrays(
                [none(n, pa.int32()), none(n, pa.binary()), none(n, pa.binary()), none(n, pa.binary()), none(n, pa.binary()), none(n, pa.binary()), *flagged.columns], names=names
            )
        rest = order[~later]  # in order of the hash
        ids = (hashes[rest] >> U(64 - bits)).astype(np.int64)
        starts = np.flatnonzero(np.diff(ids, prepend=-1))
        ends = np.append(starts[1:], len(ids))
        made = []
        for a, b in zip(starts, ends):
            at = rest[a:b]
            used, local = np.unique(rows[at], return_inverse=True)
            made.append((int(ids[a]), hashes[at].tobytes(), local.astype(np.int32).tobytes(), places[at].tobytes(), docs[used].tobytes(), keys[used].tobytes()))
        n = len(made)
        columns = [pa.array(c, t) for c, t in zip(zip(*made), [pa.int32()] + [pa.binary()] * 5)]
        yield pa.RecordBatch.from_arrays([*columns, none(n, pa.int64()), none(n, pa.int64()), none(n, pa.binary())], names=names)

    names = [x.split()[0] for x in f"{WINDOWS}, {FLAGGED}".split(", ")]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = _Windows()
        for part in wd.slices(batches):
            cut = wd.words(part.column("text"))
            hashes = wd.window_hashes(cut.hash, block)
            n = len(cut.hash) - width + 1
            if n <= 0:
                continue
            ok = wd.within_text(cut, width)
            row = wd.text_of_word(cut)[:n]
            place = np.arange(n) - cut.first[row]
            own = np.arange(n) + (-place) % block  # the anchor in the window
            at = np.flatnonzero(ok)
            at = at[marks.look_up(table.value, hashes[own[at]]) > 0]
            if len(at):
                whole = wd.window_hashes(cut.hash, width)
                docs_in = part.column("doc").to_numpy(zero_copy_only=False)
                keys_in = part.column("key").to_numpy(zero_copy_only=False)
                gathered.add(docs_in, keys_in, whole[at], row[at], place[at])
            if gathered.n >= marks.GATHERED:
                yield from flush(gathered)
                gathered = _Windows()
        yield from flush(gathered)

    return docs.mapInArrow(probe, f"{WINDOWS}, {FLAGGED}")


def _compare(table: pa.Table) -> pa.Table:
    """Flag, among all entries of a range, the windows that a smaller document has."""
    docs, keys, hashes, rows, places, base = [], [], [], [], [], 0
    read = lambda value, kind: np.frombuffer(value.as_buffer(), kind)
    for i in range(table.num_rows):
        own = read(table.column("docs")[i], np.int64)
        docs.append(own)
        keys.append(read(table.column("keys")[i], np.int64))
        hashes.append(read(table.column("hash")[i], np.uint64))
        rows.append(read(table.column("row")[i], np.int32) + base)
        places.append(read(table.column("place")[i], np.int32))
        base += len(own)
    docs, keys, rows, places = np.concatenate(docs), np.concatenate(keys), np.concatenate(rows), np.concatenate(places)
    order, later = _decide(np.concatenate(hashes), docs[rows])
    done = order[later]
    return pa.Table.from_batches([_by_row(rows[done], places[done], docs, keys)])


def flagged_windows(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``key, doc, places``: places of windows (4-byte integers) that also start in a smaller document.

    ``docs`` has ``doc`` (the id), ``key`` (a hash of the row) and ``text``. A document may have several rows here.
    """
    bits = marks.range_bits(docs)
    table = marks.mark_table(_anchors(docs, bits, block), bits, marks.flagged_and_repeated, flags=True)
    found = stage(_windows(docs, table, bits, block), "windows")
    decided = found.filter("range is null").select("key", "doc", "places")
    open_windows = found.filter("range is not null").select(*[x.split()[0] for x in WINDOWS.split(", ")])
    return decided.unionByName(open_windows.groupBy("range").applyInArrow(_compare, FLAGGED))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> tuple[DataFrame, dict[str, str]]:
    """All columns of ``docs``, the text replaced by the kept words (joined by a space) where words were removed.

    Three columns are added, named by the returned map: ``n_words``, ``n_removed`` and ``kept_sha256`` of the kept words.
    """
    width = 2 * block - 1
    own = fresh(docs, "doc", "key", "places", "n_words", "n_removed", "kept_sha256")
    latest = F.lit(_LATEST).cast("bigint")
    doc, key = F.coalesce(F.col(doc_id), latest), F.xxhash64(F.col(doc_id), F.col(text))
    flagged = flagged_windows(docs.select(doc.alias("doc"), key.alias("key"), F.col(text).alias("text")), block)
    per_row = flagged.groupBy("key", "doc").agg(F.collect_list("places").alias(own["places"])).withColumnsRenamed({"doc": own["doc"], "key": own["key"]})
    keyed = docs.withColumns({own["doc"]: doc, own["key"]: key})
    joined = keyed.join(per_row, [own["doc"], own["key"]], "left").select(*docs.columns, own["places"])
    shape = joined.drop(own["places"]).withColumns(
        {own["n_words"]: F.lit(0).cast("bigint"), own["n_removed"]: F.lit(0).cast("bigint"), own["kept_sha256"]: F.lit("")}
    ).schema

    columns_in, shape_names, places_name = docs.columns, shape.names, own["places"]

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wd.slices(batches, text):
            cut = wd.words(part.column(text))
            lists = part.column(places_name)
            texts, removed, digests = part.column(text).to_pylist(), [], []
            touched = lists.is_valid().to_pylist()
            for i in range(part.num_rows):
                a, b, base = int(cut.first[i]), int(cut.first[i + 1]), int(cut.text_at[i])
                raw = texts[i].encode() if texts[i] else b""
                start, end = (cut.start[a:b] - base), (cut.end[a:b] - base)
                gone = 0
                if touched[i]:
                    places = np.frombuffer(b"".join(lists[i].as_py()), np.int32)
                    change = np.zeros(b - a + 1, np.int32)
                    np.add.at(change, places, 1)
                    np.add.at(change, np.minimum(places + width, b - a), -1)
                    keep = np.cumsum(change)[:-1] == 0
                    gone = int(len(keep) - keep.sum())
                    start, end = start[keep], end[keep]
                kept = b" ".join([raw[s:e] for s, e in zip(start.tolist(), end.tolist())])
                digests.append(hashlib.sha256(kept).hexdigest())
                removed.append(gone)
                if gone:
                    texts[i] = kept.decode()
            columns = [part.column(name) for name in columns_in]
            columns[columns_in.index(text)] = pa.array(texts, part.column(text).type)
            columns += [pa.array(cut.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=shape_names)

    return joined.mapInArrow(cut_out, shape), own
