"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of the normalised test items. Document words stream through it; at each word it
knows the longest run of item words that ends there. A run of ``window`` words (or a whole shorter item) is an
occurrence: its words are hit and the items that hold it are named. Items are read in blocks of bounded size and every
block's automaton scans all documents in turn, adding to the spans found so far, so memory does not grow with the test
set. Only places where ``gram`` consecutive words stand in that order in some item reach the automaton; elsewhere
it would stand at its root, so leaving them out changes nothing.

Defined results: null, empty or wordless texts have no words and no hits; null, empty or wordless items have no window.
Repeated items are all named, repeated documents are judged one by one. No items: nothing is hit. Input columns pass
through unchanged whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm import words as wd
from gleaner.llm.common import fresh

WINDOW = 10
#: Bytes of item text whose automaton a worker holds at once.
BLOCK_BYTES = 4 << 20


class Automaton:
    """Generalised suffix automaton over sequences of integers."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.owners: list[set[int]] = [set()]

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.owners.append(set())
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def add(self, sequence: list[int], owner: int) -> None:
        last = 0
        for c in sequence:
            last = self.extend(last, c)
            self.owners[last].add(owner)

    def finish(self) -> None:
        """Hand the owners of each state on to the states of its suffixes."""
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.owners[self.link[s]] |= self.owners[s]

    def reach(self, sequence: list[int]) -> int:
        s = 0
        for c in sequence:
            s = self.next[s][c]
        return s


class Matcher:
    """Finds the windows of a block of items in documents."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        self.window = window
        cut = wd.words(pa.array([text for _, text in items], pa.large_string()), wd.LETTERED, lower=True)
        self.vocabulary = np.unique(cut.hash)
        codes = np.searchsorted(self.vocabulary, cut.hash)
        sequences = [(name, codes[a:b].tolist()) for (name, _), a, b in zip(items, cut.first, cut.first[1:]) if b > a]
        self.names = [name for name, _ in sequences]
        self.automaton = Automaton()
        for owner, (_, sequence) in enumerate(sequences):
            self.automaton.add(sequence, owner)
        self.automaton.finish()
        self.shortest = min([window, *(len(s) for _, s in sequences)])
        self.gram = min(3, self.shortest)
        grams = wd.window_hashes(cut.hash, self.gram)
        self.grams = np.unique(grams[wd.within_text(cut, self.gram)]) if len(grams) else grams
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.grams >> wd.U(44)).astype(np.int64)] = True
        self._places(sequences)

    def _places(self, sequences: list[tuple[str, list[int]]]) -> None:
        a = self.automaton
        whole: dict[int, list[tuple[int, int]]] = {}
        for owner, (_, sequence) in enumerate(sequences):
            if len(sequence) < self.window:
                whole.setdefault(a.reach(sequence), []).append((len(sequence), owner))
        #: per state: the state of its suffix of one window, and the short items among its suffixes
        self.at_window, self.short = [-1] * len(a.link), [()] * len(a.link)
        for s in sorted(range(1, len(a.link)), key=a.length.__getitem__):
            up = a.link[s]
            if a.length[s] >= self.window:
                self.at_window[s] = s if a.length[up] < self.window else self.at_window[up]
            self.short[s] = (*self.short[up], *whole.get(s, ()))

    def candidates(self, cut: wd.Words) -> Iterator[tuple[int, int]]:
        """Runs of words, inside one text, whose every gram stands in some item."""
        grams = wd.window_hashes(cut.hash, self.gram)
        if not len(grams) or not len(self.grams):
            return
        some = np.flatnonzero(self.maybe[(grams >> wd.U(44)).astype(np.int64)] & wd.within_text(cut, self.gram))
        at = np.minimum(np.searchsorted(self.grams, grams[some]), len(self.grams) - 1)
        some = some[self.grams[at] == grams[some]]
        if not len(some):
            return
        # A gram that crosses a text's end is out, so for grams of one word the text has to be compared.
        text = np.searchsorted(cut.first, some, side="right")
        breaks = np.flatnonzero((np.diff(some) != 1) | (np.diff(text) != 0)) + 1
        for a, b in zip([0, *breaks.tolist()], [*breaks.tolist(), len(some)]):
            low, high = int(some[a]), int(some[b - 1]) + self.gram
            if high - low >= self.shortest:
                yield low, high

    def matches(self, cut: wd.Words) -> dict[int, tuple[list[tuple[int, int]], set[int]]]:
        """Per text number: the spans of hit words (counted in the text) and the items."""
        found: dict[int, tuple[list[tuple[int, int]], set[int]]] = {}
        a = self.automaton
        step, link, length = a.next, a.link, a.length
        for low, high in self.candidates(cut):
            text = int(np.searchsorted(cut.first, low, side="right")) - 1
            base = int(cut.first[text])
            codes = np.searchsorted(self.vocabulary, cut.hash[low:high]).tolist()
            state, matched = 0, 0
            for place, c in enumerate(codes, low - base + 1):
                while state and c not in step[state]:
                    state = link[state]
                    matched = length[state]
                if c in step[state]:
                    state = step[state][c]
                    matched += 1
                if matched >= self.window:
                    spans, owners = found.setdefault(text, ([], set()))
                    spans.append((place - self.window, place))
                    owners |= a.owners[self.at_window[state]]
                for size, owner in self.short[state]:
                    if matched >= size:
                        spans, owners = found.setdefault(text, ([], set()))
                        spans.append((place - size, place))
                        owners.add(owner)
        return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _item_blocks(items: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Items with a text in blocks of about so many bytes. Only one block at a time is in the driver."""
    known = items.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).filter("t is not null")
    total = known.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for b in range(blocks):
        part = known.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b) if blocks > 1 else known
        yield [(row.i, row.t) for row in part.orderBy("i", "t").collect()]


def find_spans(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, dict[str, str]]:
    """All columns of ``docs`` and three more, named by the returned map: ``n_words``, ``spans`` of hit words, ``items``.

    Spans are disjoint, in order, counted in words of the text; ``items`` are item ids as strings, null if the id is null.
    """
    own = fresh(docs, "n_words", "spans", "items")
    n_words, spans_name, items_name = own["n_words"], own["spans"], own["items"]
    found = docs.withColumns(
        {
            n_words: F.lit(0).cast("bigint"),
            spans_name: F.array().cast("array<struct<a:int,b:int>>"),
            items_name: F.array().cast("array<string>"),
        }
    )
    context = docs.sparkSession.sparkContext
    for block in _item_blocks(items, item_id, item_text, block_bytes):
        shared = context.broadcast(block)

        def scan(batches, shared=shared):
            matcher = Matcher(shared.value, window)
            for part in wd.slices(batches, text):
                cut = wd.words(part.column(text), wd.LETTERED, lower=True)
                new = matcher.matches(cut)
                places = {name: part.schema.get_field_index(name) for name in (n_words, spans_name, items_name)}
                columns = list(part.columns)
                columns[places[n_words]] = pa.array(cut.counts, pa.int64())
                if new:
                    spans, names = columns[places[spans_name]].to_pylist(), columns[places[items_name]].to_pylist()
                    for row, (more, owners) in new.items():
                        had = [(s["a"], s["b"]) for s in spans[row]]
                        spans[row] = [{"a": a, "b": b} for a, b in merged([*had, *more])]
                        names[row] = [*names[row], *(matcher.names[o] for o in sorted(owners))]
                    columns[places[spans_name]] = pa.array(spans, part.schema.field(spans_name).type)
                    columns[places[items_name]] = pa.array(names, part.schema.field(items_name).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

        found = found.mapInArrow(scan, found.schema)
    return found, own


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda s, x: s + x["b"] - x["a"])


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    found, own = find_spans(docs.select("doc_id", "text"), items, window=window, block_bytes=block_bytes)
    names = F.sort_array(F.col(own["items"]))
    n_hit = hit_words(F.col(own["spans"]))
    return found.select(
        "doc_id",
        F.col(own["n_words"]).alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(names).cast("bigint").alias("n_items"),
        F.sha2(F.encode(F.array_join(names, ","), "UTF-8"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def remove_spans(
    docs: DataFrame, items: DataFrame, most_length: int = 0, most_coverage: float = 0.5,
    text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The same columns without hit spans of more than ``most_length`` words; documents of which more than a share
    ``most_coverage`` is hit go as a whole. The text between two spans is kept as it is, byte for byte."""
    found, own = find_spans(docs, items, text=text, window=window, block_bytes=block_bytes)
    spans, n_words = F.col(own["spans"]), F.col(own["n_words"])
    kept = found.filter(hit_words(spans) <= most_coverage * n_words)
    spans_name = own["spans"]

    def cut_out(batches):
        for part in wd.slices(batches, text):
            spans = part.column(spans_name).to_pylist()
            longer = [[s for s in row if s["b"] - s["a"] > most_length] for row in spans]
            if any(longer):
                cut = wd.words(part.column(text), wd.LETTERED, lower=True)
                texts = part.column(text).to_pylist()
                for row, gone in enumerate(longer):
                    if not gone:
                        continue
                    raw, at, base = texts[row].encode(), int(cut.text_at[row]), int(cut.first[row])
                    pieces, since = [], 0
                    for s in gone:
                        pieces.append(raw[since : int(cut.start[base + s["a"]]) - at])
                        since = int(cut.end[base + s["b"] - 1]) - at
                    texts[row] = b"".join([*pieces, raw[since:]]).decode()
                columns = list(part.columns)
                columns[part.schema.get_field_index(text)] = pa.array(texts, part.schema.field(text).type)
                part = pa.RecordBatch.from_arrays(columns, schema=part.schema)
            yield part

    return kept.mapInArrow(cut_out, kept.schema).select(*docs.columns)
