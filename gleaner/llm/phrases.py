"""Phrase collocation mining over FM-indexes of word ids.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends and into words. A shard is a run of documents of about
``shard_words`` words; its word ids (one per language and word; pieces end with 0) have an FM-index: the Burrows-Wheeler
transforms of the id sequence and of its reverse, each with the suffixes in the order of their first ``DEPTH`` ids, which is all
that intervals of phrases up to that length need. Phrases are enumerated by extending intervals of both indexes at once, by
a word on the right (read off the transform of the reverse) or on the left (off the other one); an interval's size is
the phrase's count. An index lives in its task only; there are two passes, whose shards need not be the same:

1. words and pairs of words go out as 64-bit hashes with their counts. Those that reach the threshold over all shards fill a
   Bloom filter, sized by their number.
2. phrases up to ``DEPTH`` words whose words and neighbouring pairs are all in the filter go out as text, and their counts
   are summed. Every phrase that reaches the threshold is among them, in every shard, since its parts are at least
   as frequent: neither a shared hash nor a false positive of the filter can lose a phrase or change a count, and
   what they let through falls below the threshold in the sum.

Both sums combine within the task before they shuffle, so a frequent phrase is one row a task. Cutting a candidate into two
parts, the scores and the drops are joins on the few phrases that reach the threshold. A phrase lies in a longer candidate exactly
if it lies in one with one word more, since the phrases between them are at least as frequent as the longer one.

Defined results: a null text is empty, a null language is ``und``. Repeated rows and rows with a null or repeated id count one by
one. Ties go as stated at ``top_phrases``. No documents, and no phrase above the threshold, give no rows. Extra columns are
ignored. A text of any length is one document of a shard; a document has to fit a task. Within a shard two words are told
apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm import words as wd
from gleaner.llm.common import stage

DEPTH = 4
LEAST_COUNT = 30
DROP_PERCENT = 80
TOP = 2000
UNKNOWN = "und"
SHARD_WORDS = 1 << 19

#: Bits of the filter per frequent word or pair, and the largest filter. Beyond it false positives only make more rows to sum.
BITS_PER_KEY, MOST_BITS = 12, 1 << 29
_PAGE_BITS = 16
_PROBES = 3

#: Bytes that end a piece, and bytes of words: [^\x20\x09] within pieces.
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".,;:!?"]] = ENDS[0x0A:0x0E] = True
WORD = ~ENDS
WORD[[0x20, 0x09]] = False


def order_of(key: np.ndarray) -> np.ndarray:
    """A stable argsort of small whole numbers: key and place are sorted as one number, which is several times faster."""
    bits = max(1, len(key).bit_length())
    if int(key.max(initial=0)).bit_length() + bits > 63:
        return np.argsort(key, kind="stable")
    return np.sort((key.astype(np.int64) << bits) | np.arange(len(key))) & ((1 << bits) - 1)


class Transform(NamedTuple):
    """A Burrows-Wheeler transform: the symbol before each suffix, and the place of the suffix that starts with it."""

    symbol: np.ndarray
    step: np.ndarray

    @staticmethod
    def of(symbol: np.ndarray) -> Transform:
        step = np.empty(len(symbol), np.int64)
        step[order_of(symbol)] = np.arange(len(symbol))
        return Transform(symbol, step)


def transform_of(ids: np.ndarray) -> np.ndarray:
    """The symbols before the suffixes of a cyclic sequence, with the suffixes sorted by their first ``DEPTH`` (4) symbols."""
    n = len(ids)
    # Two doublings: symbols, pairs, fours.
    pairs = ids.astype(np.int64) * (int(ids.max(initial=0)) + 1) + np.roll(ids, -1)
    order = order_of(pairs)
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.diff(pairs[order], prepend=-1) != 0)
    order = order_of(rank * (n + 1) + np.roll(rank, -2))
    return ids[order - 1]


class Phrases(NamedTuple):
    """Phrases of one length: their words, and their intervals in the index and in that of the reverse."""

    words: np.ndarray  #: (phrases, length)
    low: np.ndarray
    reverse_low: np.ndarray
    count: np.ndarray


class Index:
    """The index of an id sequence. A direction is built when it is first asked for."""

    def __init__(self, ids: np.ndarray, n_words: int):
        self.ids = ids
        self.first = np.concatenate(([0], np.cumsum(np.bincount(ids, minlength=n_words + 1))))

    @cached_property
    def forward(self) -> Transform:
        return Transform.of(transform_of(self.ids))

    @cached_property
    def backward(self) -> Transform:
        return Transform.of(transform_of(self.ids[::-1]))

    def single(self) -> Phrases:
        """All words; id 0 ends pieces and is none."""
        low = self.first[1:-1]
        return Phrases(np.arange(1, len(self.first) - 1)[:, None], low, low, np.diff(self.first)[1:])

    def right(self, found: Phrases) -> Phrases:
        """All phrases with one word more on the right."""
        at, word, low, other, count = _extend(self.backward, found.reverse_low, found.low, found.count)
        return Phrases(np.hstack([found.words[at], word[:, None]]), other, low, count)

    def left(self, found: Phrases) -> Phrases:
        """All phrases with one word more on the left."""
        at, word, low, other, count = _extend(self.forward, found.low, found.reverse_low, found.count)
        return Phrases(np.hstack([word[:, None], found.words[at]]), low, other, count)


def _extend(transform: Transform, low: np.ndarray, other: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each interval and each symbol in it: interval, symbol, its interval in this and in the other index, and its size."""
    total = int(count.sum())
    which = np.repeat(np.arange(len(count)), count)
    place = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    symbol = transform.symbol[place].astype(np.int64)
    order = order_of(which * (int(symbol.max(initial=0)) + 1) + symbol)
    which, symbol, place = which[order], symbol[order], place[order]
    starts = np.flatnonzero((np.diff(which, prepend=-1) != 0) | (np.diff(symbol, prepend=-1) != 0))
    size = np.diff(np.append(starts, total))
    at = which[starts]
    # Smaller symbols of the same interval come before in the other index.
    before = starts - (np.cumsum(count) - count)[at]
    kept = symbol[starts] > 0
    starts, at = starts[kept], at[kept]
    return at, symbol[starts], transform.step[place[starts]], other[at] + before[kept], size[kept]


def _sequence(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, pa.Array, np.ndarray, list[str]]:
    """Ids of the texts of some batches, the words by id - 1, the language of each, and the languages."""
    langs: dict[str, int] = {}
    hashes, strings, owners, gaps = [], [], [], []
    for batch in batches:
        cut = wd.words(batch.column("text"), WORD, lower=True)
        of_text = np.array([langs.setdefault(x, len(langs)) for x in batch.column("lang").to_pylist()], np.int64)
        text = wd.text_of_word(cut)
        if not len(text):
            continue
        ends = np.concatenate(([0], np.cumsum(ENDS[cut.data])))[cut.start]
        last = np.ones(len(text), bool)
        last[:-1] = (ends[1:] != ends[:-1]) | (text[1:] != text[:-1])
        own = of_text[text]
        key = wd.mix(cut.hash + own.astype(wd.U) * wd.U(0x9E3779B97F4A7C15))
        different, place, again = np.unique(key, return_index=True, return_inverse=True)
        hashes.append((different, again))
        gaps.append(last)
        owners.append(own[place])
        strings.append(_strings(cut, place))
    if not hashes:
        return np.zeros(0, np.int32), pa.array([], pa.string()), np.zeros(0, np.int64), list(langs)
    names, place = np.unique(np.concatenate([x for x, _ in hashes]), return_index=True)
    number = np.concatenate([np.searchsorted(names, different)[again] for different, again in hashes]) + 1
    last = np.concatenate(gaps)
    # A word of the sequence, and a 0 after the last word of a piece.
    ids = np.zeros(len(number) + int(last.sum()), np.int32)
    ids[np.arange(len(number)) + np.cumsum(last) - last] = number
    return ids, pa.concat_arrays(strings).take(pa.array(place)), np.concatenate(owners)[place], list(langs)


def _strings(cut: wd.Words, place: np.ndarray) -> pa.Array:
    size = cut.end[place] - cut.start[place]
    offsets = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(offsets[-1]) + np.repeat(cut.start[place] - offsets[:-1], size)
    return pa.LargeStringArray.from_buffers(len(place), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(cut.data[at])).cast(pa.string())


def _shards(batches: Iterator[pa.RecordBatch], shard_words: int) -> Iterator[tuple[Index, pa.Array, np.ndarray, np.ndarray, list[str]]]:
    """For each shard its index, words, the hash and the language of each word, and the languages."""

    def shard(held: list[pa.RecordBatch]) -> tuple[Index, pa.Array, np.ndarray, np.ndarray, list[str]]:
        ids, names, lang_of, langs = _sequence(held)
        cut = wd.words(names, np.ones(256, bool))
        tongue = wd.words(pa.array(langs, pa.string()), np.ones(256, bool))
        own = np.zeros(len(langs), wd.U)
        own[wd.text_of_word(tongue)] = tongue.hash  # an empty name has no word
        return Index(ids, len(names)), names, wd.mix(cut.hash + own[lang_of] * wd._STEP), lang_of, langs

    held, size = [], 0
    for part in wd.slices(batches):
        held.append(part)
        size += part.column("text").nbytes // 6  # about a word
        if size >= shard_words:
            yield shard(held)
            held, size = [], 0
    if held:
        yield shard(held)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return wd.mix((a ^ (a >> wd.U(31))) * wd._STEP + b)


def _frequent_hashes(texts: DataFrame, least: int, shard_words: int) -> DataFrame:
    """(h) of the words and pairs that may reach the threshold: a shared hash can only add to a count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index, _, hashes, _, _ in _shards(batches, shard_words):
            single = index.single()
            pairs = index.right(single)
            key = np.concatenate([hashes, _pair(*hashes[pairs.words.T - 1])])
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.concatenate([single.count, pairs.count]))], names=["h", "n"])

    return texts.mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("h")


def _bits(h: np.ndarray, size: int) -> np.ndarray:
    """(_PROBES, keys) places in the filter."""
    a, b = h & wd.U(0xFFFFFFFF), (h >> wd.U(32)) | wd.U(1)
    return np.stack([(a + wd.U(i) * b) % wd.U(size) for i in range(_PROBES)])


def _bloom(keys: DataFrame, most_bits: int = MOST_BITS) -> np.ndarray:
    """A Bloom filter over the keys, of at most ``most_bits`` bits. It is put together page by page on the cluster."""
    size = min(most_bits, max(1 << 10, keys.count() * BITS_PER_KEY))
    size += -size % 8

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_bits(batch.column(0).to_numpy().view(wd.U), size)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> _PAGE_BITS), pa.array((at & ((1 << _PAGE_BITS) - 1)).astype(np.int32))], names=["page", "bit"])

    # Its bits are distinct, so a page has at most 2 ** _PAGE_BITS rows.
    distinct = keys.mapInArrow(places, "page bigint, bit int").distinct()

    def page(table: pa.Table) -> pa.Table:
        own = np.zeros(1 << _PAGE_BITS, bool)
        own[table["bit"].to_numpy()] = True
        packed = np.packbits(own)
        return pa.table({"page": [table["page"][0].as_py()], "bits": pa.array([packed.tobytes()], pa.binary())})

    out = np.zeros(-(-size // (1 << _PAGE_BITS)) << (_PAGE_BITS - 3), np.uint8)
    for row in distinct.groupBy("page").applyInArrow(page, "page bigint, bits binary").collect():
        start = row.page << (_PAGE_BITS - 3)
        out[start : start + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return out[: size // 8]


def _held(bloom: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = _bits(h, len(bloom) * 8).astype(np.int64)
    return ((bloom[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)


def count_phrases(docs: DataFrame, least: int = LEAST_COUNT, shard_words: int = SHARD_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """``lang, n_words, phrase, f`` of the phrases of 1 to ``DEPTH`` words with f >= least; n_words 0: all words of the language."""
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    keys = stage(_frequent_hashes(texts, least, shard_words), "frequent-hashes")
    shared = docs.sparkSession.sparkContext.broadcast(_bloom(keys, most_bits))

    def enumerate_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = shared.value
        for index, names, hashes, lang_of, langs in _shards(batches, shard_words):
            tongues = pa.array(langs, pa.string())

            def rows(found: Phrases) -> pa.RecordBatch:
                parts = [names.take(pa.array(found.words[:, i] - 1)) for i in range(found.words.shape[1])]
                text = pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]
                lang = tongues.take(pa.array(lang_of[found.words[:, 0] - 1]))
                length = pa.array(np.full(len(found.count), len(parts), np.int32))
                return pa.RecordBatch.from_arrays([lang, length, text, pa.array(found.count)], names=["lang", "n_words", "phrase", "n"])

            def some(found: Phrases, kept: np.ndarray) -> Phrases:
                return Phrases(*[x[kept] for x in found])

            def joined(found: Phrases, a: int, b: int) -> Phrases:
                return some(found, _held(bloom, _pair(hashes[found.words[:, a] - 1], hashes[found.words[:, b] - 1])))

            single = index.single()
            totals = np.bincount(lang_of, weights=single.count, minlength=len(langs)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [tongues, pa.array(np.zeros(len(langs), np.int32)), pa.array([""] * len(langs), pa.string()), pa.array(totals)], names=["lang", "n_words", "phrase", "n"]
            )
            single = some(single, _held(bloom, hashes))
            yield rows(single)
            two = joined(index.right(single), 0, 1)
            yield rows(two)
            three = joined(index.right(two), 1, 2)
            yield rows(three)
            yield rows(joined(index.left(three), 0, 1))

    counted = texts.mapInArrow(enumerate_phrases, "lang string, n_words int, phrase string, n bigint")
    summed = counted.groupBy("lang", "n_words", "phrase").agg(F.sum("n").alias("f"))
    written = stage(summed.filter((F.col("f") >= least) | (F.col("n_words") == 0)), "phrases")
    shared.destroy()
    return written


def _part(words: Column, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def score_phrases(counts: DataFrame, drop_percent: int = DROP_PERCENT) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the candidates that lie in no longer one with ``drop_percent`` of their count."""
    candidates = counts.filter("n_words >= 2").select("lang", "phrase", "n_words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    parts = counts.filter("n_words between 1 and 3")
    cuts = candidates.select("lang", "phrase", "a", "w", "n_words", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.col("w"), 1, F.col("k")).alias("head"), _part(F.col("w"), F.col("k") + 1, F.col("n_words") - F.col("k")).alias("rest"))
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
    score = F.expr("cast(a as decimal(38, 0)) * 2000000 div (l + r)")
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "l", "r", "a")).alias("s"))
    longer = candidates.filter("n_words >= 3")
    inner = longer.select("lang", F.col("a").alias("longer"), F.explode(F.array(_part(F.col("w"), 1, F.col("n_words") - 1), _part(F.col("w"), 2, F.col("n_words") - 1))).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.select("lang", "phrase", "s.*").join(inner, ["lang", "phrase"], "left")
    inside = F.col("longer").cast("decimal(38,0)") * 100 >= F.col("a").cast("decimal(38,0)") * drop_percent
    return kept.filter(F.col("longer").isNull() | ~inside).select("lang", "phrase", "a", "l", "r", "score")


def top_phrases(docs: DataFrame, top: int = TOP, least: int = LEAST_COUNT, drop_percent: int = DROP_PERCENT, shard_words: int = SHARD_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first phrases by score and count descending, then phrase."""
    counts = count_phrases(docs, least, shard_words, most_bits)
    best = score_phrases(counts, drop_percent)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # First within 64 parts of each language, so that no task sorts all phrases of one.
    for groups in (["lang", F.pmod(F.xxhash64("phrase"), F.lit(64))], ["lang"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).filter(F.col("rank") <= top)
    totals = counts.filter("n_words = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
