"""Language identification by word scores and Viterbi spans.

Learned from labelled documents: per language, smoothed frequencies of hashed character n-grams (bytes 1 to 4 with word
edges) of its words, and per script the languages that were seen in it.

A word's candidates are the languages of its script (by Unicode ranges); its score is the sum of its n-grams' log
probabilities. Viterbi with a switching penalty finds the best labelling of the whole text, word by word, so a mixed text
falls into spans of one language. The prediction is the language of most letters; the score is its share of them, times
the mean probability of its label in its spans' total against the best other language there (1 when no other is near).

The model is fitted on a bounded, documented sample of labelled rows (``per_language`` documents of each language, the smallest
hashes of their ids), whole texts; prediction covers every word of every text.

Defined results: a null text or one without letter is ``und`` with score 0. With no labelled document everything is ``und``.
Ties go to the language that sorts first. More than 32,767 languages are an error. A text of any length is labelled as a whole. Repeated rows are judged alike. No documents give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm import words as wd
from gleaner.llm.common import stage

SLOTS = 1 << 16
GRAMS = (1, 2, 3, 4)
#: Not above spark.sql.optimizer.windowGroupLimitThreshold, so that the sample is cut before the shuffle.
PER_LANGUAGE = 1000
SMOOTHING = 0.5
SWITCH = 12.0

UNKNOWN = "und"

#: First and last code point of the letters of a script. Fixed values of the Unicode standard.
SCRIPTS = [
    ("latin", 0x0041, 0x005A), ("latin", 0x0061, 0x007A), ("latin", 0x00C0, 0x024F), ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF), ("arabic", 0x0750, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF),
]
NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]
_SCRIPT = np.zeros(1 << 16, np.uint8)
for _name, _first, _last in SCRIPTS:
    _SCRIPT[_first : _last + 1] = NAMES.index(_name)
_SCRIPT[[0xD7, 0xF7]] = 0  # signs of multiplication and division

#: Words run between bytes that are neither ASCII letters nor part of a longer code point.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


class Model(NamedTuple):
    languages: list[str]
    scores: np.ndarray  #: (SLOTS, languages) log probabilities
    scripts: np.ndarray  #: (scripts, languages) whether the language was seen in the script


def script_of_words(cut: wd.Words) -> np.ndarray:
    """The script of the first letter of each word that has one, 0 else."""
    padded = np.concatenate((cut.data, np.zeros(3, np.uint8))).astype(np.int64)
    b0, b1, b2 = (padded[cut.start + k] for k in range(3))
    point = np.where(b0 < 0x80, b0, 0)
    point = np.where((b0 >= 0xC0) & (b0 < 0xE0), (b0 & 0x1F) << 6 | (b1 & 0x3F), point)
    point = np.where((b0 >= 0xE0) & (b0 < 0xF0), (b0 & 0x0F) << 12 | (b1 & 0x3F) << 6 | (b2 & 0x3F), point)
    out = _SCRIPT[point & 0xFFFF]
    for i in np.flatnonzero(out == 0).tolist():  # words that open with a sign
        letters = cut.data[cut.start[i] : cut.end[i]].tobytes().decode("utf-8", "replace")
        out[i] = next((s for c in letters if ord(c) < 1 << 16 and (s := _SCRIPT[ord(c)])), 0)
    return out


def gram_slots(cut: wd.Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: slots, and the number of the word of each slot. Words have an edge byte on both sides."""
    if not len(cut.start):
        return
    size = cut.end - cut.start + 2
    at = np.concatenate(([0], np.cumsum(size)))
    word = np.repeat(np.arange(len(size)), size)
    inner = np.arange(at[-1]) - at[word] - 1
    edged = np.zeros(at[-1], np.uint64)
    ok = (inner >= 0) & (inner < (size - 2)[word])
    edged[ok] = wd.LOWER[cut.data[(cut.start[word] + inner)[ok]]]
    for n in GRAMS:
        if len(edged) < n:
            return
        value = np.full(len(edged) - n + 1, n, np.uint64)
        for k in range(n):
            value = value * np.uint64(257) + edged[k : len(edged) - n + 1 + k]
        inside = word[: len(value)] == word[n - 1 :]
        yield (wd.mix(value)[inside] >> np.uint64(48)).astype(np.int64), word[: len(value)][inside]


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """The model of ``doc_id, text, lang`` rows. At most one row per language and slot or script reaches the driver."""
    known = labelled.filter("text is not null and lang is not null").select("doc_id", "lang")
    # First within 64 parts of each language, so that no task gets all documents of one.
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    for groups in (["lang", F.pmod(F.xxhash64("doc_id"), F.lit(64))], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
        known = known.withColumn("_r", rank).filter(F.col("_r") <= per_language).drop("_r")
    chosen = known.select("doc_id").distinct()
    sample = labelled.filter("text is not null and lang is not null").join(chosen, "doc_id", "left_semi").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for part in wd.slices(batches):
            cut = wd.words(part.column("text"), LETTERS)
            lang = part.column("lang").to_pylist()
            text = wd.text_of_word(cut)
            script = script_of_words(cut)
            grams = list(gram_slots(cut))
            names = np.array(lang, dtype=object)
            for name in set(lang):
                own = (names == name)[text]
                total = totals.setdefault(name, np.zeros(SLOTS + len(NAMES), np.int64))
                for slots, word in grams:
                    total[:SLOTS] += np.bincount(slots[own[word]], minlength=SLOTS)
                total[SLOTS:] += np.bincount(script[own], minlength=len(NAMES))
        for name, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), pa.array(used), pa.array(total[used])], names=["lang", "slot", "n"])

    counts = sample.mapInArrow(count, "lang string, slot bigint, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    rows = stage(counts, "language-counts").toPandas()
    languages = sorted(rows["lang"].unique())
    if len(languages) > np.iinfo(np.int16).max:
        raise ValueError("labels of words are 16 bits wide")
    table = np.zeros((SLOTS + len(NAMES), len(languages)))
    table[rows["slot"].to_numpy(dtype=np.int64), np.searchsorted(languages, rows["lang"].to_numpy(dtype=str)) if languages else []] = rows["n"]
    grams = table[:SLOTS] + SMOOTHING
    return Model(languages, np.log(grams / grams.sum(0)).astype(np.float32) if languages else grams, table[SLOTS:] > 0)


def word_scores(cut: wd.Words, model: Model) -> np.ndarray:
    """(words, languages): log probability of each word; a language that is not of its script is far below the others."""
    # A word is scored once per batch, however often it stands there.
    _, place, again = np.unique(cut.hash, return_index=True, return_inverse=True)
    cut = cut._replace(start=cut.start[place], end=cut.end[place])
    out = np.zeros((len(place), len(model.languages)), np.float32)
    for slots, word in gram_slots(cut):
        values = model.scores[slots]
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[starts]] += np.add.reduceat(values, starts, axis=0)
    script = script_of_words(cut)
    allowed = model.scripts[script]
    allowed[~allowed.any(1)] = True  # a script nobody was seen in tells nothing
    out[script == 0] = 0  # nor does a word without letter
    return np.where(allowed, out, out - np.float32(1e4))[again]


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """The best label of each word. ``first`` bounds the texts; all texts of a batch go forward step by step together."""
    counts = np.diff(first)
    labels = np.zeros(len(scores), np.int16)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    if not len(order):
        return labels
    at, lengths = first[:-1][order], counts[order]
    longest = int(lengths[0])
    # How many texts have a word at each step.
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")
    stay = np.empty(scores.shape, bool)
    best_before = np.empty(len(scores), np.int16)
    now = scores[at].copy()
    for t in range(1, longest):
        m = int(active[t])
        now = now[:m] if len(now) > m else now
        top = now.argmax(1)
        change = now[np.arange(m), top] - np.float32(switch)
        stays = now >= change[:, None]
        word = at[:m] + t
        stay[word] = stays
        best_before[word] = top
        now = np.where(stays, now, change[:, None]) + scores[word]
        # Only differences count; this keeps numbers small in long texts.
        now -= now.max(1, keepdims=True)
        ended = np.flatnonzero(lengths[:m] == t + 1)
        labels[word[ended]] = now[ended].argmax(1)
    single = lengths == 1
    labels[at[single]] = scores[at[single]].argmax(1)
    for t in range(longest - 1, 0, -1):
        word = at[: int(active[t])] + t
        label = labels[word]
        labels[word - 1] = np.where(stay[word, label], label, best_before[word])
    return labels


def _has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def spans_of(part: pa.RecordBatch, model: Model, switch: float) -> tuple[wd.Words, np.ndarray, np.ndarray]:
    cut = wd.words(part.column("text"), LETTERS)
    scores = word_scores(cut, model)
    return cut, scores, viterbi(scores, cut.first, switch)


def label_spans(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """``doc_id, spans``: for each text its runs of one language as (lang, first word, end word, letters' bytes)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id bigint, spans array<struct<lang:string,first:int,end:int,bytes:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        kind = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("end", pa.int32()), ("bytes", pa.int32())]))
        for part in wd.slices(batches):
            rows = [[] for _ in range(part.num_rows)]
            if model.languages:
                cut, _, labels = spans_of(part, model, switch)
                text = wd.text_of_word(cut)
                starts = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(labels, prepend=-1) != 0))
                for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(labels)]):
                    base = int(cut.first[text[a]])
                    rows[text[a]].append({"lang": model.languages[labels[a]], "first": a - base, "end": b - base, "bytes": int((cut.end[a:b] - cut.start[a:b]).sum())})
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def predict(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """``doc_id, lang_pred, score`` of every document."""
    # Languages times a fixed number of slots.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        width = len(model.languages)
        for part in wd.slices(batches):
            n = part.num_rows
            lang, score = [UNKNOWN] * n, np.zeros(n)
            if width:
                cut, scores, labels = spans_of(part, model, switch)
                text = wd.text_of_word(cut)
                size = (cut.end - cut.start).astype(float)
                letters = np.zeros((n, width))
                np.add.at(letters, (text, labels), size)
                totals = np.zeros((n, width))
                best = letters.argmax(1)
                own = labels == best[text]
                np.add.at(totals, text[own], scores[own])
                lead = totals - totals[np.arange(n), best][:, None]
                lead[np.arange(n), best] = -np.inf
                rival = lead.max(1) if width > 1 else np.full(n, -np.inf)
                sure = 1 / (1 + np.exp(np.clip(rival, -50, 50)))
                share = letters[np.arange(n), best] / np.maximum(letters.sum(1), 1)
                ascii_letters = np.add.reduceat(np.append(LETTERS[:128][np.minimum(cut.data, 127)] & (cut.data < 128), False), np.minimum(cut.text_at[:-1], len(cut.data))) > 0
                ascii_letters &= np.diff(cut.text_at) > 0
                for i in range(n):
                    if ascii_letters[i] or (letters[i].any() and _has_letter(part.column("text")[i].as_py())):
                        lang[i], score[i] = model.languages[best[i]], share[i] * sure[i]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")
