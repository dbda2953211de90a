"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learned, not given: words, and word beginnings of ``PREFIXES`` bytes, with the number of toxic and of clean training
documents that hold them. The weight of an entry is the log odds of the lower confidence bound of its share of toxic
documents, both classes counted as equally large; so a rare word weighs little. Words are compared in lower case
and with look-alike digits and signs read as letters (1d10t is idiot).

Features of a text: counts and densities of lexicon words in three tiers, of beginnings, of lexicon words near a second-person
word, of capitals, of exclamation and question marks, and of obfuscations (look-alikes within words, stretched letters,
spelled-out words); its largest weights and its length. Everything is taken from the whole text.

The training documents are dealt into folds by id. The trees learn from folds whose features come from a lexicon without that fold;
the calibration sees the last fold, which neither the lexicon nor the trees have seen. The model is fitted on a bounded,
documented sample (``PER_CLASS`` toxic and twice as many clean documents, the smallest hashes of their ids); lexicon
(``LEXICON`` entries), trees and calibration have a fixed size, so they may be broadcast.

Defined results: a null or empty text has no words and is scored like any other. A document without label is scored and never used for
fitting; labels other than 0 and 1 are ignored; a document with both labels, and one that stands in several rows, counts once for each.
Without labels of both classes in the folds of trees and calibration every score is the share of toxic labels (0 without
any). A null id is in no fold. Ties are scored alike. No documents give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm import words as wd
from gleaner.llm.common import stage

#: Training documents: so many toxic ones and twice as many clean ones at most.
PER_CLASS = 12_000
LEXICON = 4096
LEAST_DOCUMENTS = 3
PREFIXES = (4, 5, 6, 7)
TIERS = (0.5, 1.5, 2.5)
NEAR = 5
TREES, DEPTH, RATE, SEED = 20, 3, 0.3, 11

#: Folds by crc32 of the id mod 5: 0 is held out, 1 to 3 are for lexicon and trees, 4 is for calibration.
HELD_OUT, CALIBRATION, TREE_FOLDS = 0, 4, (1, 2, 3)

#: Second-person words of the languages at hand.
SECOND_PERSON = """you your yours yourself yourselves u ur
du dich dir dein deine deinen deinem deiner euch euer eure ihr
tu te toi ton ta tes vous votre vos
tú ti usted ustedes vosotros vosotras vuestro vuestra""".split()

#: Digits and signs that stand for letters.
LOOK_ALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

_READ = np.arange(256, dtype=np.uint8)
for _sign, _letter in LOOK_ALIKES.items():
    _READ[ord(_sign)] = ord(_letter)
_TOKEN = np.zeros(256, bool)
_TOKEN[0x30:0x3A] = _TOKEN[0x41:0x5B] = _TOKEN[0x61:0x7B] = _TOKEN[0x80:] = True
_LETTER = _TOKEN.copy()
_LETTER[0x30:0x3A] = False

FEATURES = [
    "length",
    *(f"{kind}_{i}" for i in range(len(TIERS)) for kind in ("hits", "density")),
    "largest", "distinct", "beginnings", "beginning_density", "largest_beginning",
    "near", "near_density", "second_person", "capitals", "shouted", "exclamations", "questions", "mark_runs",
    "look_alikes", "hidden_hits", "stretched", "spelled_out",
]


class Lexicon(NamedTuple):
    keys: np.ndarray  #: sorted
    weights: np.ndarray

    def weight(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(keys.shape)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.weights[at], 0.0)


class Tokens(NamedTuple):
    cut: wd.Words
    text: np.ndarray  #: the text of each word
    altered: np.ndarray  #: whether a word has look-alikes beside letters
    kind: np.ndarray  #: for each word its place among the different words
    keys: np.ndarray  #: (different words, 1 + prefixes); 0: no such beginning


def tokens(texts: pa.Array) -> Tokens:
    data, at = wd.buffers(pc.utf8_lower(pc.fill_null(texts, "")))
    read = _READ[data]
    cut = wd.words(pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(read)), _TOKEN)
    changed, letters = (np.concatenate(([0], np.cumsum(x))) for x in (read != data, _LETTER[data]))
    altered = (changed[cut.end] > changed[cut.start]) & (letters[cut.end] > letters[cut.start])
    _, place, kind = np.unique(cut.hash, return_index=True, return_inverse=True)
    start, size = cut.start[place], cut.end[place] - cut.start[place]
    padded = np.concatenate((read, np.zeros(max(PREFIXES), np.uint8))).astype(np.uint64)
    keys = [wd.mix(cut.hash[place] + wd.U(1))]
    for k in PREFIXES:
        value = np.full(len(start), k, np.uint64)
        for j in range(k):
            value = (value << wd.U(8)) | padded[start + j]
        keys.append(np.where(size > k, wd.mix(value), wd.U(0)))
    return Tokens(cut, wd.text_of_word(cut), altered, kind, np.stack(keys, axis=1) if len(start) else np.zeros((0, 1 + len(PREFIXES)), wd.U))


_YOU = np.sort(wd.words(pa.array(SECOND_PERSON), np.ones(256, bool)).hash)


def _runs(flags: np.ndarray, text: np.ndarray, least: int) -> np.ndarray:
    """Where ``least`` flags in a row of one text begin."""
    if len(flags) < least:
        return np.zeros(0, np.int64)
    n = len(flags) - least + 1
    held = flags[:n].copy()
    for j in range(1, least):
        held &= flags[j : j + n] & (text[:n] == text[j : j + n])
    return np.flatnonzero(held)


def features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """(texts, FEATURES)."""
    found = tokens(texts)
    n, cut, text = len(texts), found.cut, found.text
    words = np.maximum(cut.counts, 1)

    def count(places: np.ndarray) -> np.ndarray:
        return np.bincount(places, minlength=n).astype(float)

    by_kind = lexicon.weight(found.keys)
    whole, beginning = by_kind[:, 0][found.kind], by_kind[:, 1:].max(axis=1, initial=0)[found.kind]
    out = [np.log1p(cut.counts)]
    for tier in TIERS:
        hits = count(text[whole >= tier])
        out += [np.log1p(hits), 100 * hits / words]
    largest, largest_beginning = np.zeros(n), np.zeros(n)
    np.maximum.at(largest, text, whole)
    np.maximum.at(largest_beginning, text, beginning)
    strong = np.flatnonzero(np.maximum(whole, beginning) >= TIERS[1])
    different = np.unique(text[strong] * (len(by_kind) + 1) + found.kind[strong]) // (len(by_kind) + 1)
    begun = count(text[beginning >= TIERS[1]])
    out += [largest, np.log1p(count(different)), np.log1p(begun), 100 * begun / words, largest_beginning]

    you = np.flatnonzero(np.isin(cut.hash, _YOU))
    near = np.zeros(len(strong), bool)
    if len(you):
        at = np.searchsorted(you, strong)
        for other in (you[np.maximum(at - 1, 0)], you[np.minimum(at, len(you) - 1)]):
            near |= (np.abs(other - strong) <= NEAR) & (text[other] == text[strong])
    beside = count(text[strong[near]])
    out += [np.log1p(beside), 100 * beside / words, count(text[you]) / words]

    raw, at = wd.buffers(texts)
    owner = np.repeat(np.arange(n), np.diff(at))
    upper = (raw >= 0x41) & (raw <= 0x5A)
    letters = np.maximum(count(owner[_LETTER[raw]]), 1)
    out += [count(owner[upper]) / letters, count(owner[_runs(upper, owner, 2)]) / letters]
    marks = (raw == ord("!")) | (raw == ord("?"))
    out += [count(owner[raw == ord("!")]) / words, count(owner[raw == ord("?")]) / words, count(owner[_runs(marks, owner, 2)]) / words]

    hidden = count(text[found.altered & (np.maximum(whole, beginning) >= TIERS[0])])
    again = np.concatenate(([False], raw[1:] == raw[:-1])) & _LETTER[raw] & (raw < 0x80) if len(raw) else np.zeros(0, bool)
    single = cut.end - cut.start == 1
    out += [count(text[found.altered]) / words, np.log1p(hidden), count(owner[_runs(again, owner, 2)]) / words, count(text[_runs(single, text, 3)]) / words]
    return np.stack(out, axis=1)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``text, toxic, fold`` of the sample."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)").distinct()
    known = known.withColumn("fold", fold(F.col("doc_id"))).filter(F.col("fold") != HELD_OUT)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # First within 64 parts of each class, so that no task gets all labels of one.
    for groups in (["toxic", F.pmod(F.xxhash64("doc_id"), F.lit(64))], ["toxic"]):
        rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
        known = known.withColumn("_r", rank).filter(F.col("_r") <= F.when(F.col("toxic") == 1, per_class).otherwise(2 * per_class)).drop("_r")
    sample = stage(known.select(F.col("doc_id").alias("_id"), "toxic", "fold"), "toxic-sample")
    # At most three times ``per_class`` rows of a few bytes.
    return docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text").join(F.broadcast(sample), "_id").select("text", "toxic", "fold")


def count_entries(sample: DataFrame) -> DataFrame:
    """``key, n``: for each word and beginning the clean and toxic documents of each fold of the trees that hold it."""
    columns = 2 * len(TREE_FOLDS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in wd.slices(batches):
            found = tokens(part.column("text"))
            pairs = np.unique(np.stack([found.text, found.kind], axis=1), axis=0) if len(found.text) else np.zeros((0, 2), np.int64)
            slot = part.column("slot").to_numpy()[pairs[:, 0]]
            key = found.keys[pairs[:, 1]]
            # A beginning counts once for a document, however many words have it.
            doc = np.broadcast_to(pairs[:, :1], key.shape)
            kept = key != 0
            rows = np.unique(np.rec.fromarrays([key[kept], doc[kept], np.broadcast_to(slot[:, None], key.shape)[kept]], names="key,doc,slot"))
            groups = np.unique(np.rec.fromarrays([rows["key"], rows["slot"]], names="key,slot"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(groups[0]["key"].view(np.int64)), pa.array(groups[0]["slot"]), pa.array(groups[1])], names=["key", "slot", "n"])

    slots = sample.filter(F.col("fold") != CALIBRATION).select("text", ((F.col("fold") - 1) * 2 + F.col("toxic")).cast("bigint").alias("slot"))
    counted = slots.mapInArrow(count, "key bigint, slot bigint, n bigint")
    sums = [F.sum(F.when(F.col("slot") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(columns)]
    return counted.groupBy("key").agg(*sums)


def weigh(counts: DataFrame, documents: list[int], folds: tuple[int, ...], size: int = LEXICON) -> Lexicon:
    """The lexicon of some folds. ``documents`` has the number of documents of each slot."""

    def total(toxic: int) -> Column:
        return sum((F.col(f"n{(f - 1) * 2 + toxic}") for f in folds), F.lit(0))

    n_clean, n_toxic = (sum(documents[(f - 1) * 2 + t] for f in folds) for t in (0, 1))
    if not n_clean or not n_toxic:
        return Lexicon(np.zeros(0, wd.U), np.zeros(0))
    z = 1.96
    n = total(1) + total(0) * (n_toxic / n_clean)
    p = total(1) / n
    bound = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    weighed = counts.filter(total(1) >= LEAST_DOCUMENTS).select("key", F.log(bound / (1 - bound)).alias("weight")).filter(F.col("weight") > 0)
    rows = weighed.orderBy(F.desc("weight"), "key").limit(size).toPandas()
    keys = rows["key"].to_numpy(dtype=np.int64).view(wd.U)
    order = np.argsort(keys)
    return Lexicon(keys[order], rows["weight"].to_numpy(dtype=float)[order])


def measure(rows: DataFrame, lexicons: dict[int, Lexicon], keep: list[str]) -> DataFrame:
    """``keep`` and the features of each row, by the lexicon of its ``fold``; -1 is that of all other folds."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicons)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in wd.slices(batches):
            folds = part.column("_by").to_numpy()
            out = np.zeros((part.num_rows, len(FEATURES)))
            for f in np.unique(folds).tolist():
                mine = folds == f
                out[mine] = features(part.column("text").filter(pa.array(mine)), own.get(f, own[-1]))
            offsets = np.arange(0, out.size + 1, len(FEATURES), dtype=np.int32)
            columns = [part.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))], names=[*keep, "features"])

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", features array<double>"
    return rows.select(*keep, "text", F.col("fold").cast("int").alias("_by")).mapInArrow(run, schema)


class Model(NamedTuple):
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float  #: of toxic documents, the score where there are no trees


def _probability(trees: GBTClassificationModel, measured: DataFrame) -> DataFrame:
    placed = trees.transform(measured.withColumn("features", array_to_vector("features")))
    return placed.withColumn("p", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    sample = stage(training_rows(docs, labels, per_class), "toxic-training")
    tally = {(r["fold"], r["toxic"]): r["count"] for r in sample.groupBy("fold", "toxic").count().collect()}
    documents = [tally.get((f, t), 0) for f in TREE_FOLDS for t in (0, 1)]
    counts = stage(count_entries(sample), "toxic-entries")
    lexicon = weigh(counts, documents, TREE_FOLDS)
    without = {f: weigh(counts, documents, tuple(x for x in TREE_FOLDS if x != f)) for f in TREE_FOLDS}
    toxic = sum(n for (_, t), n in tally.items() if t == 1)
    share = toxic / max(1, sum(tally.values()))
    if not all(sum(documents[t::2]) and tally.get((CALIBRATION, t)) for t in (0, 1)):
        return Model(lexicon, None, None, share)
    measured = stage(measure(sample, without | {-1: lexicon}, ["toxic", "fold"]), "toxic-features")
    learner = GBTClassifier(featuresCol="features", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, maxBins=64, seed=SEED)
    trees = learner.fit(measured.filter(F.col("fold") != CALIBRATION).withColumn("features", array_to_vector("features")))
    scored = _probability(trees, measured.filter(F.col("fold") == CALIBRATION)).withColumn("toxic", F.col("toxic").cast("double"))
    calibration = IsotonicRegression(featuresCol="p", labelCol="toxic", predictionCol="score").fit(scored)
    return Model(lexicon, trees, calibration, share)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every document."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.lit(-1).alias("fold"))
    if model.trees is None:
        return rows.select("doc_id", F.lit(model.share).alias("score"))
    scored = _probability(model.trees, measure(rows, {-1: model.lexicon}, ["doc_id"]))
    return model.calibration.transform(scored).select("doc_id", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))
