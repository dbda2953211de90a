"""Toxicity: features against a plain version, lexicon counts, held-out accuracy, and odd rows."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleaner.llm import toxicity as tox
from gleaner.llm import words as wd
from gleaner.llm.queries import REGISTERED
from gleaner.session import ship_package

READ = str.maketrans(tox.LOOK_ALIKES)
TOKEN = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")


def plain_tokens(text):
    low = (text or "").lower()
    return [(m.group(), low[m.start() : m.end()]) for m in TOKEN.finditer(low.translate(READ))]


def plain_features(text, entries):
    """``entries``: weight of words and of (beginning,) bytes."""
    found = plain_tokens(text)
    words, n = [w for w, _ in found], max(1, len(found))
    whole = [entries.get(w, 0) for w in words]
    begin = [max([entries.get((w.encode()[:k],), 0) for k in tox.PREFIXES if len(w.encode()) > k] or [0]) for w in words]
    altered = [w != raw and re.search(r"[^\W\d_]", raw) is not None for w, raw in found]
    out = [math.log1p(len(words))]
    for t in tox.TIERS:
        h = sum(x >= t for x in whole)
        out += [math.log1p(h), 100 * h / n]
    strong = [i for i in range(len(words)) if max(whole[i], begin[i]) >= tox.TIERS[1]]
    begun = sum(x >= tox.TIERS[1] for x in begin)
    out += [max(whole, default=0), math.log1p(len({words[i] for i in strong})), math.log1p(begun), 100 * begun / n, max(begin, default=0)]
    you = [i for i, w in enumerate(words) if w in tox.SECOND_PERSON]
    near = sum(any(abs(i - j) <= tox.NEAR for j in you) for i in strong)
    out += [math.log1p(near), 100 * near / n, len(you) / n]
    raw = (text or "").encode()
    letters = max(1, sum(b >= 0x80 or chr(b).isalpha() for b in raw))
    upper = [65 <= b <= 90 for b in raw]
    out += [sum(upper) / letters, sum(a and b for a, b in zip(upper, upper[1:])) / letters]
    out += [raw.count(b"!") / n, raw.count(b"?") / n, sum(a in b"!?" and b in b"!?" for a, b in zip(raw, raw[1:])) / n]
    stretched = sum(a == b == c and chr(a).isalpha() and a < 128 for a, b, c in zip(raw, raw[1:], raw[2:]))
    single = [len(w.encode()) == 1 for w in words]
    hidden = sum(a and max(x, y) >= tox.TIERS[0] for a, x, y in zip(altered, whole, begin))
    return out + [sum(altered) / n, math.log1p(hidden), stretched / n, sum(map(all, zip(single, single[1:], single[2:]))) / n]


TEXTS = [
    None, "", "!!??", "You are an IDIOT, an 1d10t!! idiots and idiotic", "i d i o t you", "Sooo stupid STUPID st00pid 2013 $5 a@b", "vous êtes réeuxment Réeuxou, ÉAUX",
    "clown you a b c d e clown", "plain text " * 500, "x" * 200_000, "é" * 5, "Du Idiot? Nein!", "idiot\nidiot\tyou", "漢字 漢字 you idiot",
]


def test_features_by_a_plain_version():
    entries = {"idiot": 2.0, "stupid": 0.7, "stoopid": 3.0, "clown": 1.6, "idiots": 1.0, (b"idio",): 1.8, (b"idiot",): 0.4, ("réeux".encode(),): 2.2}
    keys, weights = [], []
    for entry, weight in entries.items():
        if isinstance(entry, str):
            keys.append(int(wd.mix(wd.words(pa.array([entry]), np.ones(256, bool)).hash + wd.U(1))[0]))
        else:
            value = len(entry[0])
            for b in entry[0]:
                value = ((value << 8) | b) & ((1 << 64) - 1)
            keys.append(int(wd.mix(np.array([value], wd.U))[0]))
        weights.append(weight)
    order = np.argsort(np.array(keys, wd.U))
    lexicon = tox.Lexicon(np.array(keys, wd.U)[order], np.array(weights)[order])
    got = tox.features(pa.array(TEXTS, pa.string()), lexicon)
    assert got.shape == (len(TEXTS), len(tox.FEATURES))
    for row, text in zip(got, TEXTS):
        np.testing.assert_allclose(row, plain_features(text, entries), atol=1e-9, err_msg=str(text)[:60])
    assert tox.features(pa.array([], pa.string()), lexicon).shape == (0, len(tox.FEATURES))
    # texts of a slice do not mix
    np.testing.assert_allclose(tox.features(pa.array(TEXTS[3:6] * 2), lexicon)[4], got[4])


def test_entries_by_plain_counts(spark):
    ship_package(spark)
    texts = ["idiot idiots idiot", "1d10t other", "other words idiotic", "", "idiot", None]
    rows = [(t, i % 2, 1 + i % 3) for i, t in enumerate(texts)] + [("idiot", 1, tox.CALIBRATION)]
    got = {r.key: [r[f"n{i}"] for i in range(6)] for r in tox.count_entries(spark.createDataFrame(rows, "text string, toxic int, fold int")).collect()}
    want = {}
    for text, toxic, fold in rows[:-1]:
        words = {w for w, _ in plain_tokens(text)}
        for entry in words | {w.encode()[:k] for w in words for k in tox.PREFIXES if len(w.encode()) > k}:
            want.setdefault(entry, [0] * 6)[(fold - 1) * 2 + toxic] += 1
    assert sorted(got.values()) == sorted(want.values())


def test_held_out_accuracy(spark):
    """On documents that the model never saw: the order of scores, and the verdicts."""
    folder = "/root/testdata/sf0.1"
    got = REGISTERED["op13_toxicity"](spark, folder).toPandas()
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id) and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.5)).all()
    judged = got[got.held_out].merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    a, b = (judged.score[judged.toxic == t].to_numpy() for t in (1, 0))
    auc = (a[:, None] > b[None]).mean() + (a[:, None] == b[None]).mean() / 2
    assert auc > 0.97 and judged.predicted[judged.toxic == 0].mean() < 0.01 and judged.predicted[judged.toxic == 1].mean() > 0.75


@pytest.mark.parametrize("labelled", [0, 1, 2])
def test_odd_rows(spark, labelled):
    """Without labels, with one class, and with few of both; null ids, repeats, clashing columns."""
    ship_package(spark)
    toxic = "you utter numpty, what a numpty"
    data = [(i, (toxic if i % 3 == 0 else "kind words about you") + " and more" * (i % 7), 0.5, "x") for i in range(300)]
    data += [(None, toxic, 1.0, None), (7, None, 1.0, None), (9, "", None, None), (9, "", None, None)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, score double, features string")
    labels = [[], [(i, 0) for i in range(300)], [(i, int(i % 3 == 0)) for i in range(300)] + [(1, 2), (None, 1), (3, None), (6, 1), (6, 1)]][labelled]
    model = tox.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    got = tox.predict(docs, model).toPandas()
    assert len(got) == len(data) and got.score.between(0, 1).all()
    if labelled < 2:
        assert (got.score == 0).all()
    else:
        assert got[got.doc_id.isna()].score.iloc[0] > 0.5 and (got[(got.doc_id % 3 == 1) & (got.doc_id != 7)].score < 0.5).all()
    assert tox.predict(docs.filter(F.lit(False)), model).count() == 0
