"""Vectors from co-occurrence: counts, the decomposition against numpy, and what near vectors mean."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from gleaner.operators import distributional as ds
from gleaner.session import ship_package, staged


def terms(text):
    return [t for t in re.split(r"[^\w]+|_", (text or "").lower()) if t]


def plain_matrix(texts, names, window, least):
    n = Counter()
    for t in texts:
        w = terms(t)
        for i in range(len(w)):
            for j in range(i + 1, min(len(w), i + window + 1)):
                if w[i] in names and w[j] in names:
                    n[w[i], w[j]] += 1
                    n[w[j], w[i]] += 1
    sums, total = Counter(), sum(n.values())
    for (a, _), k in n.items():
        sums[a] += k
    out = {p: round(math.log(k * total / (sums[p[0]] * sums[p[1]])), 6) for p, k in n.items() if k >= least}
    return {p: v for p, v in out.items() if v > 0}


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rng = random.Random(3)
    rooms = {"sea": ["ship", "boat", "sail", "wave"], "wood": ["tree", "leaf", "root", "bark"], "town": ["street", "shop", "tram", "market"]}
    rows = []
    for i in range(240):
        words = [rng.choice(list(rooms.values())[i % 3]) if rng.random() < 0.8 else rng.choice(["the", "and", "of"]) for _ in range(rng.randrange(3, 30))]
        rows.append((i, " ".join(words).title(), "clash"))
    rows += [(900, None, "x"), (901, "", "x"), (902, "unknownword", "x"), (902, "ship boat", "x"), (903, "ship " * 5000, "x")]
    return staged(spark.createDataFrame(rows, "doc_id bigint, text string, a string").repartition(3), "t")


def test_matrix_and_singular_values(docs):
    vocabulary = ds.fit_vocabulary(docs, "text", least=10)
    texts = [r.text for r in docs.collect()]
    frequency = Counter(t for x in texts for t in set(terms(x)))
    assert list(zip(vocabulary.terms, vocabulary.documents)) == sorted(((t, n) for t, n in frequency.items() if n >= 10), key=lambda x: (-x[1], x[0]))
    found = ds.positive_pmi(ds.pair_counts(docs, "text", vocabulary))
    got = {(vocabulary.terms[r.a], vocabulary.terms[r.b]): r.value for r in found.collect()}
    want = plain_matrix(texts, set(vocabulary.terms), ds.WINDOW, ds.LEAST_PAIRS)
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p], abs=2e-6) for p in want)
    size = len(vocabulary.terms)
    dense = np.zeros((size, size))
    for (a, b), v in got.items():
        dense[vocabulary.terms.index(a), vocabulary.terms.index(b)] = v
    thin = np.random.default_rng(1).normal(size=(size, 3))
    np.testing.assert_allclose(ds.product(found, thin), dense @ thin, atol=1e-9)
    values, vectors = ds.decompose(found, size, width=4)
    np.testing.assert_allclose(values, np.linalg.svd(dense)[1][:4], rtol=1e-6)
    np.testing.assert_allclose(np.abs(dense @ vectors), np.abs(vectors) * values, atol=1e-6)


def test_singular_values_on_documents(spark, small):
    """All of a corpus: the largest singular values are those of numpy."""
    ship_package(spark)
    rows = spark.read.parquet(f"{small}/documents.parquet").select("text")
    vocabulary = ds.fit_vocabulary(rows, "text")
    found = staged(ds.positive_pmi(ds.pair_counts(rows, "text", vocabulary)), "t")
    size = len(vocabulary.terms)
    dense = np.zeros((size, size))
    for r in found.collect():
        dense[r.a, r.b] = r.value
    values, _ = ds.decompose(found, size, width=8, oversampling=40, rounds=6)
    np.testing.assert_allclose(values, np.linalg.svd(dense)[1][:8], rtol=1e-3)


def test_terms_of_like_neighbours_are_near(spark, docs):
    learned = docs.where("doc_id < 900")
    model = ds.fit(learned, "text", width=6, least=10)
    assert model.model_id == ds.fit(learned, "text", width=6, least=10).model_id and model.model_id.startswith("distributional-6-")
    unit = {t: v / np.linalg.norm(v) for t, v in zip(model.vocabulary.terms, model.vectors)}
    assert unit["ship"] @ unit["sail"] > 0.6 > 0.3 > unit["ship"] @ unit["leaf"]
    made = ds.embed_text(docs, "text", model)
    assert made.columns == [*docs.columns, "embedding"]
    rows = made.where("doc_id >= 900").collect()
    norms = {(r.doc_id, r.text and r.text[:4]): float(np.linalg.norm(r.embedding)) for r in rows}
    assert {k: round(v, 9) for k, v in norms.items()} == {(900, None): 0, (901, ""): 0, (902, "unkn"): 0, (902, "ship"): 1, (903, "ship"): 1}


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    model = ds.fit(empty, "text", width=3)
    asked = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
    assert ds.embed_text(asked, "text", model).first().embedding == [0.0, 0.0, 0.0]
