"""Learned sentence boundaries against a plain version, with planted abbreviations."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleaner.operators import boundaries as bd

WORD = re.compile(r"[^ \t\n\r\f\x0b]+")  # str.split also knows separators that a regex in the JVM does not
GAP = re.compile(r"(?<=[.!?])\s+")


def kind(word):
    return re.sub(r"""[)"'\],;:!?]+$""", "", re.sub(r"""^[("'\[]+""", "", word)).lower()


def base(t):
    return re.sub(r"\.$", "", t)


def fragments(text):
    return [f for f in GAP.split(text.replace("\x1e", " ")) if f.strip(" ")]


def plain_model(texts):
    dots, rest, every = Counter(), Counter(), Counter()
    for w in (w for t in texts for w in WORD.findall(t)):
        (dots if kind(w).endswith(".") else rest)[base(kind(w))] += 1
        every[base(kind(w))] += 1
    n, d = sum(dots.values()) + sum(rest.values()), sum(dots.values())
    found = {}
    for b, k in dots.items():
        if k < bd.LEAST_COUNT or not re.fullmatch(r"[^\W\d_]+(\.[^\W\d_]+)*", b):
            continue
        p, a, m = d / n, k + rest[b], len(b.replace(".", ""))
        ratio = -2 * (k * math.log(p) + (a - k) * math.log(1 - p) - k * math.log(0.99) - (a - k) * math.log(0.01))
        score = round(ratio * math.exp(-m) * (b.count(".") + 1) * m ** -rest[b], 6)
        if score >= bd.LEAST_SCORE:
            found[b] = (k, rest[b], score)
    first = Counter()
    for t in texts:
        parts = fragments(t)
        for x, y in zip(parts, parts[1:]):
            last = kind(WORD.findall(x)[-1])
            if not (last.endswith(".") and base(last) in found):
                first[kind(re.sub(r"""^[("'\[]+""", "", WORD.findall(y)[0]))] += 1
    starting, a = set(), sum(first.values())

    def lik(k, of, p):
        return (k * math.log(p) if k > 0 else 0) + ((of - k) * math.log(1 - p) if of > k else 0)

    for w, k in first.items():
        b = every[w]
        if not w or not b:
            continue
        k = min(k, b)
        ratio = -2 * (lik(k, a, b / n) + lik(b - k, n - a, b / n) - lik(k, a, k / a) - lik(b - k, n - a, (b - k) / (n - a)))
        if round(ratio, 6) >= bd.LEAST_STARTER and k / a > b / n:
            starting.add(w)
    return found, starting


def plain_sentences(text, found, starting):
    out, held = [], []
    parts = [f.strip(" ") for f in fragments(text)]
    for i, f in enumerate(parts):
        held.append(f)
        last = kind(WORD.findall(f)[-1])
        after = re.sub(r"""^[("'\[]+""", "", WORD.findall(parts[i + 1])[0]) if i + 1 < len(parts) else ""
        new = after[:1].isupper() and kind(after) in starting
        if not (last.endswith(".") and base(last) in found) or new or i + 1 == len(parts):
            out.append(" ".join(held))
            held = []
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    words = ["house", "river", "walked", "slowly", "under", "bridge", "stone", "market", "evening", "bread", "über", "straße"]
    starts = ["The", "Then", "However", "We"]

    def sentence():
        body = [rng.choice(words) for _ in range(rng.randrange(4, 12))]
        if rng.random() < 0.5:
            body.insert(rng.randrange(1, len(body)), rng.choice(["Dr. Smith", "e.g. bread", "z.B. stone", "approx. house", "(cf. river)", "St. Mary"]))
        return rng.choice(starts) + " " + " ".join(body) + rng.choice([".", ".", ".", "!", "?", '."'])

    return [" ".join(sentence() for _ in range(rng.randrange(1, 9))) for _ in range(150)] + [
        "", "   ", None, "no end", "We saw Dr. The end.", "It was Dr. then. We left.", "a.  b.\n\nc! d\x1ee. f", "word " * 5000 + ". " + "Dr. Smith " * 3000,
    ]


def test_by_a_plain_version(spark, texts):
    docs = spark.createDataFrame([(i if i != 3 else None, t, "clash") for i, t in enumerate(texts)] + [(5, texts[5], "again")], "doc_id bigint, text string, base string").repartition(3)
    found, starting = plain_model([t or "" for t in [*texts, texts[5]]])
    model = bd.abbreviations(bd.dot_counts(docs, "text"))
    rows = {r.base: r for r in model.collect()}
    assert {b: (r.n_dot, r.n_plain) for b, r in rows.items()} == {b: x[:2] for b, x in found.items()}
    assert {b: r.score for b, r in rows.items()} == pytest.approx({b: x[2] for b, x in found.items()}, abs=1e-5)
    assert {"dr", "e.g", "z.b", "st", "cf"} <= set(found) and not set(found) & {"house", "river", "walked", "bridge"}
    first = bd.starters(docs, "text", model)
    assert {r.word for r in first.collect()} == starting >= {"the", "then", "however", "we"}
    got = bd.learned_sentences(docs, "text", "doc_id", model, first)
    assert got.columns == [*docs.columns, "sentences"]
    want = sorted(repr(None if t is None else plain_sentences(t, found, starting)) for t in [*texts, texts[5]])
    assert sorted(repr(r.sentences) for r in got.collect()) == want
    planted = {r.doc_id: r.sentences for r in got.where("doc_id >= 150").collect()}
    assert planted[154] == ["We saw Dr.", "The end."] and planted[155] == ["It was Dr. then.", "We left."]


def test_no_words_and_no_dots(spark):
    for rows in ([], [(1, None)], [(1, "no dots here")], [(1, ". . .")]):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        model = bd.abbreviations(bd.dot_counts(docs, "text"))
        assert model.count() == 0
        first = bd.starters(docs, "text", model)
        assert len(bd.learned_sentences(docs, "text", "doc_id", model, first).collect()) == len(rows)


def test_words_are_counted_once(spark):
    """Types and starters are made from the stored counts of the words: the texts are not taken apart again for them."""
    texts = ['He met Dr. Ann.\tThe dog, (the "Dog") barked!  Then 3.5 miles. the\u3000dog \x1e ran.', "\tA. \n B\x1fc. D", "", None, "One  two. One."]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    counted = bd.word_counts(docs, "text")
    assert {r.w: r.n for r in counted.collect()} == Counter(w for t in texts if t for w in WORD.findall(t))
    plain = {tuple(r) for r in bd.dot_counts(docs, "text").collect()}
    nothing = docs.where("false")
    assert {tuple(r) for r in bd.dot_counts(nothing, "text", counted).collect()} == plain
    found = spark.createDataFrame([("dr", 1, 0, 1.0)], "base string, n_dot bigint, n_plain bigint, score double")
    wanted = {tuple(r) for r in bd.starters(docs, "text", found, -1.0).collect()}
    doubled = bd.starters(docs, "text", found, -1.0, counted=counted.withColumn("n", 2 * F.col("n"))).collect()
    assert wanted and {(r.word, r.n_first, r.n_all) for r in doubled} >= {(w, first, 2 * n) for w, first, n, _ in wanted}


def test_first_and_last_words_of_odd_fragments(spark):
    odd = ["a b.", " (Dr. ", "x\ty.", "\tfoo\u00a0bar.", "\t", "one", "end. \n", "a\nb c.\td", "e.\u2028", "Mr.),  ", "u\x1fv."]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(odd)], "i int, s string")
    pieces = F.split(F.trim("s"), r"\s+")
    kind = bd.word_type(F.element_at(pieces, -1))
    got = rows.select(
        "i", bd._last_base(F.col("s")).alias("last"), bd._first_word(F.col("s")).alias("first"),
        F.when(F.endswith(kind, F.lit(".")), bd.base_of(kind)).alias("want_last"), F.regexp_replace(F.element_at(pieces, 1), bd.OPENERS, "").alias("want_first"),
    )
    for r in got.collect():
        assert (r.last, r.first) == (r.want_last, r.want_first), odd[r.i]
