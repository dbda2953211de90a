"""Phrase mining against plain counts; intervals of the index against counts of every phrase."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gleaner.llm import phrases
from gleaner.session import ship_package

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, depth=4):
    n, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, depth + 1):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    return n, f


def brute(rows, least, top):
    n, f = counted(rows)
    out = []
    for lang in f:
        kept = {p: c for p, c in f[lang].items() if len(p) > 1 and c >= least}
        found = []
        for p, a in kept.items():
            cuts = [(2000000 * a // (f[lang][p[:k]] + f[lang][p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in kept.items())
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), f[lang][p[:k]], f[lang][p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = ["a", "B", "c", "New", "york", "über", "漢字", "é", "x y", "d\x0be"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r"]) for _ in range(rng.randrange(40))) for _ in range(120)]
    texts += ["new york city hall " * 60, "new york city hall, " * 60, None, "", " . ", "word" * 3000, "of the " * 5000]
    return [(t, rng.choice(["en", "en", "en", "de", "", None])) for t in texts] + [("same text here", "fr")] * 50


@pytest.mark.parametrize("limits", [{}, {"shard_words": 50}, {"shard_words": 50, "most_bits": 1 << 10}])
def test_by_brute_force(spark, rows, limits):
    ship_package(spark)
    docs = spark.createDataFrame([(None, t, x, "clash", 1, 2) for t, x in rows], "doc_id bigint, text string, lang string, phrase string, n int, h int").repartition(3)
    for least, top in ((5, 2000), (12, 7)):
        got = phrases.top_phrases(docs, top=top, least=least, **limits)
        got = got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, top)


def test_no_documents(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert phrases.top_phrases(docs).collect() == []


def test_scores_beyond_64_bits(spark):
    n = 1 << 50
    counts = [("en", 1, "a", 2 * n), ("en", 1, "b", n + 1), ("en", 2, "a b", n)]
    got = phrases.score_phrases(spark.createDataFrame(counts, "lang string, n_words int, phrase string, f bigint")).collect()
    assert [r.score for r in got] == [2000000 * n // (3 * n + 1)]


def test_intervals_of_all_phrases():
    """Extending to the right, to the left, and in any mixture finds every phrase with its count."""
    rng = np.random.default_rng(9)
    ids = np.concatenate([np.append(rng.integers(1, 6, rng.integers(1, 9)), 0) for _ in range(60)]).astype(np.int32)
    index = phrases.Index(ids, 5)
    text = " ".join(map(str, ids))
    _, f = counted([(text.replace("0", "."), "x")])
    for way in ("rrr", "lll", "rrl", "lrl", "rlr", "llr"):
        found = index.single()
        for side in ["", *way]:
            found = {"": lambda p: p, "r": index.right, "l": index.left}[side](found)
            got = {tuple(map(str, w)): int(c) for w, c in zip(found.words, found.count)}
            assert got == {p: c for p, c in f["x"].items() if len(p) == found.words.shape[1]}
