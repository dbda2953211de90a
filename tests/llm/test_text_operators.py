"""Operators on documents against brute force, with nulls, empty and long texts, ties, repeats and clashing columns."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import decontaminate, jaccard, quality, substring
from gleaner.llm.components import components
from gleaner.session import ship_package

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, texts, extra=""):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = sentence(rng, 120)
    passage = sentence(rng, 40)
    words = base.split()
    near = [" ".join(w if rng.random() > 0.01 else f"x{i}" for w in words) for i in range(25)]
    middle = [" ".join(w if rng.random() > 0.035 else f"y{i}" for w in words) for i in range(25)]
    shared = [f"{sentence(rng, 30)} {passage} {sentence(rng, 25)}" for _ in range(20)]
    odd = [
        None, "", "   \t\n", "one", "two words", "a b c d", "A b C d", "a  b\tc\nd", "a b c d e", "é" * 50, "ß ü ñ 漢字 w1", "😀 😀 😀",
        sentence(rng, 13), sentence(rng, 5000), " ".join(["same"] * 300), "x" * 20000, "<|endoftext|> a b", "tail\r\nends\x0b\x0chere ",
    ]
    return [base, base, base.upper(), *near, *middle, *shared, *odd, *[sentence(rng, rng.randrange(1, 60), 12) for _ in range(60)], base]


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_jaccard(spark, texts):
    ship_package(spark)
    got = rows(jaccard.similar_sets(frame(spark, texts)), "doc_id", "n_shingles", "component_id", "n_links")
    assert got == sorted(((k, *v) for k, v in brute.jaccard_links(list(enumerate(texts))).items()), key=repr)


@pytest.mark.parametrize("percent,k", [(50, 2), (90, 5), (100, 3)])
def test_jaccard_other_limits(spark, texts, percent, k):
    got = rows(jaccard.similar_sets(frame(spark, texts), k, percent), "doc_id", "n_shingles", "component_id", "n_links")
    assert got == sorted(((i, *v) for i, v in brute.jaccard_links(list(enumerate(texts)), k, percent).items()), key=repr)


def test_jaccard_without_rounds(spark, texts, monkeypatch):
    """Blocks alone, and pivots alone until nothing is left, find the same components."""
    want = sorted(((k, *v) for k, v in brute.jaccard_links(list(enumerate(texts))).items()), key=repr)
    monkeypatch.setattr(jaccard, "ROUNDS", 0)
    assert rows(jaccard.similar_sets(frame(spark, texts)), "doc_id", "n_shingles", "component_id", "n_links") == want
    monkeypatch.setattr(jaccard, "ROUNDS", 3)
    monkeypatch.setattr(jaccard, "LEFT_OVER", -1)
    assert rows(jaccard.similar_sets(frame(spark, texts)), "doc_id", "n_shingles", "component_id", "n_links") == want


def test_jaccard_nulls_and_repeats(spark):
    text = " ".join(f"v{i}" for i in range(30))
    docs = spark.createDataFrame([(None, text), (7, text), (3, text), (3, text), (9, None), (8, "")], "doc_id bigint, text string")
    got = rows(jaccard.similar_sets(docs), "doc_id", "n_shingles", "component_id")
    assert got == sorted([(3, 26, 3), (3, 26, 3), (7, 26, 3), (8, 0, 8), (9, 0, 9), (None, 26, None)], key=repr)
    kept = sorted(r.doc_id or -1 for r in jaccard.one_of_each(docs).collect())
    assert kept == [-1, 3, 8, 9]
    links = rows(jaccard.similar_sets(docs), "doc_id", "n_links")
    assert links == sorted([(3, 2), (3, 2), (7, 2), (8, 0), (9, 0), (None, 0)], key=repr)
    assert jaccard.similar_sets(docs.limit(0)).count() == 0


def test_jaccard_texts_that_share_an_id(spark):
    """An id says nothing about the text: an unlinked text of a repeated id stays."""
    x, y = (" ".join(f"{c}{i}" for i in range(30)) for c in "xy")
    docs = spark.createDataFrame([(3, x, 1), (5, x, 2), (5, y, 3), (7, y, 4), (8, "", 5), (8, None, 6)], "doc_id bigint, text string, root int")
    assert rows(jaccard.one_of_each(docs), "doc_id", "text")[:2] == [(3, x), (5, y)]
    assert jaccard.one_of_each(docs).filter("doc_id = 8").count() == 1
    clashing = docs.selectExpr("*", "1 as n", "2 as h", "3 as label", "4 as s", "5 as kept_id", "6 as row")
    assert jaccard.one_of_each(clashing).columns == clashing.columns
    assert rows(jaccard.similar_sets(clashing), "doc_id", "n_links") == [(3, 1), (5, 1), (5, 1), (7, 1), (8, 0), (8, 0)]


def test_jaccard_groups_with_one_leader(spark, monkeypatch):
    """Copies near to one text and others at the edge of a link: counts by derivation equal counts by comparison."""
    rng = random.Random(11)
    words = sentence(rng, 200, 5000).split()
    share = [0.0, 0.004, 0.008, 0.02, 0.03, 0.05]
    made = [" ".join(w if rng.random() > share[i % 6] else f"z{rng.randrange(9)}" for w in words[: 200 - i % 3 * 8]) for i in range(90)]
    want = sorted(((d, *v) for d, v in brute.jaccard_links(list(enumerate(made))).items()), key=repr)
    for left_over in (-1, 2):
        monkeypatch.setattr(jaccard, "LEFT_OVER", left_over)
        assert rows(jaccard.similar_sets(frame(spark, made)), "doc_id", "n_shingles", "component_id", "n_links") == want


def test_only_sets_that_a_pair_names_are_sent(spark):
    sets = spark.createDataFrame([(s, list(range(s, s + 10))) for s in range(50)], "s bigint, members array<bigint>")
    pairs = spark.createDataFrame([(3, 4), (3, 12), (4, 3)], "a bigint, b bigint")
    assert rows(jaccard._wanted(sets, pairs, "a", "b"), "s") == [(12,), (3,), (4,)]
    assert rows(jaccard._verified(pairs, sets, 80), "a", "b", "shared", "linked") == [(3, 12, 1, False), (3, 4, 9, True), (4, 3, 9, True)]


def test_jaccard_pairs_meet_where_enough_differences_are_left(spark):
    # Each lacks slack for three shared differences (360 makes up for one); 1 and 2 share their last three, 3 has but its last in common.
    lists = {1: [10, 11, 90, 91, 92], 2: [20, 21, 90, 91, 92], 3: [30, 31, 32, 33, 92]}
    single = spark.createDataFrame([(0, s, 100, 5, -540, 1, h) for s, h in lists.items()], "label bigint, s bigint, n bigint, apart bigint, slack bigint, size bigint, differs array<bigint>")
    found = jaccard._linked_by_differences(single, 80)
    assert rows(found, "s_a", "s_b") == [(1, 2)]
    exact = [(0, s, 100, 5, -180, 1, h) for s, h in lists.items()]
    assert rows(jaccard._linked_by_differences(spark.createDataFrame(exact, single.schema), 80), "s_a", "s_b") == [(1, 2), (1, 3), (2, 3)]


def test_what_only_the_leader_holds_counts_in_what_two_sets_differ_by(spark):
    same = "b c d e f g h i j k l m n o p q r"
    ship_package(spark)
    made = [f"x1 {same}", f"x2 {same}", f"x3 {same}", f"x3 {same}"]
    got = rows(jaccard.similar_sets(frame(spark, made)), "doc_id", "component_id", "n_links")
    assert got == [(i, 0, 3) for i in range(4)]


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 4), (9, 9), (None, 1), (20, 10), (10, 30), *[(100, i) for i in range(101, 160)]], "a bigint, b bigint")
    got = dict(components(edges, "a", "b").collect())
    assert got == {3: 3, 4: 3, 5: 3, 10: 10, 20: 10, 30: 10, **{i: 100 for i in range(100, 160)}}


def test_substring(spark, texts):
    kept, own = substring.remove_repeats(frame(spark, texts))
    got = rows(kept, "doc_id", *(own[n] for n in ("n_words", "n_removed", "kept_sha256")))
    assert got == sorted(brute.repeats(list(enumerate(texts))), key=repr)
    changed = {r.doc_id: r.text for r in kept.filter(f"{own['n_removed']} = 0").collect()}
    assert all(changed[i] == texts[i] for i in changed)


def test_substring_other_width(spark, texts):
    kept, own = substring.remove_repeats(frame(spark, texts), block=3)
    got = rows(kept, "doc_id", *(own[n] for n in ("n_words", "n_removed", "kept_sha256")))
    assert got == sorted(brute.repeats(list(enumerate(texts)), width=5), key=repr)


def test_substring_nulls_repeats_and_clashes(spark):
    text = " ".join(f"v{i}" for i in range(20))
    docs = spark.createDataFrame([(None, text, 1), (4, text, 2), (4, text, 3), (9, text + " more", 4), (2, None, 5)], "doc_id bigint, text string, N_Words int")
    kept, own = substring.remove_repeats(docs)
    assert own["n_words"] != "n_words" and docs.columns == kept.columns[:3]
    got = {(r.doc_id, r.N_Words): (r[own["n_removed"]], r.text) for r in kept.collect()}
    assert got == {(None, 1): (20, ""), (4, 2): (0, text), (4, 3): (0, text), (9, 4): (20, "more"), (2, 5): (0, None)}
    assert substring.remove_repeats(docs.limit(0))[0].count() == 0


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog again and again"), (2, "short one"), (3, "quick brown fox jumps over the lazy dog again and then"),
    (4, None), (5, ""), (6, "..."), (10, "a a a a a a a a a a a a"), (11, "The quick brown fox jumps over the lazy dog again and again"), (12, "one"),
]


def contaminated_texts():
    rng = random.Random(3)
    alphabet = "the quick brown fox jumps over lazy dog again and then a short one".split()
    return [
        None, "", "?!", "a" * 30, "SHORT, one!", "say: The quick-brown fox jumps over the lazy dog again, and again.", "a " * 40, "one",
        *[" ".join(rng.choice(alphabet) for _ in range(rng.randrange(200))) for _ in range(60)],
        *[f"x {i} quick brown fox jumps over the lazy dog again and {i} end" for i in range(5)], "ünï quick " * 5,
    ]


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_contamination(spark, block):
    texts = contaminated_texts()
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = rows(decontaminate.report(frame(spark, texts), items, block_bytes=block), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == sorted(brute.contamination(list(enumerate(texts)), ITEMS), key=repr)


def test_contamination_on_tables(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = decontaminate.report(spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/benchmark.parquet"))
    assert rows(got, *got.columns) == sorted(brute.contamination(docs, items), key=repr)


def test_no_items_and_no_documents(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = frame(spark, ["short one", None])
    assert not any(r.contaminated for r in decontaminate.report(docs, items.limit(0)).collect())
    assert decontaminate.report(docs.limit(0), items).count() == 0


def test_spans_are_removed(spark):
    items = spark.createDataFrame(ITEMS[:1], "item_id bigint, spans string").withColumnRenamed("spans", "text")
    own = " ".join(f"own{i}" for i in range(15))
    docs = frame(spark, [f"{own} THE quick, brown fox jumps over the lazy dog again ({own})", "the quick brown fox jumps over the lazy dog again", None, own]).withColumn("Spans", F.lit(1))
    kept = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, items).collect()}
    assert kept == {0: f"{own}  ({own})", 2: None, 3: own}
    assert decontaminate.remove_spans(docs, items).columns == docs.columns
    longer = decontaminate.remove_spans(docs, items, most_length=10, most_coverage=1.0)
    assert {r.doc_id: r.text for r in longer.collect()}[1] == "the quick brown fox jumps over the lazy dog again"


def test_statistics(spark, texts):
    docs = frame(spark, [*texts, "a b\na b\n \na b", "#*$%&|<> ###", " ".join(str(i % 9) for i in range(40)), " ".join(map(str, range(8)))])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    judged = quality.judge_quality(docs, labels)
    got = rows(judged, "doc_id", *quality.STATISTICS, "base_failed")
    assert got == sorted(((r.doc_id, *brute.statistics(r.text)) for r in docs.collect()), key=repr)
    assert all(r.kept != r.base_failed for r in judged.collect())
    assert quality.judge_quality(docs.limit(0), labels).count() == 0


def test_binomial_tail(spark):
    cases = [(k, n, 0.02) for n in (1, 10, 400) for k in (0, 1, 5)]
    df = spark.createDataFrame([(k, n) for k, n, _ in cases], "k bigint, n bigint")
    from math import comb

    for r in df.withColumn("p", quality.binomial_tail(F.col("k"), F.col("n"), 0.02)).collect():
        exact = sum(comb(r.n, i) * 0.02**i * 0.98 ** (r.n - i) for i in range(min(r.k, r.n) + 1))
        assert r.p == pytest.approx(1.0 if r.k > r.n * 0.02 else exact, rel=1e-9)


def test_cutoffs_are_certified(spark):
    """A rule is chosen where the labels carry it, per stratum, and rejects few good documents."""
    rng = random.Random(1)
    clean = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(2000)]
    shouting = [" ".join(f"W{rng.randrange(10**6)}!!".upper() for _ in range(30)) for _ in range(300)]
    data = [(i, t, "en" if i % 20 else "fr") for i, t in enumerate([*clean, *shouting])]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 2000)) for i in range(2300)] + [(None, 1), (5, None), (7, 1)], "doc_id bigint, quality int")
    judged = {r.doc_id: r for r in quality.judge_quality(docs, labels).collect()}
    assert all(judged[i].kept for i in range(2000))
    for i in range(2000, 2300):
        assert judged[i].kept == (i % 20 == 0)  # too few labels in fr: no rule, nothing rejected


def test_word_hashes_do_not_depend_on_place():
    import pyarrow as pa

    from gleaner.llm import words as wd

    texts = pa.array(["alpha beta", None, "beta  alpha\n", "", "Beta"])
    cut = wd.words(texts, lower=True)
    assert cut.counts.tolist() == [2, 0, 2, 0, 1]
    h = cut.hash
    assert h[0] == h[3] and h[1] == h[2] == h[4] and h[0] != h[1]
    assert np.array_equal(wd.words(texts.slice(2, 3), lower=True).hash, h[2:])


def test_rules_are_certified_where_labels_allow(spark):
    """At 1,000 documents English gets a rule, at 10,000 every language; hardly a good document goes."""
    for folder, languages in (("/root/testdata/sf0.01", {"en"}), ("/root/testdata/sf0.1", {"de", "en", "es", "fr"})):
        docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
        judged = quality.judge_quality(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").filter("not base_failed").toPandas()
        out = judged[~judged.kept]
        assert set(out[out.quality == 0].lang) == languages
        assert (out.quality == 1).sum() <= 0.01 * (judged.quality == 1).sum()


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    good = " ".join(f"word{i}" for i in range(40))
    data = [(1, good, "en", "x"), (1, "short", "en", "x"), (None, good, None, "x"), (None, None, "en", "x"), (2, good, "en", "x"), (2, good, "en", "y")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string, text_hash string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    kept = quality.kept_rows(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, docs.filter("text like 'word%'").collect()))


def test_rows_are_kept_without_dealing_out_their_texts(spark):
    docs = spark.createDataFrame([(i, " ".join(f"word{j}" for j in range(40)), "en") for i in range(3)], "doc_id bigint, text string, lang string")
    kept = quality.kept_rows(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert kept.count() == 3
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.split("\n") if "Exchange" in x and "Broadcast" not in x and "text" in x] and "SortMergeJoin" not in plan
