"""Quality rules with risk-controlled thresholds.

Every rule rejects a document whose feature exceeds a cutoff. Cutoffs are not set by hand: per stratum and feature
they are tested on a labelled holdout, from lenient to strict, against the hypothesis "this cutoff rejects more than
a share ``risk`` of the good documents". The test is exact (binomial): with n good holdout documents of which k are
rejected, the hypothesis is refused when P(Bin(n, risk) <= k) <= level. The sequence stops at its first cutoff that
is not refused, so all cutoffs of one sequence share one level; the level of each of the m sequences (strata times
features) is ``error / m`` (Bonferroni). With probability at least ``1 - error`` no chosen rule rejects more than
``risk`` of the good documents of its stratum; all rules together reject at most the sum over the features.
Among the certified cutoffs the one with the most bad less ``GOOD_COST`` times good holdout documents rejected is taken, the
most lenient on ties, and only if it is above zero. A stratum with too few labels gets no rule and keeps its documents.

Native DataFrame functions only: everything about one text is computed in its row, without a shuffle; only labelled
rows (four numbers each) are joined and counted, and the counts have one row per stratum, feature and cutoff.

Defined results: a null or empty text has no words and fails the base rule. A null stratum is a stratum of its own. A
document without label is judged and never used for the test; repeated labels or documents count once per pair.
Tied features are judged alike. Empty tables give empty results, no labels give no rules. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import WORD_CHAR, let, stage, words_of

SYMBOLS = "[#*$%&|<>]"
REPEAT_WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

#: Share of good documents that a rule may reject, and probability that any rule of the table breaks it.
#: With twenty sequences (four strata, five features) a stratum needs 197 good labelled documents to certify a cutoff.
RISK, ERROR = 0.03, 0.05
#: How many bad documents a cutoff has to reject for each good one.
GOOD_COST = 20

#: Feature, and its cutoffs from lenient to strict. They are fixed before any label is seen.
CUTOFFS = {
    "symbols_per_word": [2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.2, 0.1],
    "dup_line_share": [0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1],
    "repeat_share": [0.25, 0.2, 0.15, 0.1, 0.05],
    "upper_share": [0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.2],
    "marks_per_word": [2.0, 1.0, 0.75, 0.5, 0.25, 0.1],
}

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: Column, window: int = REPEAT_WINDOW) -> Column:
    """How many words lie in a window of so many words that is found twice or more in the text, the first included.

    Windows are told apart by 64-bit hashes. Only a text that has equal hashes sorts them with their places.
    """
    size = F.size(words)

    def windows(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - window)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            n = F.size(p)
            later, earlier = F.slice(p, 2, n - 1), F.slice(p, 1, n - 1)
            pairs = F.zip_with(earlier, later, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
            return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))

        def total(at: Column) -> Column:
            n = F.size(at)
            gaps = F.zip_with(F.slice(at, 1, n - 1), F.slice(at, 2, n - 1), lambda a, b: F.least(b - a, F.lit(window)))
            return F.aggregate(gaps, F.lit(window), lambda s, g: s + g)

        return let(let(placed, places), total)

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered(hashes)).otherwise(0)

    return F.when(size > window, let(windows(words), count)).otherwise(0)


def text_statistics(text: Column) -> Column:
    """The base counts of one text as a struct of longs."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD_CHAR))

    def of_words(words: Column) -> Column:
        joined = F.array_join(words, "")
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(joined).cast("long").alias("word_chars"),
            F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x)))).cast("long").alias("n_dup_lines"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.regexp_count(body, F.lit("[A-Z]")).cast("long").alias("n_upper"),
            F.regexp_count(body, F.lit("!")).cast("long").alias("n_marks"),
        )

    return let(words_of(text), of_words)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words)


def features() -> dict[str, Column]:
    """The features of ``CUTOFFS`` from the counts; 0 where there is nothing to divide by."""

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return {
        "symbols_per_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "marks_per_word": share("n_marks", "n_words"),
    }


def binomial_tail(k: Column, n: Column, risk: float) -> Column:
    """P(Bin(n, risk) <= k), summed in logarithms; 1 where k is above the mean, which no test refuses."""
    odds = math.log(risk) - math.log1p(-risk)
    start = F.struct((n * math.log1p(-risk)).alias("log_p"), F.exp(n * math.log1p(-risk)).alias("total"))

    def step(s: Column, i: Column) -> Column:
        log_p = s["log_p"] + F.log((n - i + 1) / i) + odds
        return F.struct(log_p.alias("log_p"), (s["total"] + F.exp(log_p)).alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    tail = F.aggregate(steps, start, step, lambda s: s["total"])
    return F.when(k > n * risk, F.lit(1.0)).otherwise(tail)


def choose_cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``stratum, feature, cutoff, n_good, n_good_rejected, n_bad_rejected`` of the certified rules.

    ``measured`` has doc_id, the stratum and the features; ``labels`` has doc_id and quality (1 good, 0 bad).
    """
    holdout = labels.select("doc_id", "quality").filter("quality in (0, 1)").distinct()
    known = measured.filter("not base_failed").join(holdout, "doc_id").withColumn("_stratum", F.coalesce(stratum, F.lit("")))
    tested = F.array(
        *[
            F.struct(F.lit(name).alias("feature"), F.lit(place).alias("place"), F.lit(cutoff).alias("cutoff"), (F.col(name) > cutoff).alias("rejected"))
            for name, cutoffs in CUTOFFS.items()
            for place, cutoff in enumerate(cutoffs)
        ]
    )
    rows = known.select("_stratum", "quality", F.inline(tested))
    counts = rows.groupBy("_stratum", "feature", "place", "cutoff").agg(
        F.sum("quality").cast("long").alias("n_good"),
        F.sum(F.when(F.col("rejected"), F.col("quality")).otherwise(0)).cast("long").alias("n_good_rejected"),
        F.sum(F.when(F.col("rejected"), 1 - F.col("quality")).otherwise(0)).cast("long").alias("n_bad_rejected"),
    )
    counts = stage(counts, "cutoff-counts")
    sequences = counts.select("_stratum", "feature").distinct().count()
    level = error / max(1, sequences)
    judged = counts.withColumn("_p", binomial_tail(F.col("n_good_rejected"), F.col("n_good"), risk))
    # A sequence is a handful of fixed cutoffs, so it is put together in its row.
    entry = F.struct("place", "cutoff", "n_good", "n_good_rejected", "n_bad_rejected", (F.col("_p") <= level).alias("passed"))
    per = judged.groupBy("_stratum", "feature").agg(F.sort_array(F.collect_list(entry)).alias("_tests"))
    failed = F.filter("_tests", lambda t: ~t["passed"])
    stop = F.when(F.size(failed) > 0, F.get(failed, 0)["place"]).otherwise(F.lit(1 << 30))
    certified = per.select("_stratum", "feature", F.explode(F.filter("_tests", lambda t: t["place"] < stop)).alias("t"))
    gain = F.col("t.n_bad_rejected") - GOOD_COST * F.col("t.n_good_rejected")
    best = certified.filter(gain > 0).groupBy("_stratum", "feature").agg(F.max(F.struct(gain.alias("gain"), (-F.col("t.place")).alias("lenient"), "t")).alias("b"))
    return best.select(
        F.col("_stratum").alias("stratum"), "feature", F.col("b.t.cutoff").alias("cutoff"), F.col("b.t.n_good").alias("n_good"),
        F.col("b.t.n_good_rejected").alias("n_good_rejected"), F.col("b.t.n_bad_rejected").alias("n_bad_rejected"),
    )


def kept_rows(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The rows of ``docs`` that are kept. Of rows with one id each stands for its own text and stratum."""
    # The rows are stored with what is counted about them, so the texts are not dealt out to find theirs.
    judged = judge_quality(docs, labels, stratum, risk, error, F.struct(*[docs[c] for c in docs.columns]))
    return judged.filter("kept").select("mark.*")


def judge_quality(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR, mark: Column | None = None) -> DataFrame:
    """One row per document: doc_id, the base counts, ``base_failed``, ``failed_rules`` and ``kept``; ``mark`` adds a column of its own."""
    marks = {} if mark is None else {"mark": mark}
    counted = docs.select("doc_id", F.col(stratum).alias("_stratum_in"), text_statistics(F.col("text")).alias("_s"), *[c.alias(n) for n, c in marks.items()])
    flat = counted.select("doc_id", "_stratum_in", "_s.*", *marks)
    measured = stage(
        flat.select("*", base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed"), *[c.alias(n) for n, c in features().items()]),
        "quality",
    )
    rules = choose_cutoffs(measured, labels, "_stratum_in", risk, error)
    # One row per stratum, so the join adds no rows.
    per_stratum = rules.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("feature", "cutoff"))).alias("_cutoffs"))
    joined = measured.withColumn("stratum", F.coalesce("_stratum_in", F.lit(""))).join(per_stratum, "stratum", "left")
    broken = F.filter(
        F.array(*[F.when(F.col(n) > F.element_at("_cutoffs", n), F.lit(n)) for n in CUTOFFS]), lambda x: x.isNotNull()
    )
    return joined.withColumn("failed_rules", broken).select(
        "doc_id", *STATISTICS, "base_failed", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), "failed_rules", *marks
    )
