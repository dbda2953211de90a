"""Sentence boundaries learned from the corpus, without labels.

A dot ends a sentence unless it belongs to an abbreviation. Abbreviations are found by counting, as in Kiss and Strunk (2006): a
word type that nearly always carries a dot, is short, and may hold more dots. The test is Dunning's log likelihood ratio of "the
dot is there by chance" against "the dot belongs to the word", weighted by length, inner dots and the
occurrences without a dot. After an abbreviation a new sentence starts only at a capitalised word that is a
learned sentence starter: one that follows sure ends of sentences far more often than chance.

The counts are one aggregate over the corpus each; the model is a table, and nothing of it passes the driver. For the
segmentation only the short words before dots, and the words after them, are joined with the model; the text is cut inside its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import SENTENCE_GAP, words
from gleaner.session import staged

#: Fixed values of the published method: least score of an abbreviation, least ratio of a starter, share of dots of an abbreviation.
LEAST_SCORE = 0.3
LEAST_STARTER = 30.0
DOT_SHARE = 0.99
#: Occurrences of a type with a dot below which it is not judged.
LEAST_COUNT = 5

OPENERS, CLOSERS = r"""^[("'\[]+""", r"""[)"'\],;:!?]+$"""
LETTERS_AND_DOTS = r"^\p{L}+(\.\p{L}+)*$"
PLACES = 6
_MARK = "\x1e"


def word_type(word: Column) -> Column:
    """The word in lower case, without brackets, quotes and marks around it; a final dot stays."""
    return F.lower(F.regexp_replace(F.regexp_replace(word, OPENERS, ""), CLOSERS, ""))


def base_of(kind: Column) -> Column:
    return F.regexp_replace(kind, r"\.$", "")


def log_likelihood(n: Column, n_a: Column, n_b: Column, n_ab: Column, p: float = DOT_SHARE) -> Column:
    """Minus twice the log of how much likelier b follows a by chance (``n_b / n``) than with probability ``p``."""
    chance = n_b / n
    null = n_ab * F.log(chance) + (n_a - n_ab) * F.log(1 - chance)
    return -2 * (null - (n_ab * F.log(F.lit(p)) + (n_a - n_ab) * F.log(F.lit(1 - p))))


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """``w, n``: how often each word stands in the texts, as written. What is asked of words is asked of these rows, not of every occurrence."""
    return docs.select(F.explode(words(F.col(text))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))


def dot_counts(docs: DataFrame, text: str, counted: DataFrame | None = None) -> DataFrame:
    """``base, n_dot, n_plain`` of every word type of letters and inner dots; base '' holds all words and all with a dot.

    ``counted`` are stored ``word_counts`` of the same texts.
    """
    counted = word_counts(docs, text) if counted is None else counted
    marked = counted.select(word_type(F.col("w")).alias("t"), "n").select(base_of(F.col("t")).alias("base"), F.endswith("t", F.lit(".")).alias("dot"), "n")
    judged = F.when(F.col("base").rlike(LETTERS_AND_DOTS), F.col("base")).otherwise(F.lit("."))
    per_type = marked.groupBy(judged.alias("base")).agg(F.sum(F.when(F.col("dot"), F.col("n")).otherwise(0)).alias("n_dot"), F.sum(F.when(F.col("dot"), 0).otherwise(F.col("n"))).alias("n_plain"))
    per_type = staged(per_type, "dot-counts")
    total = per_type.agg(F.lit("").alias("base"), F.coalesce(F.sum("n_dot"), F.lit(0)).alias("n_dot"), F.coalesce(F.sum("n_plain"), F.lit(0)).alias("n_plain"))
    return per_type.where("base <> '.'").unionByName(total)


def abbreviations(counts: DataFrame, least_score: float = LEAST_SCORE, least: int = LEAST_COUNT) -> DataFrame:
    """``base, n_dot, n_plain, score`` of the types that are abbreviations."""
    total = counts.where("base = ''").select((F.col("n_dot") + F.col("n_plain")).cast("double").alias("_n"), F.col("n_dot").cast("double").alias("_dots"))
    # One row of totals, by name rather than by a join of all rows with it.
    one = total.first()
    if one is None or not 0 < one["_dots"] < one["_n"]:
        return counts.limit(0).withColumn("score", F.lit(0.0))
    inner = F.length(F.regexp_replace("base", r"[^.]", ""))
    letters = F.length(F.regexp_replace("base", r"\.", ""))
    ratio = log_likelihood(F.lit(one["_n"]), (F.col("n_dot") + F.col("n_plain")).cast("double"), F.lit(one["_dots"]), F.col("n_dot").cast("double"))
    score = ratio * F.exp(-letters) * (inner + 1) * F.pow(letters.cast("double"), -F.col("n_plain"))
    some = counts.where((F.col("base") != "") & (F.col("n_dot") >= least))
    return some.withColumn("score", F.round(score, PLACES)).where(F.col("score") >= least_score)


def _fragments(text: Column) -> Column:
    """The text cut at every possible boundary."""
    return F.filter(F.split(F.replace(text, F.lit(_MARK), F.lit(" ")), SENTENCE_GAP), lambda s: F.trim(s) != "")


def _last_base(fragment: Column) -> Column:
    """The base of the last word if it ends with a dot, else null."""
    # What follows the last space is short; only there other white space is looked for, and the type is made once.
    word = F.regexp_replace(F.substring_index(F.trim(fragment), " ", -1), r"(?s)^.*\s", "")
    return F.get(F.transform(F.array(word_type(word)), lambda kind: F.when(F.endswith(kind, F.lit(".")), base_of(kind))), F.lit(0))


def _first_word(fragment: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(F.substring_index(F.trim(fragment), " ", 1), r"^\S*", 0), OPENERS, "")


def starters(docs: DataFrame, text: str, abbreviated: DataFrame, least: float = LEAST_STARTER, counted: DataFrame | None = None) -> DataFrame:
    """``word, n_first, n_all, ratio`` of the capitalised words that start sentences more often than chance.

    Counted after fragments whose last word is no abbreviation, so what the model is not sure about has no say. ``counted`` are
    stored ``word_counts`` of the same texts.
    """
    counted = staged(word_counts(docs, text), "words") if counted is None else counted
    numbered = docs.select(F.col(text), F.monotonically_increasing_id().alias("_row"))
    parts = numbered.select("_row", F.posexplode(F.transform(_fragments(F.col(text)), lambda s: F.struct(_last_base(s).alias("last"), word_type(_first_word(s)).alias("first")))).alias("i", "s"))
    parts = staged(parts.select("_row", "i", "s.*"), "fragments")
    sure = parts.join(abbreviated.select(F.col("base").alias("last"), F.lit(1).alias("_abbreviated")), "last", "left").where("_abbreviated IS NULL")
    ends = sure.select("_row", (F.col("i") + 1).alias("i"))
    first = parts.join(ends, ["_row", "i"], "left_semi").groupBy(F.col("first").alias("word")).agg(F.count("*").alias("n_first"))
    every = counted.groupBy(base_of(word_type(F.col("w"))).alias("word")).agg(F.sum("n").alias("n_all"))
    totals = counted.agg(F.sum("n").alias("n")).first()["n"]
    starts = staged(first, "first-words")
    n_starts = starts.agg(F.sum("n_first").alias("n")).first()["n"]
    if not totals or not n_starts:
        return starts.select("word", "n_first", F.lit(0).cast("bigint").alias("n_all"), F.lit(0.0).alias("ratio")).limit(0)
    both = starts.where("word <> ''").join(every, "word")
    n, a, b, ab = F.lit(float(totals)), F.lit(float(n_starts)), F.col("n_all").cast("double"), F.least("n_first", "n_all").cast("double")

    def likelihood(k: Column, of: Column, p: Column) -> Column:
        return F.when(k > 0, k * F.log(p)).otherwise(0.0) + F.when(of - k > 0, (of - k) * F.log(1 - p)).otherwise(0.0)

    p, p1, p2 = b / n, ab / a, (b - ab) / (n - a)
    ratio = -2 * (likelihood(ab, a, p) + likelihood(b - ab, n - a, p) - likelihood(ab, a, p1) - likelihood(b - ab, n - a, p2))
    return both.withColumn("ratio", F.round(ratio, PLACES)).where((F.col("ratio") >= least) & (ab / a > b / n)).select("word", "n_first", "n_all", "ratio")


def learned_sentences(docs: DataFrame, text: str, doc_id: str, abbreviated: DataFrame, starting: DataFrame, out: str = "sentences") -> DataFrame:
    """``docs`` with the array of sentences. Joined fragments are separated by one space; a null text has a null array."""
    cut = docs.withColumn("_f", _fragments(F.col(text))).withColumn("_key", F.xxhash64(doc_id))
    last = F.transform("_f", _last_base)
    firsts = F.transform("_f", lambda s: word_type(_first_word(s)))

    def named(kind: str, found: Column) -> Column:
        # Distinct as strings: Spark hashes these, but compares structs pair by pair.
        return F.transform(F.array_distinct(found), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("word")))

    asked = F.concat(named("a", F.filter(last, lambda x: x.isNotNull())), named("s", firsts))
    # Only these words meet the model; a text whose id stands twice gets the words of both, which changes nothing.
    model = abbreviated.select(F.lit("a").alias("kind"), F.col("base").alias("word")).unionByName(starting.select(F.lit("s").alias("kind"), "word"))
    held = cut.select("_key", F.inline(asked)).join(model, ["kind", "word"])
    held = held.groupBy("_key").agg(F.collect_set(F.when(F.col("kind") == "a", F.col("word"))).alias("_a"), F.collect_set(F.when(F.col("kind") == "s", F.col("word"))).alias("_s"))
    known = cut.join(held, "_key", "left")
    none = F.array().cast("array<string>")
    known = known.withColumn("_a", F.coalesce("_a", none)).withColumn("_s", F.coalesce("_s", none))

    def joined(fragment: Column, i: Column) -> Column:
        after = F.get(F.col("_f"), i + 1)
        word = _first_word(after)
        new = word.rlike(r"^\p{Lu}") & F.array_contains("_s", word_type(word))
        stays = F.coalesce(F.array_contains("_a", _last_base(fragment)), F.lit(False)) & ~F.coalesce(new, F.lit(False))
        return F.concat(F.trim(fragment), F.when(stays & after.isNotNull(), F.lit(" ")).otherwise(F.lit(_MARK)))

    whole = F.array_join(F.transform("_f", joined), "")
    sentences = F.filter(F.split(whole, _MARK), lambda s: s != "")
    return known.withColumn(out, F.when(F.col(text).isNotNull(), sentences)).select(*docs.columns, out)
