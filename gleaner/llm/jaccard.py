"""Exact similarity join of word-shingle sets, with set-relation skipping.

Two documents link when 100 * |A and B| >= percent * |A or B| over their distinct shingles of k words.

Index: a set needs only its first n - ceil(percent * n / 100) + 1 shingles in the index, in an order that all sets share:
unique shingles, then others from rare to frequent, as counted over all documents (``marks``). Any shared order gives the
same links; this one keeps unique shingles out of the index and frequent ones out of most prefixes.

Skipping between sets:

* Equal sets are one class with one entry in the index.
* In each round every index list offers one pivot set: one that is close to none so far, with the smallest share of
  shingles of its own, so the one that most others can be close to. The other sets of the list are compared with it.
* Of the sets it was found to link with, a set takes the one with most links as its leader, R, and the answers of the sets with
  one leader are derived from what the leader's comparisons have told, by |A xor B| = |A xor R| + |B xor R| - 2 |both|, where
  ``both`` are the shingles that A and B have different from R. Pairs that link even without any are counted by running totals
  and never made. For the others the few differences are joined, not the sets, and only at places with as many left as the pair
  has to share. Rounds go on while they lower the pairs left over, which are counted and not made.
* Pairs left over, all of different leaders, are found between blocks of the lists (one leader, sizes and places within a few
  percent). A pair of blocks is skipped as a whole when their places and sizes rule the overlap out. A pair of sets is skipped
  when a set that both were compared with tells that they differ too much (|A xor B| >= |R xor B| - |R xor A|).

No link is lost: two sets have one leader and their answer is derived, or were compared, or a bound says that they do not link.
``n_links`` counts them all, ``component_id`` follows them.

Defined results: a text with fewer than k words is one shingle of all its words; null, empty or wordless texts have the empty
set and link with nothing. A null document id links with nothing and has a null component and no links. Rows are judged one
by one: those that share an id but not their set are different nodes, those that share both link with each other. Very long
texts are one set like others. Ties between pivots or leaders go to the smaller node. No documents give no rows. Extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm import marks
from gleaner.llm import words as wd
from gleaner.llm.common import fresh, let_go, scratch_path, small_batches, stage
from gleaner.llm.components import components

SHINGLE = 5
PERCENT = 80
#: Rounds of pivots at most; pairs left over are compared in the end whatever their number.
ROUNDS = 4
#: Pairs left over, per index entry, with which the rounds end; they also end when a round leaves more than this share.
LEFT_OVER = 2
STILL_FALLING = 0.7


def shingle_sets(part: pa.RecordBatch, k: int, text: str = "text") -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a batch."""
    cut = wd.words(part.column(text), wd.SPACED, lower=True)
    hashes = wd.window_hashes(cut.hash, k)
    for a, b in zip(cut.first[:-1].tolist(), cut.first[1:].tolist()):
        if b - a >= k:
            found = np.sort(hashes[a : b - k + 1])
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif b > a:
            # The number of words keeps it apart from all other shingles.
            yield wd.mix(wd.window_hashes(cut.hash[a:b], b - a) + np.uint64(b - a))
        else:
            yield hashes[:0]


def _counted(docs: DataFrame, bits: int, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = marks.Gatherer(bits)
        for part in wd.slices(batches):
            sets = list(shingle_sets(part, k))
            yield from out.add(np.concatenate(sets) if sets else np.zeros(0, np.uint64))
        yield from out.flush()

    return docs.select("text").mapInArrow(run, marks.SENT)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def index_prefix(found: np.ndarray, table: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the index entries of a set."""
    size = prefix_length(len(found), percent)
    level = marks.look_up(table, found)
    unique = int((level == 0).sum())
    if unique >= size:
        return found[:0], np.zeros(0, np.int32)
    others = np.flatnonzero(level)
    order = others[np.lexsort((found[others], level[others]))][: size - unique]
    return found[order], np.arange(unique, size, dtype=np.int32)


def text_key() -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64("text")


SETS = "row bigint, doc_id bigint, text_key bigint, n bigint, sig_a bigint, sig_b bigint, hashes array<bigint>, places array<int>, members array<bigint>"


def _sets(docs: DataFrame, table, k: int, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Unique within what the tasks of the stage commit; the rows are written before they are used.
        row = TaskContext.get().partitionId() << 36
        for part in wd.slices(batches):
            n, sig, hashes, places, members = [], [], [], [], []
            empty = np.zeros(0, np.uint64)
            for found in shingle_sets(part, k):
                n.append(len(found))
                sig.append(np.frombuffer(hashlib.md5(found.tobytes(), usedforsecurity=False).digest(), np.int64))
                h, p = index_prefix(found, table.value, percent) if len(found) else (empty, np.zeros(0, np.int32))
                hashes.append(h)
                places.append(p)
                members.append(found if len(h) else empty)
            sig = np.stack(sig)

            def lists(parts: list[np.ndarray], kind) -> pa.Array:
                at = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int32)
                return pa.ListArray.from_arrays(at, pa.array(np.concatenate(parts).astype(kind)))

            yield pa.RecordBatch.from_arrays(
                [pa.array(range(row, row + len(n)), pa.int64()), part.column("doc_id"), part.column("text_key"), pa.array(n, pa.int64()), pa.array(sig[:, 0]), pa.array(sig[:, 1]), lists(hashes, np.int64), lists(places, np.int32), lists(members, np.int64)],
                names=[x.split()[0] for x in SETS.split(", ")],
            )
            row += len(n)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", text_key().alias("text_key")).mapInArrow(run, SETS)


COMPARED = "a bigint, b bigint, shared bigint, na bigint, nb bigint, linked boolean"


def least_overlap(a: Column, b: Column, percent: int) -> Column:
    return F.ceil((a + b) * percent / F.lit(100 + percent))


def _may_link(na: Column, pa_: Column, nb: Column, pb: Column, percent: int) -> Column:
    """Whether sizes, and places of a shared entry that is their first, leave room for a link."""
    sizes = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    return sizes & (F.least(na - pa_, nb - pb) >= least_overlap(na, nb, percent))


def _wanted(sets: DataFrame, pairs: DataFrame, a: str, b: str) -> DataFrame:
    """The sets named in stored pairs. The names are few and are written first, so that Spark need not send all members to find their sets."""
    named = pairs.select(F.explode(F.array(a, b)).alias("s")).distinct()
    return sets.join(stage(named, "wanted"), "s", "left_semi")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b, shared, na, nb, linked`` of stored pairs of sets, from all their members."""
    sets = _wanted(sets, pairs, "a", "b")
    left = sets.select(F.col("s").alias("a"), F.col("members").alias("_a"))
    right = sets.select(F.col("s").alias("b"), F.col("members").alias("_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    counted = both.select("a", "b", F.size(F.array_intersect("_a", "_b")).cast("bigint").alias("shared"), F.size("_a").cast("bigint").alias("na"), F.size("_b").cast("bigint").alias("nb"))
    return counted.withColumn("linked", 100 * F.col("shared") >= percent * (F.col("na") + F.col("nb") - F.col("shared")))


def _both_ways(compared: DataFrame) -> DataFrame:
    apart = (F.col("na") + F.col("nb") - 2 * F.col("shared")).alias("apart")
    there = compared.select(F.col("a").alias("s"), F.col("na").alias("n"), F.col("b").alias("r"), apart)
    return there.unionByName(compared.select(F.col("b").alias("s"), F.col("nb").alias("n"), F.col("a").alias("r"), apart))


def _leaders(heads: DataFrame, compared: DataFrame) -> DataFrame:
    """``s, n, own, label, apart, settled``: each set with its leader, what they differ by, and whether the set has a link."""
    links = _both_ways(compared.filter("linked"))
    known = links.groupBy("s").agg(F.count("*").alias("known"))
    offer = F.max(F.struct("known", (-F.col("r")).alias("r"), "apart")).alias("best")
    offered = links.join(known.withColumnRenamed("s", "r"), "r").groupBy("s").agg(offer)
    led = heads.join(known.join(offered, "s"), "s", "left")
    other = F.coalesce(F.struct(F.col("best.known"), F.col("best.r")) > F.struct(F.col("known"), -F.col("s")), F.lit(False))
    return led.select(
        "s", "n", "own", F.when(other, -F.col("best.r")).otherwise(F.col("s")).alias("label"),
        F.when(other, F.col("best.apart")).otherwise(F.lit(0).cast("bigint")).alias("apart"), F.col("best").isNotNull().alias("settled"),
    )


def _linked_by_differences(single: DataFrame, percent: int) -> DataFrame:
    """``s_a, s_b, size_a, size_b``: pairs of one leader that link by the differences that they share.

    A pair that lacks so much slack has to share so many differences. In the order that all sets of a leader have them in, the
    first shared one then has as many from it on, in both sets; pairs meet in such places only and are counted afterwards.
    """
    own = ["s", "n", "apart", "slack", "size"]
    entries = single.select("label", *own, F.posexplode("differs").alias("place", "h"))
    sides = [entries.select("label", "h", *[F.col(c).alias(f"{c}_{x}") for c in (*own, "place")]) for x in "ab"]
    first = (F.col("slack_a") < F.col("slack_b")) | ((F.col("slack_a") == F.col("slack_b")) & (F.col("s_a") < F.col("s_b")))
    room = (100 + percent) * F.abs(F.col("apart_a") - F.col("apart_b")) <= (100 - percent) * (F.col("n_a") + F.col("n_b"))
    lacking = -(F.col("slack_a") + F.col("slack_b"))
    left = F.least(F.col("apart_a") - F.col("place_a"), F.col("apart_b") - F.col("place_b"))
    met = sides[0].filter("slack_a < 0").join(sides[1], ["label", "h"]).filter(first & room & (lacking > 0) & (2 * (100 + percent) * left >= lacking))
    met = met.select("s_a", "s_b", "size_a", "size_b", lacking.alias("lacking")).distinct()
    for x in "ab":
        met = met.join(single.select(F.col("s").alias(f"s_{x}"), F.col("differs").alias(f"differs_{x}")), f"s_{x}")
    shared = F.size(F.array_intersect("differs_a", "differs_b"))
    return met.filter(2 * (100 + percent) * shared >= F.col("lacking")).select("s_a", "s_b", "size_a", "size_b")


def _within_groups(led: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``s, c``: in one or more parts, how many rows of other sets with the same leader a set links with.

    ``slack`` is what the difference to the leader leaves of the set's half of the difference that a link allows.
    """
    # Totals from above, at each slack and at the one that just makes up for it. A group has as many different values of
    # slack as sizes and differences allow, which is less than three times the shingles of its leader.
    at = led.select("label", "slack", "size").unionByName(led.select("label", (-F.col("slack")).alias("slack"), F.lit(0).cast("bigint").alias("size")))
    down = Window.partitionBy("label").orderBy(F.desc("slack")).rowsBetween(Window.unboundedPreceding, 0)
    totals = at.groupBy("label", "slack").agg(F.sum("size").alias("c")).select("label", (-F.col("slack")).alias("slack"), F.sum("c").over(down).alias("c"))
    own = F.when(F.col("slack") >= 0, F.col("size")).otherwise(0)
    sure = led.join(totals, ["label", "slack"]).select("s", (F.col("c") - own).alias("c"))

    # Differences from the leader, of groups that have a pair without enough slack.
    open_groups = led.groupBy("label").agg(F.min("slack").alias("least")).filter("least < 0")
    far = stage(led.join(open_groups, "label").filter("s != label"), "far")
    sets = _wanted(sets, far, "s", "label")
    members = far.join(sets, "s").join(sets.select(F.col("s").alias("label"), F.col("members").alias("_l")), "label")
    # Those that the leader lacks first: hardly two sets share one.
    differs = F.concat(F.sort_array(F.array_except("members", "_l")), F.sort_array(F.array_except("_l", "members")))
    single = stage(members.select("label", "s", "n", "apart", "slack", "size", differs.alias("differs")), "differences")
    both = stage(_linked_by_differences(single, percent), "derived")
    return sure.unionByName(both.select(F.col("s_a").alias("s"), F.col("size_b").alias("c"))).unionByName(both.select(F.col("s_b").alias("s"), F.col("size_a").alias("c")))


def _left_over(index: DataFrame) -> tuple[int, int]:
    """Pairs of entries with different labels, over all lists, and the number of entries."""
    per = index.groupBy("h", "label").agg(F.count("*").alias("c")).groupBy("h")
    pairs = per.agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"))
    left, size = pairs.agg(F.sum((F.col("s") * F.col("s") - F.col("q")) / 2), F.sum("s")).first()
    return int(left or 0), size or 0


def _against_pivots(index: DataFrame, number: int, percent: int) -> DataFrame:
    """Pairs of each list's pivot of this round with the sets of other labels."""
    first = [F.col("settled"), (F.col("own") / F.col("n")).alias("share"), F.xxhash64("s", F.lit(number)).alias("o")]
    order = F.struct(*first, F.col("s").alias("pivot"), F.col("n").alias("pn"), F.col("place").alias("pp"), F.col("label").alias("pl"))
    pivots = index.groupBy("h").agg(F.min(order).alias("p"), F.min("label").alias("x"), F.max("label").alias("y")).filter("x != y").select("h", "p.pivot", "p.pn", "p.pp", "p.pl")
    met = index.join(pivots, "h").filter(F.col("label") != F.col("pl"))
    met = met.filter(_may_link(F.col("n"), F.col("place"), F.col("pn"), F.col("pp"), percent))
    return met.select(F.least("s", "pivot").alias("a"), F.greatest("s", "pivot").alias("b")).distinct()


def _between_blocks(index: DataFrame, tested: DataFrame | None, percent: int) -> DataFrame:
    """All remaining pairs of sets of different labels that share an index entry and may link."""
    # A block holds entries of one label and list whose sizes and places differ by a few percent only.
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent + 1e-9))).cast("bigint")
    fine = F.floor(20 * F.log("n")).cast("bigint")
    depth = F.floor(50 * F.col("place") / F.col("n")).cast("bigint")
    entries = index.select("h", "s", "n", "place", "label", band.alias("band"), fine.alias("fine"), depth.alias("depth"))
    key = ["h", "label", "band", "fine", "depth"]
    blocks = entries.groupBy(*key).agg(F.min("place").alias("place"), F.min("n").alias("least"), F.max("n").alias("most"))
    left = blocks.select("h", *[F.col(c).alias(f"{c}_a") for c in blocks.columns[1:]])
    near = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))
    right = blocks.select("h", near.alias("band_a"), *[F.col(c).alias(f"{c}_b") for c in blocks.columns[1:]])
    room = F.least(F.col("most_a") - F.col("place_a"), F.col("most_b") - F.col("place_b")) >= least_overlap(F.col("least_a"), F.col("least_b"), percent)
    sizes = (100 * F.col("most_a") >= percent * F.col("least_b")) & (100 * F.col("most_b") >= percent * F.col("least_a"))
    met = left.join(right, ["h", "band_a"]).filter((F.col("label_a") < F.col("label_b")) & room & sizes)
    met = met.select("h", *[f"{c}_{side}" for side in "ab" for c in key[1:]])
    for side in "ab":
        own = entries.select("h", *[F.col(c).alias(f"{c}_{side}") for c in (*key[1:], "s", "n", "place")])
        met = met.join(own, ["h", *[f"{c}_{side}" for c in key[1:]]])
    met = met.filter(_may_link(F.col("n_a"), F.col("place_a"), F.col("n_b"), F.col("place_b"), percent))
    pairs = met.select(
        F.least("s_a", "s_b").alias("a"), F.greatest("s_a", "s_b").alias("b"), (F.col("n_a") + F.col("n_b")).alias("both")
    ).distinct()
    if tested is None:
        return pairs.select("a", "b")
    done = tested.select("a", "b")
    pairs = pairs.join(done, ["a", "b"], "left_anti")
    # A set that one of the two is close to, and what comparing it with the other has told.
    both_ways = _both_ways(tested).drop("n")
    close = both_ways.groupBy("s").agg(F.min(F.struct("apart", "r")).alias("c")).select(F.col("s").alias("a"), F.col("c.r").alias("r"), F.col("c.apart").alias("near"))
    told = both_ways.select(F.col("s").alias("b"), "r", F.col("apart").alias("far")).distinct()
    known = pairs.join(close, "a", "left").join(told, ["b", "r"], "left")
    ruled_out = (100 + percent) * (F.col("far") - F.col("near")) > (100 - percent) * F.col("both")
    return known.filter(~F.coalesce(ruled_out, F.lit(False))).select("a", "b").distinct()


def _related(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``doc_id, text_key, n, class_id, component_id, root, n_links`` per row; ``root`` names the component, null for a row alone."""
    spark = docs.sparkSession
    bits = marks.range_bits(docs)
    with small_batches(spark):
        table = marks.mark_table(_counted(docs, bits, k), bits, marks.levels_of_counts)
        sets = stage(_sets(docs, table, k, percent), "sets")
    table.destroy()
    let_go(spark)
    own = sets.select("row", "doc_id", "text_key", "n", "sig_a", "sig_b")
    # A class is named by one of its rows, ``s``.
    first = F.min(F.struct("doc_id", "row")).alias("first")
    grouped = own.filter("n > 0 and doc_id is not null").groupBy("sig_a", "sig_b").agg(first, F.count("*").alias("size"))
    classes = stage(grouped.select("sig_a", "sig_b", F.col("first.row").alias("s"), F.col("first.doc_id").alias("class_id"), "size"), "classes")

    listed = sets.filter(F.size("hashes") > 0).withColumnRenamed("row", "s")
    firsts = listed.select("s", "n", "hashes", "places").join(classes.select("s"), "s", "left_semi")
    entries = firsts.select("s", "n", F.inline(F.arrays_zip(F.col("hashes").alias("h"), F.col("places").alias("place")))).withColumnRenamed("hashes", "h").withColumnRenamed("places", "place")
    shared = entries.groupBy("h").agg(F.min("s").alias("x"), F.max("s").alias("y")).filter("x != y").select("h")
    index = stage(entries.join(shared, "h", "left_semi"), "index")
    # ``own``: the places before a set's first entry are shingles that no other set has in its index.
    heads = stage(index.groupBy("s", "n").agg(F.min("place").alias("own")), "heads")
    kept_sets = stage(listed.select("s", "members").join(heads.select("s"), "s", "left_semi"), "indexed-sets")
    let_go(spark)

    labels = heads.select("s", "n", "own", F.col("s").alias("label"), F.lit(0).cast("bigint").alias("apart"), F.lit(False).alias("settled"))
    tested: list[str] = []

    def all_tested() -> DataFrame:
        return spark.read.schema(COMPARED).parquet(*tested)

    def compare(pairs: DataFrame) -> None:
        tested.append(scratch_path(spark, "compared"))
        _verified(stage(pairs, "pairs"), kept_sets, percent).write.parquet(tested[-1])
        let_go(spark)

    left_before = float("inf")
    for number in range(ROUNDS + 1):
        labelled = stage(index.drop("n").join(labels.drop("apart"), "s"), "index")
        left, size = _left_over(labelled)
        if number == ROUNDS or left <= LEFT_OVER * size or left > STILL_FALLING * left_before:
            break
        left_before = left
        pairs = _against_pivots(labelled, number, percent)
        if tested:
            pairs = pairs.join(all_tested().select("a", "b"), ["a", "b"], "left_anti")
        compare(pairs)
        labels = stage(_leaders(heads, all_tested()), "labels")
        let_go(spark)
    compare(_between_blocks(labelled, all_tested() if tested else None, percent))

    slack = ((100 - percent) * F.col("n") - (100 + percent) * F.col("apart")).alias("slack")
    led = stage(labels.join(classes.select("s", "size"), "s").select("s", "label", "n", "apart", slack, "size"), "led")
    sides = [led.select(F.col("s").alias(x), F.col("label").alias(f"l{x}"), F.col("size").alias(f"size_{x}")) for x in "ab"]
    across = stage(all_tested().filter("linked").select("a", "b").join(sides[0], "a").join(sides[1], "b").filter("la != lb"), "across")
    other = across.select(F.col("a").alias("s"), F.col("size_b").alias("c")).unionByName(across.select(F.col("b").alias("s"), F.col("size_a").alias("c")))
    others = other.unionByName(_within_groups(led, kept_sets, percent)).groupBy("s").agg(F.sum("c").alias("others"))
    counted = led.join(others, "s", "left")
    let_go(spark)
    reached = components(across, "la", "lb").select(F.col("node").alias("label"), "component")
    let_go(spark)
    placed = counted.join(reached, "label", "left").select(
        "s", F.coalesce("component", "label").alias("root"), (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("linked")
    )
    known = stage(classes.join(placed, "s", "left").select("sig_a", "sig_b", "class_id", F.coalesce("root", "s").alias("root"), F.coalesce("linked", F.col("size") - 1).alias("n_links")), "known")
    least = known.groupBy("root").agg(F.min("class_id").alias("component_id"))

    own = own.withColumn("alone", (F.col("n") == 0) | F.col("doc_id").isNull())
    joined = own.filter("not alone").join(known.join(least, "root"), ["sig_a", "sig_b"])
    names = ["doc_id", "text_key", "n", "class_id", "component_id", "root", "n_links"]
    alone = own.filter("alone").withColumn("root", F.lit(None).cast("bigint")).withColumn("n_links", F.lit(0).cast("bigint"))
    return joined.select(names).unionByName(alone.withColumn("class_id", F.col("doc_id")).withColumn("component_id", F.col("doc_id")).select(names))


def similar_sets(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document row: ``doc_id, n_shingles, class_id, component_id, n_links``.

    ``class_id`` is the smallest document with the same set, ``component_id`` the smallest one reachable by links, ``n_links``
    the number of other rows that the row links with, equal sets included.
    """
    return _related(docs, k, percent).select("doc_id", F.col("n").alias("n_shingles"), "class_id", "component_id", "n_links")


def one_of_each(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Of each component the row with the smallest id; rows with a null id stay, and so do all different texts that do not link.

    Of rows that share the id and link, or are without words, one stays.
    """
    own = fresh(docs, "kept_id", "kept_text")
    rows = _related(docs, k, percent).filter("doc_id is not null")
    one = F.min(F.struct("doc_id", "text_key")).alias("one")
    linked = rows.filter("root is not null").groupBy("root").agg(one).select("one.*")
    wordless = rows.filter("root is null").groupBy("doc_id").agg(F.min("text_key").alias("text_key"))
    first = linked.unionByName(wordless).select(F.col("doc_id").alias(own["kept_id"]), F.col("text_key").alias(own["kept_text"]))
    keyed = docs.filter("doc_id is not null")
    same = (F.col(own["kept_id"]) == F.col("doc_id").cast("bigint")) & (F.col(own["kept_text"]) == text_key())
    kept = keyed.join(first, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.filter("doc_id is null"))
