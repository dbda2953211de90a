"""Text to overlapping chunks, inside each row: no shuffle, and no Python unless a user function asks for it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import CHUNK_OVERLAP, CHUNK_SIZE, SENTENCE_GAP, chunk_key, words


def window_count(n: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """How many chunks ``window_chunks`` makes of ``n`` words."""
    step = size - overlap
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.ceil((n - overlap) / step)).cast("int"))


def _starts(count: Column) -> Column:
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def window_chunks(
    df: DataFrame, text: str, out: str = "chunks", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """Add an array of chunks of at most ``size`` words; neighbours share ``overlap`` words."""
    step = size - overlap
    split = df.withColumn("_words", words(F.col(text)))
    count = window_count(F.size("_words"), size, overlap)
    chunks = F.transform(
        _starts(count), lambda i: F.array_join(F.slice("_words", i * step + 1, F.lit(size)), " ")
    )
    return split.withColumn(out, chunks).drop("_words")


def packed_chunks(
    df: DataFrame, text: str, out: str = "chunks", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """Add an array of chunks made of whole sentences, at most ``size`` words each.

    Neighbours share the last sentences of the earlier chunk, as many as fit in
    ``overlap`` words. A sentence above ``size`` words is cut into pieces of
    ``overlap`` words first, so the same rule gives it overlapping chunks.

    One fold over the sentence lengths finds the bounds; the text is put together after it.
    """
    piece = overlap or size

    def cut(w: Column) -> Column:
        pieces = F.transform(
            F.sequence(F.lit(0), (F.ceil(F.size(w) / piece) - 1).cast("int")),
            lambda i: F.slice(w, i * piece + 1, F.lit(piece)),
        )
        return F.when(F.size(w) > size, pieces).otherwise(F.array(w))

    sentence_words = F.filter(
        F.transform(F.split(F.col(text), SENTENCE_GAP), words), lambda w: F.size(w) > 0
    )
    units = df.withColumn("_sentences", sentence_words)
    units = units.withColumn("_units", F.flatten(F.transform("_sentences", cut)))
    units = units.withColumn("_lengths", F.transform("_units", F.size))

    def carried(i: Column, room: Column) -> Column:
        """How many units before ``i`` fit in ``room`` words, and their words. A unit has at least one word."""
        back = F.reverse(F.slice("_lengths", F.greatest(i - overlap, F.lit(0)) + 1, F.least(F.lit(overlap), i)))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("w"), F.lit(True).alias("open"))
        return F.aggregate(
            back,
            start,
            lambda acc, length: F.when(
                acc["open"] & (acc["w"] + length <= room),
                F.struct((acc["n"] + 1).alias("n"), (acc["w"] + length).alias("w"), F.lit(True).alias("open")),
            ).otherwise(F.struct(acc["n"].alias("n"), acc["w"].alias("w"), F.lit(False).alias("open"))),
        )

    def state(first: Column, total: Column, closed: Column) -> Column:
        return F.struct(first.alias("first"), total.alias("total"), closed.alias("closed"))

    def add(acc: Column, unit: Column) -> Column:
        closed = F.concat(
            acc["closed"], F.array(F.struct(acc["first"].alias("from"), unit["i"].alias("to")))
        )
        room = F.least(F.lit(overlap), F.lit(size) - unit["n"])
        opened = F.transform(
            F.array(carried(unit["i"], room)),
            lambda c: state(unit["i"] - c["n"], c["w"] + unit["n"], closed),
        )[0]
        return F.when(
            acc["total"] + unit["n"] <= size, state(acc["first"], acc["total"] + unit["n"], acc["closed"])
        ).otherwise(opened)

    numbered = F.transform("_lengths", lambda n, i: F.struct(n.alias("n"), i.alias("i")))
    empty = state(F.lit(0), F.lit(0), F.array().cast("array<struct<from:int,to:int>>"))
    bounds = F.aggregate(
        numbered,
        empty,
        add,
        lambda acc: F.concat(
            acc["closed"],
            F.array(F.struct(acc["first"].alias("from"), F.size("_lengths").alias("to"))),
        ),
    )
    packed = units.withColumn(
        "_bounds",
        F.when(F.size("_lengths") > 0, bounds).otherwise(F.array().cast("array<struct<from:int,to:int>>")),
    )
    chunks = F.transform(
        "_bounds",
        lambda b: F.array_join(F.flatten(F.slice("_units", b["from"] + 1, b["to"] - b["from"])), " "),
    )
    return packed.withColumn(out, chunks).drop("_sentences", "_units", "_lengths", "_bounds")


def python_chunks(
    df: DataFrame, text: str, splitter: Callable[[], Callable[[str], list[str]]], out: str = "chunks"
) -> DataFrame:
    """Add an array of chunks made by a user function.

    ``splitter`` runs once per task and returns the function that splits one text,
    so a tokenizer or model is loaded once and then serves the whole stream of batches.
    """

    @F.pandas_udf("array<string>")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        split_one = splitter()
        for batch in batches:
            yield batch.map(lambda t: [] if t is None else split_one(t))

    return df.withColumn(out, split(F.col(text)))


def chunk_rows(df: DataFrame, doc_id: str, keep: list[str] | None = None, chunks: str = "chunks") -> DataFrame:
    """One row per chunk with its number and key; a document without chunks gives no row.

    The outer form with a filter after it is on purpose: for the plain form Spark adds
    ``size(chunks) > 0`` below the projection and would so compute the chunks twice.
    """
    rows = df.select(doc_id, *(keep or []), F.posexplode_outer(chunks).alias("chunk_no", "content"))
    return rows.where("chunk_no IS NOT NULL").select(
        chunk_key(F.col(doc_id), F.col("chunk_no")).alias("key"), doc_id, "chunk_no", *(keep or []), "content"
    )


def neighbour_overlap(df: DataFrame, doc_id: str, chunks: str = "chunks") -> DataFrame:
    """Words each chunk shares with the end of the one before: the most for which end and beginning are equal.

    The search goes up to the length of the shorter chunk, whatever the chunker meant to repeat.
    """
    split = df.withColumn("_parts", F.transform(chunks, words))

    def shared(prev: Column, this: Column) -> Column:
        lengths = F.sequence(F.lit(0), F.least(F.size(prev), F.size(this)))
        fits = F.filter(
            lengths,
            # The first words are compared before any list is cut out.
            lambda m: (m == 0)
            | ((F.get(this, F.lit(0)) == F.get(prev, F.size(prev) - m)) & (F.slice(this, F.lit(1), m) == F.slice(prev, F.size(prev) - m + 1, m))),
        )
        return F.array_max(fits)

    later = F.when(F.size("_parts") > 1, F.sequence(F.lit(2), F.size("_parts")))
    pairs = F.transform(
        later,
        lambda i: F.struct(
            (i - 1).alias("chunk_no"),
            shared(F.element_at("_parts", i - 1), F.element_at("_parts", i)).alias("shared_words"),
        ),
    )
    return split.select(doc_id, F.inline_outer(pairs)).where("chunk_no IS NOT NULL")


def context_fit(df: DataFrame, doc_id: str, limit: int, chunks: str = "chunks") -> DataFrame:
    """Per document: chunks, chunks above ``limit`` words, and the longest chunk."""
    sized = df.withColumn("_sizes", F.transform(chunks, lambda c: F.size(words(c))))
    return sized.select(
        doc_id,
        F.size("_sizes").alias("n_chunks"),
        F.size(F.filter("_sizes", lambda n: n > limit)).alias("n_too_long"),
        F.coalesce(F.array_max("_sizes"), F.lit(0)).alias("longest"),
    )
