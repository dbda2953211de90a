"""Column expressions on text. All of them are built-in Spark functions and run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning patterns and the default chunk sizes the results depend on.
LINE_BREAK = "\n"
DOT_WITH_SPACE = r" ?\."
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50
ANSWER_TOKENS = 300

SENTENCE_GAP = r"(?<=[.!?])\s+"
NOT_A_TERM = r"[^\p{L}\p{N}]+"


def clean_section(text: Column, keep_space: bool = False) -> Column:
    """Remove line breaks, then the one space a parser leaves before a full stop.

    The default joins the words around a line break, as the compared results do;
    ``keep_space=True`` leaves a space there.
    """
    flat = F.replace(text, F.lit(LINE_BREAK), F.lit(" " if keep_space else ""))
    return F.regexp_replace(flat, DOT_WITH_SPACE, ".")


def join_sections(sections: Column, keep_space: bool = False) -> Column:
    """Clean every section and join them with a line break."""
    cleaned = F.transform(sections, lambda s: clean_section(s, keep_space))
    return F.array_join(cleaned, LINE_BREAK)


def text_sections(text: Column) -> Column:
    return F.split(text, LINE_BREAK)


def core_text(text: Column) -> Column:
    """Plain text to cleaned text, section by section."""
    return join_sections(text_sections(text))


def words(text: Column) -> Column:
    """Whitespace tokens, without empty ones."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def token_count(text: Column) -> Column:
    return F.size(words(text))


def terms(text: Column) -> Column:
    """Lower-cased runs of letters and digits of any script."""
    return F.filter(F.split(F.lower(text), NOT_A_TERM), lambda t: t != "")


def sentences(text: Column) -> Column:
    """Split after a full stop, exclamation or question mark that is followed by space."""
    return F.filter(F.split(text, SENTENCE_GAP), lambda s: F.trim(s) != "")


def first_words(text: Column, n: int) -> Column:
    return F.array_join(F.slice(words(text), 1, n), " ")


def hex_number(text: Column, start: int, digits: int) -> Column:
    """Some hex digits of the md5 of a text as a number; 15 digits are 60 bits and fit a bigint."""
    return F.conv(F.substring(F.md5(text), start, digits), 16, 10).cast("bigint")


def chunk_key(doc_id: Column, chunk_no: Column) -> Column:
    """Primary key of a chunk, the same on every run and in every table."""
    return hex_number(F.concat_ws(":", doc_id.cast("string"), chunk_no.cast("string")), 1, 15)


def name_bucket(name: Column, buckets: int = 9) -> Column:
    """Stable bucket 1..n of a name: the sum of its character codes, modulo n, plus one."""
    letters = F.filter(F.split(name, ""), lambda c: c != "")
    total = F.aggregate(letters, F.lit(0).cast("bigint"), lambda acc, c: acc + F.ascii(c))
    return (total % buckets + 1).cast("int")


def share_of(part: Column, whole: Column) -> Column:
    """Share of the distinct elements of ``whole`` that also stand in ``part``; 0 for an empty ``whole``."""
    return F.when(
        F.size(whole) > 0,
        F.round(F.size(F.array_intersect(whole, part)) / F.size(F.array_distinct(whole)), 6),
    ).otherwise(F.lit(0.0))
