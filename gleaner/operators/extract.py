"""File bytes to text, and text to its core lines."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import LINE_BREAK, join_sections, token_count
from gleaner.session import staged

# HTML parts without text, tags that end a section, and the common character references.
HTML_HIDDEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
HTML_SECTION_END = r"(?i)</?(p|div|h[1-6]|li|ul|ol|tr|td|th|table|title|br|hr|nav|footer|header|section|article)[^>]*>"
HTML_TAG = r"<[^>]*>"
HTML_REFERENCES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]

# A line of a table of contents ends in dot leaders and a page number.
CONTENTS_LINE = r"\.{3,}\s*\d+\s*$"
CORE_MIN_WORDS = 3


def decoded(content: Column) -> Column:
    """Bytes to text; bytes that are not UTF-8 become replacement characters instead of an error."""
    return F.make_valid_utf8(content.cast("string"))


def html_sections(html: Column) -> Column:
    """Visible text of a page, one element per block."""
    text = F.regexp_replace(html, HTML_HIDDEN, "")
    text = F.regexp_replace(text, HTML_SECTION_END, LINE_BREAK)
    text = F.regexp_replace(text, HTML_TAG, "")
    for name, character in HTML_REFERENCES:
        text = F.replace(text, F.lit(name), F.lit(character))
    return F.filter(F.transform(F.split(text, LINE_BREAK), lambda s: F.trim(s)), lambda s: s != "")


def html_text(html: Column) -> Column:
    return join_sections(html_sections(html))


def extract_with(
    raw: DataFrame, path: str, content: str, parser: Callable[[], Callable[[bytes], list[str]]], out: str = "text"
) -> DataFrame:
    """(path, text) by a user parser for any file format.

    ``parser`` runs once per task and returns the function from bytes to sections. Bytes
    are large, so set ``spark.sql.execution.arrow.maxRecordsPerBatch`` low for this job.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parse = parser()
        for frame in frames:
            yield pd.DataFrame({"path": frame["path"], "sections": [parse(b) for b in frame["content"]]})

    source = raw.select(F.col(path).alias("path"), F.col(content).alias("content"))
    sections = source.mapInPandas(run, "path string, sections array<string>")
    return sections.select("path", join_sections(F.col("sections")).alias(out))


def core_lines(
    df: DataFrame, doc_id: str, text: str, max_share: float, min_words: int = CORE_MIN_WORDS
) -> DataFrame:
    """(doc_id, lines): the lines of a text without short, contents-like and boilerplate ones.

    Boilerplate is a line that stands in more than a share ``max_share`` of the documents, so the rule means the same
    for any size. Only line hashes are shuffled to find it; the texts meet their own list of boilerplate hashes at the
    end. The hashes of a frequent line are a skewed join key, which adaptive execution splits.
    """

    def line_id(line: Column) -> Column:
        return F.struct(F.xxhash64(line).alias("a"), F.crc32(line).alias("b"))

    own = F.transform(F.split(text, LINE_BREAK), lambda s: F.trim(s))
    core = F.filter(own, lambda s: (token_count(s) >= min_words) & ~F.rlike(s, F.lit(CONTENTS_LINE)))
    lines = df.select(doc_id, core.alias("_core"))
    ids = lines.select(doc_id, F.explode_outer(F.array_distinct(F.transform("_core", line_id))).alias("_id"))
    ids = ids.where(F.col("_id").isNotNull())
    most = max_share * df.count()
    common = ids.groupBy("_id").agg(F.count("*").alias("_docs")).where(F.col("_docs") > most).select("_id")
    # Both are small next to the texts; written out, Spark knows their size and can broadcast them.
    hits = ids.join(staged(common, "common-lines"), "_id")
    dropped = staged(hits.groupBy(doc_id).agg(F.collect_list("_id").alias("_drop")), "dropped-lines")
    joined = lines.join(dropped, doc_id, "left")
    kept = F.filter("_core", lambda s: ~F.array_contains(F.col("_drop"), line_id(s)))
    return joined.select(
        doc_id, F.when(F.col("_drop").isNull(), F.col("_core")).otherwise(kept).alias("lines")
    )
