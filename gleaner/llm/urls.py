"""URL rules with redirect equivalence.

A url is judged by its longest fitting rule. A url that no rule fits takes the decision of its aliases: urls
that redirect to each other, name each other as canonical, or differ only in how the same page is written.
Alias groups are connected components of the edge table. An explicit allow takes precedence: a group that
holds an allowed url passes no block on, and an allowed url is never blocked by its group.

Native DataFrame functions only. Defined results: a null url or one without ``://`` has empty host and path,
fits no rule and has no alias; it is allowed. Repeated pages and urls are judged alike, every input row gives
one row. Page ids need not be unique. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import lower_ascii, stage
from gleaner.llm.components import components

#: Parameters that only track where a visit came from.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"

CANONICAL_TAG = r"""(?is)<link\b[^>]*?\brel\s*=\s*["']?canonical["']?[^>]*>"""
REFRESH_TAG = r"""(?is)<meta\b[^>]*?\bhttp-equiv\s*=\s*["']?refresh["']?[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH_URL = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased."""
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(lower_ascii(after), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def same_page_form(url: Column) -> Column:
    """How a site would write the url itself: no scheme, ``www.`` or ``m.``, fragment, tracking or closing slash.

    Null for a url that has no host.
    """
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    asked = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.sort_array(kept), "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, asked))


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``src, dst``: edges of canonical links and refresh redirects that stand in the pages. Only absolute targets count."""
    canonical = F.regexp_extract(F.regexp_extract(F.col(html), CANONICAL_TAG, 0), HREF, 1)
    refresh = F.regexp_extract(F.regexp_extract(F.col(html), REFRESH_TAG, 0), REFRESH_URL, 1)
    targets = pages.select(F.col(url).alias("src"), F.explode(F.array(canonical, refresh)).alias("dst"))
    return targets.filter(F.col("src").contains("://") & F.col("dst").contains("://"))


def apply_rules(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Distinct urls with ``host, path, rule, rule_verdict``; the last two null where no rule fits.

    Every suffix of the host at a dot is looked up in the rules, so the work does not grow with urls times rules.
    The longest rule wins; rules of equal length: allow first, then by text.
    """
    named = urls.select(F.col(url).alias("url")).distinct().select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    suffixes = F.expr(r"transform(sequence(1, size(split(host, '[.]'))), i -> substring_index(host, '.', -i))")
    asked = named.filter("host != ''").select("url", "path", F.explode(F.array_distinct(suffixes)).alias("_at"))
    known = rules.select(
        F.col("host").alias("_at"), F.col("path").alias("_under"), F.col("verdict").alias("_says"),
        F.concat("host", "path").alias("_rule"),
    ).filter("_at is not null and _under is not null and _says in ('allow', 'block')")
    fits = asked.join(known, "_at").filter(F.startswith("path", F.col("_under")))
    rank = F.struct(F.length("_rule").alias("n"), (F.col("_says") == "allow").alias("allow"), F.col("_rule").alias("rule"), F.col("_says").alias("says"))
    best = fits.groupBy("url").agg(F.max(rank).alias("_best"))
    found = named.join(best, "url", "left")
    return found.select("url", "host", "path", F.col("_best.rule").alias("rule"), F.col("_best.says").alias("rule_verdict"))


def judge_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, url: str = "url", html: str | None = "html") -> DataFrame:
    """Distinct urls with ``host, path, rule, verdict, alias_group``.

    ``redirects`` (``src, dst``) adds observed redirects to the links found in the pages. ``alias_group`` is the
    smallest same-page form of the group, null for a url without host.
    """
    seen = pages.select(F.col(url).alias("url"))
    edges = link_edges(pages, url, html) if html else None
    if redirects is not None:
        moved = redirects.select("src", "dst").filter(F.col("src").contains("://") & F.col("dst").contains("://"))
        edges = moved if edges is None else edges.unionByName(moved)
    if edges is not None:
        edges = stage(edges.distinct(), "url-links")
        # A url that is only a link's end still hands its rule on.
        seen = seen.unionByName(edges.select(F.col("src").alias("url"))).unionByName(edges.select(F.col("dst").alias("url")))
    ruled = stage(apply_rules(seen.filter("url is not null"), rules).withColumn("form", same_page_form(F.col("url"))), "url-rules")
    if edges is None:
        grouped = ruled.withColumn("alias_group", F.col("form"))
    else:
        joined = components(edges.select(same_page_form(F.col("src")).alias("a"), same_page_form(F.col("dst")).alias("b")), "a", "b")
        groups = joined.select(F.col("node").alias("form"), F.col("component").alias("_group"))
        grouped = ruled.join(groups, "form", "left").withColumn("alias_group", F.coalesce("_group", "form")).drop("_group")
    # Only groups with a rule pass anything on: reduced before the join.
    passed = (
        grouped.filter("rule is not null and alias_group is not null")
        .groupBy("alias_group")
        .agg(F.max(F.col("rule_verdict") == "allow").alias("_allows"), F.max(F.col("rule_verdict") == "block").alias("_blocks"))
        .filter("_blocks and not _allows")
        .select("alias_group", F.lit("block").alias("_passed"))
    )
    verdict = F.coalesce("rule_verdict", "_passed", F.lit("allow"))
    return grouped.join(passed, "alias_group", "left").select("url", "host", "path", "rule", verdict.alias("verdict"), "alias_group")


def judge_pages(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, alias_group``."""
    judged = judge_urls(pages, rules, redirects)
    rows = pages.select("page_id", "url").join(judged, "url", "left")
    return rows.select(
        "page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
        "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"), "alias_group",
    )


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as a table: (host, path, ``allow`` or ``block``)."""
    listed = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    made = F.array(*listed) if listed else F.array().cast("array<struct<host:string,path:string,verdict:string>>")
    return spark.range(1).select(F.inline(made))
