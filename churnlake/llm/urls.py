"""URL filter with redirect equivalence.

Rules name a host and a path prefix. A page's own longest rule decides. Pages without a rule
take the decision of their aliases: redirects and canonical links connect URLs, and a block
reaches every URL of a connected component that has no rule of its own. An explicit allow
always stands against a block that comes over a link.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm.components import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_TARGET = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """A URL as a node: without fragment, host in lower case. Null without ``://``."""
    plain = F.regexp_replace(url, r"#[\s\S]*\z", "")
    start = F.regexp_extract(plain, r"^([\s\S]*?://)", 1)
    rest = F.regexp_extract(plain, r"^[\s\S]*?://[^/?]*([\s\S]*)\z", 1)
    return F.when(F.instr(plain, "://") > 0, F.concat(start, host_of(plain), rest))


def _without_dots(path: Column) -> Column:
    """A path that starts with a slash, with ``.`` and ``..`` segments resolved."""
    segments = F.split(path, "/")

    def take(kept: Column, s: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(s == ".", kept).when(s == "..", up).otherwise(F.concat(kept, F.array(s)))

    inner = F.slice(segments, F.lit(2), F.size(segments))
    kept = F.aggregate(inner, F.array().cast("array<string>"), take)
    folder = F.element_at(segments, -1).isin(".", "..")  # such an end names a folder
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(folder & (F.size(kept) > 0), "/").otherwise(""))


def _absolute(url: Column, href: Column) -> Column:
    """``href`` as seen from ``url``, as RFC 3986 resolves references; a fragment goes."""
    href = F.regexp_replace(F.regexp_replace(href, "&amp;", "&"), r"#[\s\S]*\z", "")
    scheme = F.regexp_extract(url, r"^([\s\S]*?)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(url))
    own = F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url))
    query = F.regexp_extract(F.regexp_replace(url, r"#[\s\S]*\z", ""), r"\?[\s\S]*\z", 0)
    folder = F.regexp_replace(own, r"[^/]*\z", "")
    path = F.regexp_extract(href, r"^[^?]*", 0)
    asked = F.regexp_extract(href, r"\?[\s\S]*\z", 0)
    at = F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))  # another scheme: no page
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href == "", F.concat(site, own, query))  # the page itself
        .when(path == "", F.concat(site, own, asked))
        .otherwise(F.concat(site, _without_dots(at), asked))
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """``(a, b)``: redirects and canonical links found in ``pages (url, html)``."""
    tags = F.array(
        F.regexp_extract(F.regexp_extract("html", _CANONICAL, 0), _HREF, 1),
        F.regexp_extract(F.regexp_extract("html", _REFRESH, 0), _TARGET, 1),
    )
    found = pages.filter("url is not null and html is not null").select("url", F.explode(tags).alias("href"))
    ends = found.filter("href <> ''").select(
        node_of(F.col("url")).alias("a"), node_of(_absolute(F.col("url"), F.col("href"))).alias("b")
    )
    return ends.filter("a is not null and b is not null and a <> b")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(url, rule, action)`` for each distinct url of ``urls`` that a rule fits.

    A rule fits its host and all subdomains if the path starts with the rule's path. The
    longest rule wins, allow before block among equally long ones. A url is looked up under
    each suffix of its host, so rules may be many.
    """
    parts = urls.select("url").filter("url is not null").distinct().select("url", host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"))
    labels = F.split("h", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    told = rules.select(
        F.translate("host", _UPPER, _LOWER).alias("suffix"), F.col("path").alias("start"), "action"
    )
    fits = (
        parts.filter("h <> ''")
        .select("url", "p", F.explode(suffixes).alias("suffix"))
        .join(told, "suffix")
        .filter(F.col("p").startswith(F.col("start")))
    )
    rule = F.concat("suffix", "start")
    best = F.max(F.struct(F.length(rule), F.col("action") == "allow", rule.alias("rule"), "action"))
    return fits.groupBy("url").agg(best.alias("best")).select("url", "best.rule", "best.action")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, component`` per row of ``pages``.

    ``rules (action, host, path)`` with action allow or block; ``redirects (url, target)``
    adds known redirects to those in the html. ``component`` is the smallest URL of the
    page's equivalents, itself included; null without ``://``. Such pages, and null urls,
    have an empty host and path, fit no rule and are allowed. Rows with one url are judged
    alike. An empty table gives no rows.
    """
    base = pages.select("page_id", "url", "html")
    edges = link_edges(base)
    if redirects is not None:
        known = redirects.select(node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b"))
        edges = edges.union(known)
    linked = components(edges)
    # A component's smallest node is no row of ``linked``; it stands for itself.
    members = linked.union(linked.select("component", "component").distinct())
    own = match_rules(members.select(F.col("node").alias("url")), rules)
    blocked = (
        members.join(own.filter("action = 'block'"), F.col("node") == F.col("url"))
        .select(F.col("component").alias("c"))
        .distinct()
        .withColumn("block", F.lit(True))
    )
    spread = members.join(blocked, F.col("component") == F.col("c"), "left").select(
        F.col("node").alias("n"), "component", "block"
    )
    ruled = match_rules(base, rules).withColumnRenamed("url", "u")
    verdict = F.coalesce("action", F.when(F.col("block"), F.lit("block")), F.lit("allow"))
    url = F.col("url")
    return (
        base.select("page_id", "url", node_of(url).alias("key"))
        .join(ruled, F.col("url") == F.col("u"), "left")
        .join(spread, F.col("key") == F.col("n"), "left")
        .select(
            "page_id",
            host_of(url).alias("host"),
            path_of(url).alias("path"),
            "rule",
            verdict.alias("verdict"),
            F.coalesce("component", "key").alias("component"),
        )
    )
