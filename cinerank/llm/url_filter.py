"""URL filtering with redirect equivalence.

Rules decide by host and path. A URL without a rule shares the fate of its aliases: addresses linked by redirects or
canonical links, in any direction and over any number of steps, are one group, found as connected components. If a rule
blocks any member of the group, members without a rule are blocked too, unless a rule also allows a member explicitly: an
explicit allow goes before an inherited block. A member's own rule always holds.

URLs that differ only in their fragment or the case of scheme and host are one node. On demand those that differ in scheme,
trailing slashes or tracking parameters are too; such URLs may well have other content, so nothing is inherited over them unasked.
Links come from ``<link rel=canonical>`` and ``<meta http-equiv=refresh>`` of a page, and from a table of redirects.
All canonical links and refreshes of a page count, their targets with character references resolved. Both ends of a link count
with their own rules even where no page has their URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cinerank.llm.components import connected_components
from cinerank.session import stored

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
_TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=.*)?$"
_CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_ABSOLUTE = r"(?i)^[a-z][a-z0-9+.-]*://"
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
_REFERENCE = rf"(?s)^&(#0*[0-9]{{1,7}}|#[xX]0*[0-9a-fA-F]{{1,6}}|{'|'.join(_NAMED)});"


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct ``(verdict, rule)`` of the longest rule that fits, or null. ``rules`` is a short list, part of the plan."""
    fits = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        here = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))
        fits = F.when(here, found) if fits is None else fits.when(here, found)
    return fits


def address(url: Column, alike: bool = False) -> Column:
    """The node of a URL: scheme, host, path and query, or with ``alike`` host, path without trailing slashes and the query
    without tracking parameters; null without a host."""
    query = F.regexp_extract(url, _PARTS, 3)
    if not alike:
        scheme = F.translate(F.regexp_extract(url, r"(?s)^(.*?)://", 1), _UPPER, _LOWER)
        # an empty path is the root, as far as servers can tell
        named = F.when(path(url) == "", "/").otherwise(path(url))
        return F.when(host(url) != "", F.concat(scheme, F.lit("://"), host(url), named, query))
    kept = F.filter(F.split(F.substr(query, F.lit(2)), "&"), lambda x: (x != "") & ~x.rlike(_TRACKING))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host(url) != "", F.concat(host(url), F.regexp_replace(path(url), "/+$", ""), query))


def unescaped(value: Column) -> Column:
    """An attribute's value with numeric and the five XML character references resolved, each once."""
    def piece(x: Column) -> Column:
        name = F.regexp_extract(x, _REFERENCE, 1)
        code = (F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10))
                .when(name.startswith("#"), F.substr(name, F.lit(2))).cast("long"))
        fits = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.when(fits, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        for word, meant in _NAMED.items():
            char = F.when(name == word, F.lit(meant)).otherwise(char)
        return F.when(char.isNotNull(), F.concat(char, F.regexp_replace(x, _REFERENCE, ""))).otherwise(x)

    return F.when(value.contains("&"), F.array_join(F.transform(F.split(value, "(?=&)"), piece), "")).otherwise(value)


def _resolved(base: Column, target: Column) -> Column:
    """``target`` as an absolute URL, seen from the page ``base``."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), host(base))
    return (F.when(target == "", F.lit(None)).when(target.rlike(_ABSOLUTE), target)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(site, target))
            .otherwise(F.concat(site, F.coalesce(F.nullif(F.regexp_extract(path(base), r"(?s)^(.*/)", 1), F.lit("")), F.lit("/")), target)))


def page_links(url: Column, html: Column) -> Column:
    """Targets of a page's canonical links and refresh redirects."""
    html = F.coalesce(html, F.lit(""))

    def targets(tag: str, value: str) -> Column:
        return F.transform(F.regexp_extract_all(html, F.lit(tag), F.lit(0)),
                           lambda x: _resolved(url, unescaped(F.regexp_extract(x, value, 1))))

    return F.array_compact(F.concat(targets(_CANONICAL, r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""),
                                    targets(_REFRESH, r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)""")))


def judge(pages: DataFrame, redirects: DataFrame | None = None, rules=RULES, id_col: str = "page_id",
          url_col: str = "url", html_col: str = "html", alike: bool = False) -> DataFrame:
    """One row per row of ``pages``: the id, ``host``, ``path``, ``rule`` (or null) and ``verdict``.

    ``redirects(url, target)`` adds links; ``alike`` takes more URLs as one (see ``address``). A null URL or one without ``://``
    has an empty host and path, no rule and no aliases, and is allowed; null html has no links. Ids may be null or repeat, as
    they are only carried. Repeated rows keep their rows; other columns are not read; an empty table gives no rows.
    """
    url = F.col("url")
    seen = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows = stored(seen.select("id", "url", host(url).alias("host"), path(url).alias("path"), address(url, alike).alias("node"),
                              page_links(url, F.col("html")).alias("targets"))
                  .withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules)), "urls")
    links = rows.where("node is not null").select("node", F.explode("targets").alias("target"), F.lit(None).cast("string").alias("verdict"))
    if redirects is not None:  # their sources need not be pages
        rule = fitting_rule(host(url), path(url), rules)["verdict"]
        links = links.union(redirects.select(address(url, alike).alias("node"), "target", rule.alias("verdict")))
    links = stored(links, "links")
    there = F.col("target")
    targets = links.select(address(there, alike).alias("node"), fitting_rule(host(there), path(there), rules)["verdict"].alias("verdict"))
    groups = connected_components(links.select(F.col("node").alias("u"), address(there, alike).alias("v")))

    decided = (rows.select("node", F.col("fit")["verdict"].alias("verdict")).union(targets).union(links.select("node", "verdict"))
               .where("node is not null and verdict is not null").distinct())
    named = groups.select("node", F.col("component").alias("group"))
    fate = (decided.join(named, "node", "left").groupBy(F.coalesce("group", "node").alias("group"))
            .agg(F.when(F.max(F.col("verdict") == "allow"), "allow").otherwise("block").alias("inherited")))
    out = (rows.select("id", "host", "path", "node", "fit").join(named, "node", "left")
           .withColumn("group", F.coalesce("group", "node")).join(fate, "group", "left"))
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("fit")["rule"].alias("rule"),
                      F.coalesce(F.col("fit")["verdict"], "inherited", F.lit("allow")).alias("verdict"))
