"""URL rules with redirect equivalence, in Column expressions and joins only.

A rule judges a host, its subdomains and a path prefix; the longest rule that fits wins.
Redirects and canonical links make pages aliases of each other: within a connected
component one blocked address blocks every alias that no rule judges.  An explicit allow
takes precedence: a page that an allow rule fits is never blocked by its aliases.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .storage import materialise

#: (host, path prefix, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DEFAULT = "allow"
_QUOTE = """["']"""
CANONICAL = rf"(?is)<link\b(?=[^>]*\brel\s*=\s*{_QUOTE}?canonical\b)[^>]*\bhref\s*=\s*{_QUOTE}?([^\s\"'>]+)"
REFRESH = rf"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*{_QUOTE}?refresh\b)[^>]*\bcontent\s*=\s*{_QUOTE}?[^\"'>]*?\burl\s*=\s*{_QUOTE}?([^\s\"'>]+)"
SCRIPT = rf"(?s)\blocation(?:\.href)?\s*(?:=|\.(?:replace|assign)\()\s*{_QUOTE}([^\"']+){_QUOTE}"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    """Host, A to Z in lower case; empty for a null url or one without ``://``."""
    found = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(found, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does."""
    out = None
    for name, prefix, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        value = F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def node(url: Column) -> Column:
    """An address as aliases share it: without fragment, its host in lower case."""

    def build(plain: Column) -> Column:
        at = F.instr(plain, "://") + 2
        lowered = _let(host(plain), lambda h: F.concat(F.substring(plain, F.lit(1), at), h, F.substring(plain, at + 1 + F.length(h), F.length(plain))))
        return F.when(at > 2, lowered).otherwise(plain)

    return _let(F.regexp_extract(url, "^[^#]*", 0), build)


def resolve(base: Column, target: Column) -> Column:
    """A link's target as an absolute address."""

    def build(b: Column) -> Column:
        folder = F.regexp_extract(b["path"], "(?s)^.*/", 0)
        site = F.concat(b["scheme"], F.lit("://"), b["host"])
        out = F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target).when(target.startswith("//"), F.concat(b["scheme"], F.lit(":"), target))
        out = out.when(target.startswith("/"), F.concat(site, target)).when(target.startswith("?"), F.concat(site, b["path"], target))
        return out.otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), target))

    return _let(F.struct(F.substring_index(base, "://", 1).alias("scheme"), host(base).alias("host"), path(base).alias("path")), build)


def links(pages: DataFrame) -> DataFrame:
    """(src, dst) of all redirects and canonical links found in ``pages`` (url, html)."""
    html, url = F.col("html"), F.col("url")

    none = F.array().cast("array<string>")

    def targets(pattern: str, hint: str) -> Column:
        return F.when(F.contains(F.lower(html), F.lit(hint)), F.regexp_extract_all(html, F.lit(pattern), F.lit(1))).otherwise(none)

    found = F.flatten(F.array(targets(CANONICAL, "canonical"), targets(REFRESH, "refresh"), targets(SCRIPT, "location")))
    named = pages.where("url is not null and html is not null").select("url", F.explode(found).alias("target")).where("target <> '' and not startswith(target, '#')")
    named = named.withColumn("target", F.regexp_replace("target", "&amp;", "&"))
    return named.select(node(url).alias("src"), node(resolve(url, F.col("target"))).alias("dst")).where("src <> dst").distinct()


def judge(pages: DataFrame, edges: DataFrame | None = None, rules: tuple = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url, html).

    ``edges`` (src, dst: addresses) may add redirects known from elsewhere.  Pages that
    neither a rule nor an alias judges are allowed.  Null and malformed urls have an empty
    host and path, fit no rule and have no aliases.  Pages of any length are searched whole
    for links; repeated rows, and pages of one address, are judged alike, each in its row;
    of rules of equal length the first counts.  Columns besides these are not read.
    """
    found = links(pages)
    if edges is not None:
        found = found.union(edges.select(node(F.col("src")), node(F.col("dst"))))
    alias = connected_components(found)
    own = F.col("own")
    blocked = alias.withColumn("own", rule(host(F.col("node")), path(F.col("node")), rules)).where("own.verdict = 'block'").select("component").distinct()
    bad = materialise(alias.join(materialise(blocked, "blocked"), "component", "left_semi").select(F.col("node").alias("address")).distinct(), "aliases")
    judged = pages.select("page_id", "url").withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    judged = judged.withColumns({"own": rule(F.col("host"), F.col("path"), rules), "address": node(F.col("url"))})
    marked = judged.join(bad.withColumn("alias_blocked", F.lit(True)), "address", "left")
    verdict = F.coalesce(own["verdict"], F.when(F.col("alias_blocked"), "block").otherwise(DEFAULT))
    return marked.select("page_id", "host", "path", own["rule"].alias("rule"), verdict.alias("verdict"))
