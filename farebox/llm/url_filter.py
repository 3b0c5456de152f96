"""URL filter: host and path rules, with decisions carried over redirect and canonical links.

A rule names a host and the start of a path. It fits the host, all its subdomains and every path with
that start; of the rules that fit, the longest wins. URLs without a rule take the decision of their
aliases: the URLs joined to them by redirects or canonical links, over any number of steps. One
explicitly allowed alias allows them all, otherwise one blocked alias blocks them.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from farebox.llm.components import components
from farebox.llm.tables import stage


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Host, then path, of the first "://".
_PARTS = r"://([^/?#]*)([^?#]*)"
_TAGS = r"(?is)(<(?:link|meta)\b[^>]*>)"
_CANONICAL = r"(?is)^<link\b[^>]*\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"
_HREF = r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"
_REFRESH = r"(?is)^<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?\s*refresh\b"
_CONTENT = r"(?is)\bcontent\s*=\s*(?:\"[^\">]*?|'[^'>]*?|[^\s>]*?)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)"
# Scheme and host, then path, of an absolute address.
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
_DIRECTORY = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/(?:[^?#]*/)?)"


def host_of(url: str) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def rule_index(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Position of the longest rule that fits, or null. Of equally long ones the first listed wins."""
    order = sorted(range(len(rules)), key=lambda i: -len(rules[i].text))
    return F.coalesce(*[F.when(_fits(rules[i], host, path), i) for i in order], F.lit(None).cast("int"))


def url_key(host: Column, path: Column, url: Column) -> Column:
    """One name for the spellings of an address: without scheme, fragment and tracking parameters."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    kept = F.regexp_replace(query, r"(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*", "")
    kept = F.regexp_replace(kept, r"^&+", "")
    return F.concat(host, F.when(path == "", "/").otherwise(path), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def _without_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` steps."""
    steps = F.split(path, "/")
    last = F.element_at(steps, -1)
    kept = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda done, step: F.when(step == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .when(step == ".", done)
        .otherwise(F.concat(done, F.array(step))),
    )
    return F.concat(F.array_join(kept, "/"), F.when(last.isin(".", ".."), "/").otherwise(""))


def resolved(target: Column, base: Column) -> Column:
    """The address that ``target`` means on the page ``base``: absolute, or relative to its scheme, host or folder.

    Null for other schemes, for a place in the same page, and without an absolute base where one is needed.
    """
    origin = F.regexp_extract(base, _ORIGIN, 1)
    folder = F.regexp_extract(base, _DIRECTORY, 1)
    here = F.concat(origin, F.when(folder == "", "/").otherwise(folder))
    plain = F.regexp_extract(target, r"^([^?#]*)", 1)
    more = F.regexp_extract(target, r"^[^?#]*(.*)$", 1)

    def joined(start: Column, path: Column) -> Column:
        whole = F.concat(start, path)
        return F.concat(F.regexp_extract(whole, _ORIGIN, 1), _without_dots(F.regexp_replace(whole, _ORIGIN, "")), more)

    return (
        F.when(target.rlike(r"(?i)^https?://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | target.startswith("#") | (target == "") | (origin == ""), None)
        .when(target.startswith("//"), F.concat(F.regexp_extract(base, r"^([^:]*:)", 1), target))
        .when(target.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), target))
        .when(target.startswith("/"), joined(origin, plain))
        .otherwise(joined(here, plain))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target) URLs of all canonical links and refresh redirects in the pages.

    Attributes may come in any order. Relative targets are resolved against the URL of the page, whatever
    ``base`` tag it has. A page without links, without an absolute URL or with a null text gives no row.
    """
    tags = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(_TAGS), 1)
    tagged = pages.where(F.col(url).rlike(_ORIGIN)).select(F.col(url).alias("source"), F.explode(tags).alias("tag"))
    target = F.when(F.col("tag").rlike(_CANONICAL), F.regexp_extract("tag", _HREF, 1)).when(
        F.col("tag").rlike(_REFRESH), F.regexp_extract("tag", _CONTENT, 1)
    )
    named = tagged.select("source", F.regexp_replace(target, "(?i)&amp;", "&").alias("target"))
    found = named.select("source", resolved(F.col("target"), F.col("source")).alias("target"))
    return found.where("target IS NOT NULL")


def judge_urls(
    pages: DataFrame, links: DataFrame, rules: Sequence[Rule], page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict and ``via``: rule, alias or default.

    ``links`` has ``source`` and ``target`` URLs; an end may be an address no page has. A null URL and
    one without ``://`` has an empty host and path, fits no rule and is allowed. Repeated rows are
    judged alike and all returned. An empty table gives an empty result.
    """
    for rule in rules:
        if rule.verdict not in ("allow", "block") or not rule.host:
            raise ValueError(f"no rule: {rule}")
    judged = _with_parts(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")), rules)
    ends = links.select(F.explode(F.array("source", "target")).alias("url")).distinct()
    keyed = _with_parts(ends, rules)
    ids = keyed.select("url", "key", F.xxhash64("key").alias("id"), "index")
    pairs = (
        links.select("source", "target")
        .join(ids.select(F.col("url").alias("source"), F.col("key").alias("a")), "source")
        .join(ids.select(F.col("url").alias("target"), F.col("key").alias("b")), "target")
    )
    alias = stage(components(pairs, "a", "b"), "aliases")
    verdict_of = _lookup(rules, "verdict")
    # Decisions of the members: those of the link ends and those of the pages with the same key.
    decided = keyed.select("key", "index").union(judged.select("key", "index")).where("index IS NOT NULL").distinct()
    found = (
        alias.join(decided, F.col("node") == F.col("key"))
        .groupBy("component")
        .agg(F.max(verdict_of == "allow").alias("allowed"))
    )
    inherited = alias.join(found, "component").select(F.col("node").alias("key"), "allowed")
    out = judged.join(inherited, "key", "left")
    own = F.col("index").isNotNull()
    return out.select(
        "page_id",
        "host",
        "path",
        _lookup(rules, "text").alias("rule"),
        F.when(own, verdict_of).when(~F.col("allowed"), "block").otherwise("allow").alias("verdict"),
        F.when(own, "rule").when(F.col("allowed").isNotNull(), "alias").otherwise("default").alias("via"),
    )


def _lookup(rules: Sequence[Rule], field: str) -> Column:
    out = F.lit(None).cast("string")
    for i, rule in enumerate(rules):
        out = F.when(F.col("index") == i, getattr(rule, field)).otherwise(out)
    return out


def _with_parts(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    parts = urls.withColumns({"host": host_of("url"), "path": path_of("url")})
    host, path = F.col("host"), F.col("path")
    return parts.withColumns({"index": rule_index(rules, host, path), "key": url_key(host, path, F.col("url"))})
