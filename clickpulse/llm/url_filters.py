"""URL filters with built-in functions only: host and path rules, and redirect equivalence.

Pages that a rule fits take its verdict. A page without a rule takes the verdict of its aliases:
the connected component of its address over redirects and canonical links. One alias that a rule
allows is enough to allow all of them; else one that a rule blocks blocks them; else the default holds.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.shared import connected_components, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class UrlRule(NamedTuple):
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """Struct (verdict, name) of the longest fitting rule, allow before block among equals; else null.

    ``rules`` is a list in the code, of at most some hundred entries: it becomes one expression.
    """
    def fits(rule: UrlRule) -> Column:
        at = (host == rule.host) | host.endswith("." + rule.host)
        return at & path.startswith(rule.path) if rule.path else at

    order = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "allow", r.name))
    found = [
        F.when(fits(r), F.struct(F.lit(r.verdict).alias("verdict"), F.lit(r.name).alias("name"))) for r in order
    ]
    return F.coalesce(*found) if found else F.lit(None).cast("struct<verdict:string,name:string>")


def _without_dots(path: Column) -> Column:
    """``path``, empty or from its ``/``, with ``.`` and ``..`` segments resolved; a last one leaves its ``/``."""
    segments = F.slice(F.split(path, "/"), 2, F.length(path) + 1)
    none = F.array().cast("array<string>")

    def step(done: Column, segment: Column) -> Column:
        above = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(segment == ".", done).when(segment == "..", above).otherwise(F.array_append(done, segment))

    end = F.when(path.rlike(r"/\.\.?\z"), F.array(F.lit(""))).otherwise(none)
    whole = F.concat(F.lit("/"), F.array_join(F.concat(F.reduce(segments, none, step), end), "/"))
    return F.when(path.rlike(r"/\.\.?(/|\z)"), whole).otherwise(path)


def address(url: Column) -> Column:
    """What names a page: lower-case scheme and host, the path without dot segments, the query, no fragment.

    An empty path is ``/``. Null without ``://``.
    """
    scheme = F.translate(F.regexp_extract(url, r"^((?s:.*?))://", 1), UPPER, LOWER)
    query = F.regexp_extract(url, r"^(?s:.*?)://[^?#]*(\?[^#]*)", 1)
    path = path_of(url)
    whole = F.concat(
        scheme, F.lit("://"), host_of(url), F.when(path == "", F.lit("/")).otherwise(_without_dots(path)), query
    )
    return F.when(url.contains("://"), whole)


def _attribute(tag: Column, name: str) -> Column:
    value = F.regexp_extract(tag, rf"""(?i)[\s"']{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", 1)
    return F.trim(F.regexp_replace(value, r"""^["']|["']$""", ""))


def _resolved(target: Column, url: Column) -> Column:
    """``target`` as seen from ``url``, dot segments left in. Null for a fragment only, or another kind of scheme."""
    scheme, host = F.regexp_extract(url, r"^((?s:.*?))://", 1), host_of(url)
    root = F.concat(scheme, F.lit("://"), host)
    folder = F.concat(root, F.coalesce(F.nullif(F.regexp_extract(path_of(url), r"^(.*/)", 1), F.lit("")), F.lit("/")))
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    return (
        F.when(target == "", F.lit(None))
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(root, target))
        .when(target.startswith("?"), F.concat(root, path_of(url), target))
        .when(target.startswith("#") | target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.concat(folder, target))
    )


def alias_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``source, target`` addresses of canonical links and refresh redirects in the pages' heads.

    Only tags are read; null html has none, and targets that are no address are left out.
    """
    def tags(pattern: str) -> Column:
        return F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(0))

    links = F.when(
        F.col(html).rlike("(?i)canonical"),
        F.filter(
            tags(r"(?i)<link\s[^>]*>"),
            lambda t: _attribute(t, "rel").rlike(r"(?i)(^|\s)canonical(\s|$)"),
        ),
    )
    moves = F.when(
        F.col(html).rlike("(?i)http-equiv"),
        F.filter(tags(r"(?i)<meta\s[^>]*>"), lambda t: _attribute(t, "http-equiv").rlike("(?i)^refresh$")),
    )
    targets = F.concat(
        F.transform(F.coalesce(links, F.array().cast("array<string>")), lambda t: _attribute(t, "href")),
        F.transform(
            F.coalesce(moves, F.array().cast("array<string>")),
            lambda t: F.regexp_extract(_attribute(t, "content"), r"(?i)url\s*=\s*['\"]?([^'\"]*)", 1),
        ),
    )
    rows = pages.select(F.col(url).alias("__url"), F.explode(targets).alias("__target"))
    rows = rows.select(
        address(F.col("__url")).alias("source"),
        address(_resolved(F.trim("__target"), F.col("__url"))).alias("target"),
    )
    return rows.where("source IS NOT NULL AND target IS NOT NULL AND source <> target").distinct()


def judge(
    pages: DataFrame,
    rules: Sequence[UrlRule],
    redirects: DataFrame | None = None,
    url: str = "url",
    html: str | None = "html",
    default: str = "allow",
) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to each row of ``pages``.

    A page without a rule gets the verdict of its component: allow if a rule allows any of its addresses or
    pages, else block if one blocks. ``redirects`` may bring further ``source, target`` pairs, such as a crawler's. A null url, or one
    without ``://``, has no host, no rule and no alias, and gets the default. Repeated rows stay
    repeated; columns of ``pages`` that are called like an added one are replaced.
    """
    rows = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    rows = rows.withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("rule", F.col("__rule.name")).withColumn("__own", F.col("__rule.verdict")).drop("__rule")

    links = [alias_links(pages, url, html)] if html else []
    if redirects is not None:
        pairs = redirects.select(address(F.col("source")).alias("source"), address(F.col("target")).alias("target"))
        links.append(pairs.where("source IS NOT NULL AND target IS NOT NULL AND source <> target"))
    if not links:
        return rows.withColumn("verdict", F.coalesce("__own", F.lit(default))).drop("__own")
    edges = links[0] if len(links) == 1 else links[0].unionByName(links[1]).distinct()
    edges = written(edges, "aliases")
    judged = rows.where("__own IS NOT NULL").select(address(F.col(url)).alias("__alias"), "__own")
    ids = written(_verdicts(edges, rules, judged), "alias-verdicts")
    found = rows.withColumn("__address", F.when(F.col("__own").isNull(), address(F.col(url))))
    found = found.join(ids, found["__address"] == ids["__alias"], "left")
    verdict = F.coalesce("__own", "__shared", F.lit(default))
    return found.withColumn("verdict", verdict).drop("__own", "__address", "__alias", "__shared")


def _verdicts(edges: DataFrame, rules: Sequence[UrlRule], judged: DataFrame) -> DataFrame:
    """``__alias, __shared``: the verdict that each linked address gets from its component.

    The rules see the addresses of a component, and the paths of its pages as they are given: ``judged`` has
    the pages' own verdicts. Only those of linked addresses matter, one of each kind for an address.
    """
    names = connected_components(edges, "source", "target").withColumnRenamed("id", "__alias")
    own = rule_of(host_of(F.col("__alias")), path_of(F.col("__alias")), rules)["verdict"]
    by_address = names.select("component", own.alias("__own"))
    by_page = judged.join(names, "__alias").groupBy("__alias", "component", "__own").count().select("component", "__own")
    every = by_address.unionByName(by_page).where("__own IS NOT NULL")
    shared = every.groupBy("component").agg(F.min("__own").alias("__shared"))  # allow comes before block
    return names.join(shared, "component").select("__alias", "__shared")
