"""URL filters with redirect equivalence.

Rules judge hosts and path prefixes. URLs that are one address in other words (scheme, case of
the host, ``www.`` and ``m.``, fragment, tracking parameters, closing slash) share a canonical
form; redirects and canonical links join forms. A block found anywhere in a connected component
holds for all its aliases that no rule judges; an explicit allow keeps its own URL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from standings.llm.common import Stage, whole
from standings.llm.components import connected_components

TRACKING = r"(?:utm_[a-z]+|ref|gclid|fbclid)"
CANONICAL = [
    r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)""",
    r"""(?is)<link\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)["']?[^>]*\brel\s*=\s*["']?canonical\b""",
]
REFRESH = [
    r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*\burl\s*=\s*["']?([^"'\s>]+)""",
    r"""(?is)<meta\b[^>]*\burl\s*=\s*["']?([^"'\s>]+)[^>]*\bhttp-equiv\s*=\s*["']?refresh\b""",
]
AMPERSAND = r"(?i)&(?:amp|#0*38|#x0*26);"


@dataclass(frozen=True)
class UrlRule:
    """``rule`` is ``host/path``; it fits the host and its subdomains, and paths that start so."""

    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty where there is none or the url is null."""
    url = whole(url)
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def canonical_form(url: Column) -> Column:
    """One text for all ways to write an address; null where there is no ``://``."""
    rest = F.regexp_replace(after_scheme(url), r"(?s)#.*$", "")
    host = F.regexp_replace(host_of(url), r"^(?:www|m)\.|:(?:80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(rest, r"(?s)\?(.*)$", 1)
    asked = F.array_sort(
        F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(f"^{TRACKING}(?:=|$)"))
    )
    tail = F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(asked, "&"))).otherwise("")
    return F.when(F.instr(whole(url), "://") > 0, F.concat(host, path, tail))


def linked_urls(html: Column, url: Column) -> Column:
    """All addresses that a page names as canonical ones or sends its readers to; empty where none."""
    html, none = whole(html), F.expr("cast(array() as array<string>)")

    def all_of(needed: Column, pattern: str) -> Column:
        return F.when(needed, F.regexp_extract_all(html, F.lit(pattern), F.lit(1))).otherwise(none)

    rel, equiv = html.ilike("%canonical%"), html.ilike("%http-equiv%")
    found = F.concat(*[all_of(rel, p) for p in CANONICAL], *[all_of(equiv, p) for p in REFRESH])
    root = F.concat(F.regexp_extract(whole(url), r"(?s)^.*?://", 0), host_of(url))
    scheme = F.regexp_extract(whole(url), r"(?s)^.*?:", 0)
    folder = F.concat(root, F.regexp_extract(path_of(url), "^(?:.*/)?", 0))

    def absolute(target: Column) -> Column:
        return (
            F.when(F.instr(target, "://") > 0, target)
            .when(target.startswith("//"), F.concat(scheme, target))
            .when(target.startswith("/"), F.concat(root, target))
            .otherwise(F.concat(folder, target))
        )

    plain = F.transform(found, lambda x: F.regexp_replace(x, AMPERSAND, "&"))
    return F.array_distinct(F.transform(plain, absolute))


def fitting_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), null if none does; ties go to allow."""
    ordered = sorted(rules, key=lambda r: (-len(r.rule), r.verdict))
    out = None
    for r in ordered:
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def judge_urls(
    pages: DataFrame, rules: Sequence[UrlRule], redirects: DataFrame | None = None, stage: Stage | None = None
) -> DataFrame:
    """Every row of ``pages`` (url, html) as page_id, host, path, rule, verdict and alias_of.

    ``redirects`` (source, target) are urls, beside all those that the pages themselves name. The
    verdict is that of the longest fitting rule; else ``block`` if a url of the same component, a
    page's or one that is only linked to, is blocked by a rule, else ``allow``. Null urls and urls without ``://`` have empty host and path, no
    component, and are allowed. Repeated rows are judged alike. ``alias_of`` is the smallest
    canonical form of the component.
    """
    stage = stage or Stage(pages.sparkSession)
    url, host, path = F.col("url").cast("string"), F.col("host"), F.col("path")
    judged = stage.keep(
        pages.select("page_id", url.alias("url"), linked_urls(F.col("html"), url).alias("targets"))
        .withColumn("host", host_of(F.col("url")))
        .withColumn("path", path_of(F.col("url")))
        .withColumn("fit", fitting_rule(host, path, rules))
        .withColumn("form", canonical_form(F.col("url"))),
        "judged",
    )
    links = judged.select(F.col("url").alias("source"), F.explode("targets").alias("target")).where("target is not null")
    if redirects is not None:
        links = links.unionByName(redirects.select("source", "target"))
    links = stage.keep(links, "links")
    edges = links.select(canonical_form(F.col("source")).alias("a"), canonical_form(F.col("target")).alias("b"))
    components = connected_components(edges, stage)
    rooted = judged.join(components, F.col("form") == F.col("node"), "left").withColumn(
        "alias_of", F.coalesce("root", "form")
    )
    # Addresses that pages and redirects name are judged too, whether or not they are pages.
    named = links.select(F.explode(F.array("source", "target")).alias("url")).where("url is not null")
    named = named.withColumn("fit", fitting_rule(host_of(F.col("url")), path_of(F.col("url")), rules))
    named = named.where("fit.verdict = 'block'").select(canonical_form(F.col("url")).alias("form")).distinct()
    blocked = (
        rooted.where("fit.verdict = 'block' and alias_of is not null")
        .select(F.col("alias_of").alias("blocked"))
        .unionByName(named.join(components, F.col("form") == F.col("node")).select(F.col("root").alias("blocked")))
        .distinct()
    )
    open_ = rooted.join(blocked, F.col("alias_of") == F.col("blocked"), "left")
    return open_.select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.when(F.col("blocked").isNotNull(), "block"), F.lit("allow")).alias("verdict"),
        "alias_of",
    )
