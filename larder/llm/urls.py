"""Block and allow rules on page addresses, carried over redirects and canonical links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.graph import components
from larder.llm.shared import Stored

#: (verdict, host, path): the host and its subdomains, paths that start with the path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A canonical link and a refresh, whatever the order of their attributes.
_CANONICAL = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*?\burl\s*=\s*[\"']?([^\"'\s>]+)"
_BASE = r"(?is)<base\b[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #, A-Z in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or #."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule_of(rules) -> tuple[Column, Column]:
    """The text and verdict of the longest rule that fits ``host`` and ``path``."""
    text = verdict = F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        text = F.when(fits, F.lit(host + path)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def node_of(url: Column) -> Column:
    """One name for an address: scheme and host in lower case, without the fragment."""
    parts = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(F.translate(parts, _UPPER, _LOWER), rest))


def _without_dots(path: Column) -> Column:
    """``path``, which starts with /, after its steps . and .. are taken."""
    steps = F.aggregate(
        F.split(F.substr(path, F.lit(2), F.length(path)), "/", -1),
        F.array().cast("array<string>"),
        lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(x == ".", done)
        .otherwise(F.concat(done, F.array(x))),
    )
    ends = F.when(path.rlike(r"/\.\.?$") & (F.size(steps) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(steps, "/"), ends)


def _target(url: Column, href: Column) -> Column:
    """``href`` as an address of its own, taken from the page at ``url``; null if it is empty or
    of a scheme without hosts."""
    scheme, site = F.regexp_extract(url, r"(?s)^(.*?:)//", 1), F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    path, page = path_of(url), F.regexp_extract(url, r"(?s)^(.*?://[^?#]*)", 1)
    folder = F.concat(F.regexp_extract(path, r"(?s)^(.*)/", 1), F.lit("/"))
    own, rest = F.regexp_extract(href, r"(?s)^([^?#]*)", 1), F.regexp_extract(href, r"(?s)^[^?#]*(.*)$", 1)
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*([^#]*)", 1)
    return (
        F.when(F.length(href) == 0, F.lit(None))
        .when(href.rlike(r"^[^/?#]*://"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(site, _without_dots(own), rest))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(page, query, href))
        .when(~href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(site, _without_dots(F.concat(folder, own)), rest))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between a page and all addresses it redirects to or calls canonical."""
    every = F.concat(*(F.regexp_extract_all("html", F.lit(p), F.lit(1)) for p in (_CANONICAL, _REFRESH)))
    linking = pages.where(F.lower("html").rlike(r"canonical|refresh")).select(
        "url", F.regexp_extract("html", _BASE, 1).alias("base"), F.explode(F.array_distinct(every)).alias("href")
    )
    based = linking.select("url", "href", F.coalesce(_target(F.col("url"), F.col("base")), "url").alias("base"))
    return based.select(
        node_of(F.col("url")).alias("a"), node_of(_target(F.col("base"), F.col("href"))).alias("b")
    ).where("a is not null and b is not null")


def url_verdicts(
    pages: DataFrame, rules=RULES, redirects: DataFrame | None = None, default: str = "allow"
) -> DataFrame:
    """Every row of ``pages`` (``page_id``, ``url``, ``html``) with its rule and verdict.

    A page with a rule has that rule's verdict. One without takes the decision of its aliases,
    the addresses connected to it by canonical links, refreshes and the rows of ``redirects``
    (``from_url``, ``to_url``): allow if a rule allows any of them, else block if a rule blocks
    any, else ``default``. Addresses count as aliases whether or not they are pages. Rows with
    the same address get the same verdict and stay; a null url, or one without ://, has no host,
    path, rule or alias. All links of a page count; relative ones are taken from its folder or from
    the address its base names. Tables without rows give none.
    """
    spark = pages.sparkSession
    stored = Stored(spark, "urls")
    pages = pages.select("page_id", "url", "html")
    edges = alias_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("from_url")).alias("a"), node_of(F.col("to_url")).alias("b")))
    rule, verdict = _rule_of(rules)
    parts = stored.write(components(edges, stored))
    ruled = parts.withColumns({"host": host_of(F.col("id")), "path": path_of(F.col("id"))}).withColumn("own", verdict)
    # Stored, so that the join below is one that can split a component with very many addresses.
    decided = stored.write(
        ruled.where("own is not null")
        .groupBy("component")
        .agg(F.min("own").alias("shared"))  # allow comes before block
    )
    passed_on = ruled.where("own is null").join(decided, "component").select(F.col("id").alias("node"), "shared")
    judged = (
        pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "node": node_of(F.col("url"))})
        .drop("html", "url")
        .withColumns({"rule": rule, "own": verdict})
    )
    return judged.join(passed_on, "node", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("own", "shared", F.lit(default)).alias("verdict")
    )
