"""URL filtering with redirect equivalence.

1. Host and path of every URL are matched with allow and block rules: a rule fits its host
   and all subdomains where the path starts with the rule's path; the longest rule wins.
2. A URL's node is its host, path and query: the scheme and the fragment do not count, and
   an empty path is ``/``. Only what a page or a redirect states makes an
   edge: canonical links, meta refreshes and, where given, observed redirects. Spellings
   that look alike (``www.``, tracking parameters, ``.html``) are no aliases by themselves.
3. Connected components of the edges, found by star contraction, spread decisions: a URL
   without a rule is blocked when its component holds a blocked URL and no explicitly allowed
   one. A URL's own rule always stands, so an explicit allow is never overruled.

DataFrame functions only; page bodies are read for their link tags and never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annofold.llm._shared import durable
from annofold.llm.components import components

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Link tags and their attributes.
# A start of a tag is given up at the next ``<`` outside quotes, a name at its first sign only is
# tried: so a page of any length and form is read in time proportional to its length.
LINK_TAG = r"""(?i)<(?:link|meta)\b(?:(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>|[^<>]*+>)"""
ATTRIBUTE = r"""(?<![^\s"'<>/=])[^\s"'<>/=]++\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""
REFRESH_URL = r"""(?i)\burl\s*=\s*["']?\s*([^"'>\s]+)"""
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
#: Character references that an attribute's value may hold, in the order of decoding.
REFERENCES = (("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&#38;", "&"), ("&#x26;", "&"), ("&amp;", "&"))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    rest = _rest(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _CAPITALS, _CAPITALS.lower()), path


def node_of(url: Column) -> Column:
    """The node of a URL: host, path (``/`` where empty) and query."""
    host, path = host_and_path(url)
    query = F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"\?[^#]*", 0)
    return F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), query)


def _attribute(tag: Column, name: str) -> Column:
    """Value of a tag's first attribute ``name``, quoted or not; null without one."""
    pairs = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0))
    named = F.get(F.filter(pairs, lambda p: F.lower(F.regexp_extract(p, r"^[^\s=]+", 0)) == name), 0)
    value = F.trim(F.regexp_extract(named, r"""(?s)=\s*["']?(.*?)["']?$""", 1))
    for reference, character in REFERENCES:
        value = F.replace(value, F.lit(reference), F.lit(character))
    return value


def link_targets(html: Column) -> Column:
    """Targets of all canonical links and meta refreshes of a page, as written."""
    tags = F.filter(F.regexp_extract_all(html, F.lit(LINK_TAG), F.lit(0)), lambda t: t.rlike("(?i)canonical|refresh"))

    def target(tag: Column) -> Column:
        is_link = F.lower(F.substring(tag, 2, 4)) == "link"
        canonical = F.array_contains(F.split(F.lower(_attribute(tag, "rel")), r"\s+"), "canonical")
        refresh = F.lower(_attribute(tag, "http-equiv")) == "refresh"
        return F.when(is_link & canonical, _attribute(tag, "href")).when(
            ~is_link & refresh, F.regexp_extract(_attribute(tag, "content"), REFRESH_URL, 1)
        )

    return F.filter(F.transform(tags, target), lambda t: t.isNotNull() & (t != ""))


def resolved(target: Column, url: Column) -> Column:
    """``target`` as a whole URL, seen from the page ``url``; null where it leads to no other page."""
    scheme = F.regexp_extract(url, SCHEME, 0)
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    _, path = host_and_path(url)
    own = F.regexp_extract(target, r"^[^?#]*", 0)
    tail = F.substring(target, F.length(own) + 1, F.length(target))
    full = F.when(own.startswith("/"), own).otherwise(F.concat(F.lit("/"), F.regexp_extract(path, r"^/?(.*/)?", 1), own))
    steps = F.aggregate(
        F.split(full, "/"),
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == ".", done)
        .when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(s))),
    )
    at_host = F.concat(scheme, F.lit("//"), host)
    return (
        F.when(target.rlike(SCHEME), F.when(F.locate("://", target) > 0, target))
        .when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("#"), None)
        .when(target.startswith("?"), F.concat(at_host, path, target))
        .otherwise(F.concat(at_host, F.array_join(steps, "/"), tail))
    )


def _with_rule(urls: DataFrame, rules: DataFrame, sizes: Sequence[int], keys: Sequence[str]) -> DataFrame:
    """``urls`` (keys, host, path) with the longest fitting rule and its verdict, or nulls.

    ``sizes``: numbers of labels that hosts of rules have; only such ends of a host are tried.
    """
    labels = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1
    ends = F.array_compact(F.array(*(F.when(labels >= n, F.substring_index("host", ".", -n)) for n in sizes)))
    tried = urls.withColumn("r_host", F.explode_outer(ends))
    fits = tried.join(rules, "r_host", "left").withColumn(
        "fit", F.when(F.col("path").startswith(F.col("r_path")), F.struct(F.length("r_rule").alias("size"), "r_rule", "r_verdict"))
    )
    return fits.groupBy(*keys, "host", "path").agg(F.max("fit").alias("fit")).select(
        *keys, "host", "path", F.col("fit.r_rule").alias("rule"), F.col("fit.r_verdict").alias("own")
    )


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], redirects: DataFrame | None = None
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages`` (page_id, url, html).

    ``rules``: (``host/path``, ``allow`` or ``block``). ``redirects`` (from_url, to_url) adds
    edges. Without a rule and without a decision in its component a URL is allowed. Null urls
    and urls without ``://`` have an empty host and path, no rule and no aliases; a null html
    has no links. Every canonical link and meta refresh counts, with any order and quoting of
    attributes and the character references of ``REFERENCES`` (a tag ends at a ``<`` outside
    quotes), and relative targets are resolved against the page's url (a base tag is not read). Equal rows are judged alike; an empty table gives none. Columns beside
    page_id, url and html are not read.
    """
    spark = pages.sparkSession
    listed = spark.createDataFrame(
        [(r[: r.index("/")], r[r.index("/") :], r, v) for r, v in rules],
        "r_host string, r_path string, r_rule string, r_verdict string",
    )
    sizes = sorted({r[: r.index("/")].count(".") + 1 for r, _ in rules}) or [1]
    html = F.col("html").cast("string")
    chosen = durable(
        pages.select(
            F.col("page_id").alias("page_id"),
            F.col("url").cast("string").alias("url"),
            link_targets(html).alias("targets"),
        )
    )
    urls = chosen.select("url").distinct()
    host, path = host_and_path(F.col("url"))
    links = chosen.select("url", F.explode("targets").alias("target")).filter(F.locate("://", "url") > 0)
    targets = links.select("url", resolved(F.col("target"), F.col("url")).alias("target"))
    if redirects is not None:
        targets = targets.union(redirects.select(F.col("from_url").cast("string"), F.col("to_url").cast("string")))
    targets = targets.filter(F.locate("://", "url") > 0).filter(F.locate("://", "target") > 0)
    known = urls.union(targets.select("url")).union(targets.select("target")).distinct()
    judged = durable(
        _with_rule(known.select("url", host.alias("host"), path.alias("path")), listed, sizes, ["url"]).withColumn(
            "node", F.when(F.col("host") != "", node_of(F.col("url")))
        )
    )
    edges = targets.select(node_of(F.col("url")).alias("u"), node_of(F.col("target")).alias("v"))
    near = components(edges)
    placed = judged.join(near.withColumnRenamed("node", "near_node"), F.col("node") == F.col("near_node"), "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    decided = (
        placed.filter("component IS NOT NULL AND own IS NOT NULL")
        .groupBy("component")
        .agg(F.min("own").alias("spread"))  # allow sorts before block: an explicit allow wins
    )
    verdicts = placed.join(decided, "component", "left").select(
        F.col("url").alias("known_url"), "host", "path", "rule", F.coalesce("own", "spread", F.lit("allow")).alias("verdict")
    )
    return chosen.join(verdicts, F.col("url").eqNullSafe(F.col("known_url"))).select("page_id", "host", "path", "rule", "verdict")
