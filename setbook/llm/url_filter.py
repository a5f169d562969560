"""URL filter: block and allow rules, carried over redirects and canonical links.

A rule is (action, host, path).  It fits its host and all subdomains where
the url's path starts with the rule's; of the rules that fit, the longest
(host and path together; then the longer host; then allow) decides.

Aliases: a page's canonical links and meta refreshes say that two urls are
the same resource.  Distributed connected components over those edges give
classes of equivalent urls.  A url without a rule of its own is blocked
when its class holds a blocked url and no explicitly allowed one.

Everything is DataFrame functions; urls without an alias edge (nearly all)
never enter the component rounds.

Defined results: a null url or one without ``://`` has empty host and path,
no rule and is allowed; null html has no edges; repeated rows each get a
row; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .components import components

Rule = tuple[str, str, str]

# fixed values: the rules of the registered query (action, host, path)
RULES: tuple[Rule, ...] = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# tags and their attributes; a tag ends at the first ``>``
_LINK_TAG, _META_TAG = r"(?is)<link\b[^>]*+", r"(?is)<meta\b[^>]*+"
_ATTRIBUTE = r"(?is)[\s\"'/]%s\s*+=\s*+(?:\"([^\"]*+)|'([^']*+)|([^\s\"'>]++))"
_REFRESH_URL = r"(?is)[\s;,\"']url\s*+=\s*+[\"']?\s*+([^\"'\s>]++)"
_AMPERSAND = r"(?i)&amp;|&#0*+38;|&#x0*+26;"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)"
# for ORACLE only: a tag's attribute value, quoted or bare, as SQL engines without look-around can read it too
_CANONICAL = (r"(?is)<link[^>]*rel=[\"']?canonical[\"']?[^>]*href=[\"']?([^\"'\s>]+)",
              r"(?is)<link[^>]*href=[\"']?([^\"'\s>]+)[\"']?[^>]*rel=[\"']?canonical")
_REFRESH = r"(?is)<meta[^>]*http-equiv=[\"']?refresh[\"']?[^>]*url=[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def without_dots(path: Column) -> Column:
    """``path`` with its segments ``.`` and ``..`` resolved."""
    parts = F.split(path, "/")
    up = lambda acc: F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, x: F.when(x == ".", acc).when(
        x == "..", up(acc)).otherwise(F.concat(acc, F.array(x))))
    last = F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.array_join(kept, "/"), last)).otherwise(path)


def node_of(url: Column) -> Column:
    """The url without scheme, fragment and dot segments: what an alias edge connects; null without ``://``."""
    key = F.concat(host_of(url), without_dots(path_of(url)), F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 3))
    return F.when(F.coalesce(url, F.lit("")).contains("://"), key)


def absolute(link: Column, base: Column) -> Column:
    """``link`` resolved against the page's url; dot segments are left to ``node_of``."""
    scheme = F.substring_index(base, "://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.regexp_extract(without_dots(path_of(base)), r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (F.when(link == "", F.lit(None))
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*+://"), link)
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*+:"), F.lit(None))
            .when(link.startswith("#"), base)
            .when(link.startswith("?"), F.concat(site, path_of(base), link))
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(site, link))
            .otherwise(F.concat(site, folder, link)))


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, action) of the longest rule that fits, else null.

    ``rules`` is the caller's own list, not data: it becomes one CASE in
    the order in which rules win.
    """
    best = None
    for action, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        hit = F.struct(F.lit(h + p).alias("rule"), F.lit(action).alias("action"))
        best = F.when(fits, hit) if best is None else best.when(fits, hit)
    if best is None:
        return F.lit(None).cast("struct<rule:string,action:string>")
    return best


def _attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, quoted or bare; empty without one."""
    pattern = _ATTRIBUTE % name
    return F.trim(F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)]))


def _named(html: Column) -> Column:
    """Array of the links of all canonical and refresh tags."""
    tags = lambda p: F.regexp_extract_all(html, F.lit(p), F.lit(0))
    canonical = F.transform(
        F.filter(tags(_LINK_TAG), lambda t: _attribute(t, "rel").rlike(r"(?i)(^|\s)canonical($|\s)")),
        lambda t: _attribute(t, "href"))
    refresh = F.transform(
        F.filter(tags(_META_TAG), lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh"),
        lambda t: F.regexp_extract(t, _REFRESH_URL, 1))
    return F.concat(canonical, refresh)


def alias_edges(pages: DataFrame) -> DataFrame:
    """Edges (u, v) between the urls of pages and the urls they name as their own."""
    html = F.coalesce(F.col("html"), F.lit(""))
    links = pages.where(html.rlike(r"(?i)canonical|refresh")).select(
        "url", F.explode(_named(html)).alias("link")).withColumn("link", F.regexp_replace("link", _AMPERSAND, "&"))
    return (links.select(node_of(F.col("url")).alias("u"),
                         node_of(absolute(F.col("link"), F.col("url"))).alias("v"))
            .where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))))


def alias_verdicts(edges: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(node, alias_verdict) for every url on an edge: what its class decides."""
    classes = components(edges)
    as_url = F.concat(F.lit("x://"), F.col("node"))
    action = matched_rule(host_of(as_url), path_of(as_url), rules)["action"]
    votes = classes.groupBy("root").agg(
        F.max(F.coalesce(action == "block", F.lit(False))).alias("blocked"),
        F.max(F.coalesce(action == "allow", F.lit(False))).alias("allowed"))
    verdict = F.when(F.col("blocked") & ~F.col("allowed"), "block").otherwise("allow")
    return classes.join(votes, "root").select("node", verdict.alias("alias_verdict"))


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``pages`` needs page_id, url and html; other columns are ignored.
    """
    pages = pages.select("page_id", "url", "html")
    url = F.col("url")
    judged = pages.select("page_id", node_of(url).alias("node"), host_of(url).alias("host"),
                          path_of(url).alias("path"))
    judged = judged.withColumn("hit", matched_rule(F.col("host"), F.col("path"), rules))
    judged = judged.join(alias_verdicts(alias_edges(pages), rules), "node", "left")
    return judged.select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.action", "alias_verdict", F.lit("allow")).alias("verdict"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: every url of ``pages`` judged by ``RULES``."""
    return filter_urls(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))


def _sql_links() -> str:
    pats = [p.replace("'", "''") for p in (*_CANONICAL, _REFRESH)]
    return "\n    UNION ALL ".join(
        f"SELECT url, regexp_extract(html, '{p}', 1) AS link FROM pages WHERE html IS NOT NULL" for p in pats)


def _sql_case(host: str, path: str, what: int, rules: Sequence[Rule] = RULES) -> str:
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0]))
    arms = " ".join(
        f"WHEN ({host} = '{h}' OR ends_with({host}, '.{h}')) AND starts_with({path}, '{p}') "
        f"THEN '{(h + p) if what == 0 else a}'" for a, h, p in ordered)
    return f"CASE {arms} END"


ORACLE = rf"""
WITH RECURSIVE parsed AS (
  SELECT page_id, url,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^#]*?(\?[^#]*)', 1) AS tail
  FROM pages),
linked AS (SELECT * FROM (
    {_sql_links()}) WHERE link <> ''),
target AS (SELECT url, CASE WHEN contains(link, '://') THEN link
    WHEN starts_with(link, '//') THEN split_part(url, '://', 1) || ':' || link
    WHEN starts_with(link, '/') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*') || link
    ELSE regexp_extract(url, '(?s)^.*?://[^/?#]*') || coalesce(nullif(regexp_extract(
         regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '^(.*/)', 1), ''), '/') || link END AS link
  FROM linked WHERE contains(url, '://')),
ends AS (SELECT regexp_extract(url, '(?s)^.*?://([^#]*)', 1) AS u, regexp_extract(link, '(?s)^.*?://([^#]*)', 1) AS v
  FROM target),
edge AS (
  SELECT translate(regexp_extract(u, '^[^/?]*'), '{_UPPER}', '{_LOWER}') || regexp_extract(u, '^[^/?]*(.*)', 1) AS u,
         translate(regexp_extract(v, '^[^/?]*'), '{_UPPER}', '{_LOWER}') || regexp_extract(v, '^[^/?]*(.*)', 1) AS v
  FROM ends),
sym AS (SELECT u, v FROM edge UNION SELECT v, u FROM edge),
reach(a, b) AS (SELECT u, u FROM sym UNION SELECT r.a, s.v FROM reach r JOIN sym s ON r.b = s.u),
judged AS (SELECT a, {_sql_case("regexp_extract(b, '^[^/?]*')", "regexp_extract(b, '^[^/?]*([^?]*)', 1)", 1)} AS action
  FROM reach),
class AS (SELECT a, bool_or(action = 'block') AND NOT coalesce(bool_or(action = 'allow'), false) AS blocked
  FROM judged GROUP BY a)
SELECT page_id, host, path, {_sql_case('host', 'path', 0)} AS rule,
       coalesce({_sql_case('host', 'path', 1)}, CASE WHEN blocked THEN 'block' END, 'allow') AS verdict
FROM parsed LEFT JOIN class ON host || path || tail = a AND contains(url, '://')
"""
