"""URL filters with redirect equivalence (operator 8), in DataFrame operations only.

A rule (host, path, allow or block) fits its host and all subdomains if the
url's path starts with the rule's path; the longest rule wins.  Pages tell of
aliases: a canonical link or a refresh redirect in the html is an edge between
two urls.  The connected components of these edges are the classes of urls for
one document, and decisions spread over a class: a url without a rule of its
own is blocked if a member of its class is blocked, unless a member is
explicitly allowed; a url's own rule always wins.  Urls outside the table that
edges lead to are members too, and rules fit them likewise.

Rules are matched by an equi-join of the host's suffixes with the rules' hosts
(rules are broadcast only when counted to be few); components come from
``components`` (no collected links).  A host with a third of all pages is one
key of no join: rules join before any shuffle, or on distinct (host, path).

Edges.  A null url, or one without ``://``, has empty host and path: no rule fits
and it is allowed.  A url's fragment is no part of its identity.  A null html
has no edges; relative links are resolved against the page.  Repeated rows are
judged alike, each on its own row.  Without edges or rules everything unruled is
allowed; an empty table gives an empty result.  Only page_id, url and html are
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexaccess.llm.common import read_table, stage_table
from hexaccess.llm.components import components

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
BROADCAST_RULES = 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HOST, _PATH = "://([^/?#]*)", "://[^/?#]*([^?#]*)"
_LINK, _META = r"(?is)<link\b[^>]*>", r"(?is)<meta\b[^>]*>"
_CANONICAL = r"""(?i)\brel\s*=\s*(?:["']?\s*canonical\b|"[^"]*\scanonical(?=[\s"])|'[^']*\scanonical(?=[\s']))"""
_REFRESH = r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b"""
#: A value in either quotes, or without: one of three groups.
_HREF = r"""(?i)(?<![\w-])href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^"'>\s]+))"""
_URL = r"""(?i)\burl\s*=\s*["']?([^"'>\s]+)"""


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "rule_host string, rule_path string, rule_verdict string")


def with_rules(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rows`` (host, path and others) with the longest fitting rule (text) and its verdict, or nulls."""
    n_rules, longest = rules.agg(F.count("*"), F.max(F.size(F.split("rule_host", r"\.")))).first()
    few, longest = n_rules <= BROADCAST_RULES, longest or 1
    # no rule fits by more labels than the longest rule host has, so a host gives at most so many suffixes
    suffixes = F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda i: F.call_function("substring_index", F.col("host"), F.lit("."), -i))
    pairs = rows.select("host", "path").distinct().withColumn("_suffix", F.explode(F.array_distinct(suffixes)))
    text = F.concat("rule_host", "rule_path")
    best = (pairs.join(F.broadcast(rules) if few else rules, F.col("_suffix") == F.col("rule_host"))
            .where(F.startswith("path", "rule_path"))
            .groupBy(F.col("host").alias("_host"), F.col("path").alias("_path"))
            .agg(F.max(F.struct(F.length(text).alias("n"), text.alias("rule"), "rule_verdict")).alias("_best")))
    return (rows.join(best, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left")
            .withColumn("rule", F.col("_best.rule")).withColumn("rule_verdict", F.col("_best.rule_verdict"))
            .drop("_host", "_path", "_best"))


def node(url: Column) -> Column:
    """What tells a url: its text without the fragment, the host in lower case; null if it has no host."""
    whole = F.substring_index(url, "#", 1)
    return F.when(host(url) != "", F.concat(F.substring_index(whole, "://", 1), F.lit("://"), host(url),
                                            F.regexp_extract(whole, "(?s)://[^/?#]*(.*)$", 1)))


def _resolved(link: Column, url: Column) -> Column:
    scheme = F.substring_index(url, "://", 1)
    site = F.concat(scheme, F.lit("://"), host(url))
    folder = F.regexp_replace(path(url), "[^/]*$", "")
    return (F.when(link == "", F.lit(None))
            .when(link.contains("://"), link)
            .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
            .when(F.startswith(link, F.lit("/")), F.concat(site, link))
            .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), link)))


def page_edges(pages: DataFrame) -> DataFrame:
    """(u, v): page and the url that its canonical link or refresh redirect names."""
    links = F.concat(
        F.transform(F.filter(F.regexp_extract_all("html", F.lit(_LINK), F.lit(0)), lambda t: t.rlike(_CANONICAL)),
                    lambda t: F.concat(*[F.regexp_extract(t, _HREF, i) for i in (1, 2, 3)])),
        F.transform(F.filter(F.regexp_extract_all("html", F.lit(_META), F.lit(0)), lambda t: t.rlike(_REFRESH)),
                    lambda t: F.regexp_extract(t, _URL, 1)))
    return (pages.select("url", F.explode(links).alias("link"))
            .select(node(F.col("url")).alias("u"),
                    node(_resolved(F.replace(F.trim("link"), F.lit("&amp;"), F.lit("&")), F.col("url"))).alias("v"))
            .where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct())


def judge(pages: DataFrame, rules: DataFrame, more_edges: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every page.  ``more_edges``: (u, v) urls known to redirect."""
    edges = page_edges(pages)
    if more_edges is not None:
        edges = edges.union(more_edges.select(node(F.col("u")), node(F.col("v")))).where("u IS NOT NULL AND v IS NOT NULL")
    classes = stage_table(components(stage_table(edges, "edges")), "classes")
    members = with_rules(classes.select("node", "component", host(F.col("node")).alias("host"), path(F.col("node")).alias("path")), rules)
    spread = (members.groupBy("component").agg(
        F.max(F.col("rule_verdict") == "allow").alias("_allow"), F.max(F.col("rule_verdict") == "block").alias("_block"))
        .withColumn("_spread", F.when(F.col("_allow"), "allow").when(F.col("_block"), "block").otherwise("allow")))
    by_node = classes.join(spread, "component").select(F.col("node").alias("_node"), "_spread")
    rows = pages.select("page_id", node(F.col("url")).alias("_of"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    judged = with_rules(rows, rules).join(by_node, F.col("_of") == F.col("_node"), "left")
    return judged.select("page_id", "host", "path", "rule",
                         F.coalesce("rule_verdict", "_spread", F.lit("allow")).alias("verdict"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages"), rule_table(spark))


OP8_SQL = r"""
WITH RECURSIVE rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
p AS (
  SELECT page_id, url, html, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
links AS (
  SELECT url, host, path, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(html, '(?is)<link\b[^>]*>'), lambda t: regexp_matches(t, '(?i)\brel\s*=\s*(?:["'']?\s*canonical\b|"[^"]*\scanonical[\s"]|''[^'']*\scanonical[\s''])')),
                   lambda t: concat(regexp_extract(t, '(?i)(?:^|[^\w-])href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^"''>\s]+))', 1), regexp_extract(t, '(?i)(?:^|[^\w-])href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^"''>\s]+))', 2), regexp_extract(t, '(?i)(?:^|[^\w-])href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^"''>\s]+))', 3))),
    list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\b[^>]*>'), lambda t: regexp_matches(t, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b')),
                   lambda t: regexp_extract(t, '(?i)\burl\s*=\s*["'']?([^"''>\s]+)', 1)))) AS raw FROM p),
whole AS (
  SELECT split_part(url, '#', 1) AS a, replace(trim(raw), '&amp;', '&') AS link, split_part(url, '://', 1) AS scheme, host, path FROM links),
full_links AS (
  SELECT a, split_part(CASE WHEN link = '' THEN NULL WHEN contains(link, '://') THEN link
      WHEN starts_with(link, '//') THEN scheme || ':' || link WHEN starts_with(link, '/') THEN scheme || '://' || host || link
      ELSE scheme || '://' || host || CASE WHEN regexp_replace(path, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END || link END, '#', 1) AS b
  FROM whole),
named AS (
  SELECT split_part(x, '://', 1) || '://' || translate(regexp_extract(x, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
         || regexp_extract(x, '(?s)://[^/?#]*(.*)$', 1) AS n, x, regexp_extract(x, '://([^/?#]*)', 1) AS h
  FROM (SELECT a AS x FROM full_links UNION SELECT b FROM full_links UNION SELECT split_part(url, '#', 1) FROM p)),
pairs AS (
  SELECT DISTINCT s.n AS u, t.n AS v FROM full_links f JOIN named s ON f.a = s.x JOIN named t ON f.b = t.x WHERE s.h <> '' AND t.h <> '' AND s.n <> t.n),
both_ways AS (SELECT u, v FROM pairs UNION SELECT v, u FROM pairs),
reach(u, v) AS (SELECT u, u FROM both_ways UNION SELECT r.u, b.v FROM reach r JOIN both_ways b ON r.v = b.u),
sites AS (SELECT n AS site, coalesce(regexp_extract(n, '://([^/?#]*)', 1), '') AS host, coalesce(regexp_extract(n, '://[^/?#]*([^?#]*)', 1), '') AS path FROM named WHERE h <> ''
          UNION SELECT NULL, host, path FROM p),
best AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
  FROM (SELECT DISTINCT host, path FROM sites) JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY ALL),
spread AS (
  SELECT r.u, CASE WHEN bool_or(b.rule_verdict = 'allow') THEN 'allow' WHEN bool_or(b.rule_verdict = 'block') THEN 'block' ELSE 'allow' END AS spread
  FROM reach r JOIN sites s ON r.v = s.site LEFT JOIN best b ON s.host = b.host AND s.path = b.path GROUP BY r.u)
SELECT p.page_id, p.host, p.path, best.rule, coalesce(best.rule_verdict, spread.spread, 'allow') AS verdict
FROM p LEFT JOIN best ON p.host = best.host AND p.path = best.path
LEFT JOIN named ON split_part(p.url, '#', 1) = named.x LEFT JOIN spread ON named.n = spread.u
"""
