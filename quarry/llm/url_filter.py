"""URL filters: explicit host and path rules, then redirect equivalence.

A URL's own verdict is that of its longest fitting rule (host and subdomains,
path prefix; of equal lengths the longer host, then allow). A URL without a
rule takes its component's decision: URLs are nodes under a normalised key
(host, path without closing slashes, query without tracking parameters);
canonical links and refreshes found in the pages, and given redirects, are
edges; a component holding an explicitly allowed URL allows its aliases, else
one holding a blocked URL blocks them, else they are allowed.

Null URLs and such without ``://`` have empty host and path and no key, hence
no aliases: they are allowed unless a rule fits. Rules may be any number;
they meet the URLs' distinct hosts through a join on host suffixes. Repeated
rows stay repeated, null pages have no links, extra columns are ignored.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import table, written
from quarry.llm.graph import components

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TRACKING = r"(?i)(^|&)(utm_[a-z]+|ref|gclid|fbclid)=[^&]*"

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _AZ, _AZ.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def key_of(url: Column) -> Column:
    """The node of a URL in the alias graph; null if it has no host."""
    host = F.regexp_replace(host_of(url), ":(80|443)$", "")
    query = F.regexp_replace(F.regexp_replace(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), _TRACKING, ""), "^&+", "")
    key = F.concat(host, F.regexp_replace(path_of(url), "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host != "", key)


def page_links(pages: DataFrame) -> DataFrame:
    """(src, dst) absolute URLs: canonical links and refreshes of the pages."""
    html = F.coalesce(F.col("html"), F.lit(""))
    attr = lambda tag, name: F.regexp_extract(tag, rf"""(?is)\b{name}\s*=\s*["']?\s*([^"'\s>]+)""", 1)
    canon = F.transform(F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<link\b[^>]*>"), F.lit(0)), lambda t: t.rlike(r"""(?is)\brel\s*=\s*["']?\s*canonical\b""")), lambda t: attr(t, "href"))
    fresh = F.transform(F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0)), lambda t: t.rlike(r"""(?is)\bhttp-equiv\s*=\s*["']?\s*refresh\b""")), lambda t: attr(t, "url"))
    found = pages.where(F.col("url").contains("://")).select(F.col("url").alias("src"), F.explode(F.array_distinct(F.concat(canon, fresh))).alias("to")).where("to <> ''")
    scheme = F.regexp_extract("src", "(?s)^(.*?)://", 1)
    base = F.concat(scheme, F.lit("://"), host_of(F.col("src")))
    to = F.col("to")
    dst = (
        F.when(to.contains("://"), to)
        .when(to.startswith("//"), F.concat(scheme, F.lit(":"), to))
        .when(to.startswith("/"), F.concat(base, to))
        .otherwise(F.concat(base, F.regexp_replace(path_of(F.col("src")), "[^/]*$", ""), to))
    )
    return found.select("src", dst.alias("dst"))


def judge_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``.

    ``rules``: rule (``host/path``), action; ``redirects``: src, dst URLs.
    """
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), key_of(url).alias("key"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    listed = rules.where("rule is not null and action in ('allow', 'block')").select(
        F.translate(F.substring_index("rule", "/", 1), _AZ, _AZ.lower()).alias("suffix"), F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("p"), "rule", "action"
    )
    # Per distinct host, the rules of its suffixes.
    fit = (
        rows.select("host").distinct().select("host", F.explode(suffixes).alias("suffix")).join(listed, "suffix")
        .groupBy("host").agg(F.collect_list(F.struct(F.length("rule").alias("n"), F.length("suffix").alias("h"), (F.col("action") == "allow").alias("allow"), "rule", "p")).alias("fit"))
    )
    best = F.array_max(F.filter("fit", lambda r: F.col("path").startswith(r["p"])))
    judged = written(rows.join(fit, "host", "left").withColumn("best", best).select("page_id", "host", "path", "key", F.col("best.rule").alias("rule"), F.col("best.allow").alias("allow")), "judged-urls")

    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("src", "dst"))
    parts = components(links.select(key_of(F.col("src")).alias("a"), key_of(F.col("dst")).alias("b"))).withColumnRenamed("node", "key")
    known = judged.join(parts, "key", "left").withColumn("component", F.coalesce("component", "key"))
    told = known.where("rule is not null and component is not null").groupBy("component").agg(F.max("allow").alias("any_allow"))
    verdict = F.when(F.coalesce("allow", "any_allow", F.lit(True)), "allow").otherwise("block")
    return known.join(told, "component", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "rule string, action string"))


OP1_SQL = r"""
WITH RECURSIVE urls AS (SELECT url FROM pages UNION SELECT url FROM (
  SELECT CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || t
    WHEN starts_with(t, '/') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || '://' || regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) || t
    ELSE regexp_extract(url, '(?s)^(.*?)://', 1) || '://' || regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) || regexp_replace(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '[^/]*$', '') || t END AS url
  FROM (SELECT url, unnest(
    list_transform(list_filter(regexp_extract_all(coalesce(html, ''), '(?is)<link\b[^>]*>'), lambda x: regexp_matches(x, '(?is)\brel\s*=\s*["'']?\s*canonical\b')), lambda x: regexp_extract(x, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1))
    || list_transform(list_filter(regexp_extract_all(coalesce(html, ''), '(?is)<meta\b[^>]*>'), lambda x: regexp_matches(x, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')), lambda x: regexp_extract(x, '(?is)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1))) AS t
  FROM pages WHERE contains(url, '://')) WHERE t <> '')),
split AS (SELECT url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
  coalesce(regexp_replace(regexp_replace(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '(?i)(^|&)(utm_[a-z]+|ref|gclid|fbclid)=[^&]*', '', 'g'), '^&+', ''), '') AS q FROM urls),
keyed AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, ':(80|443)$', '') || regexp_replace(path, '/+$', '') || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS key FROM split),
links AS (SELECT DISTINCT s.key AS a, d.key AS b FROM (
  SELECT url, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || t
    WHEN starts_with(t, '/') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || '://' || regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) || t
    ELSE regexp_extract(url, '(?s)^(.*?)://', 1) || '://' || regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) || regexp_replace(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '[^/]*$', '') || t END AS dst
  FROM (SELECT url, unnest(
    list_transform(list_filter(regexp_extract_all(coalesce(html, ''), '(?is)<link\b[^>]*>'), lambda x: regexp_matches(x, '(?is)\brel\s*=\s*["'']?\s*canonical\b')), lambda x: regexp_extract(x, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1))
    || list_transform(list_filter(regexp_extract_all(coalesce(html, ''), '(?is)<meta\b[^>]*>'), lambda x: regexp_matches(x, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')), lambda x: regexp_extract(x, '(?is)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1))) AS t
  FROM pages WHERE contains(url, '://')) WHERE t <> '') l JOIN keyed s ON s.url = l.url JOIN keyed d ON d.url = l.dst WHERE s.key IS NOT NULL AND d.key IS NOT NULL),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT DISTINCT a, a AS b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b),
part AS (SELECT a AS key, min(b) AS component FROM reach GROUP BY a),
rules(rule, allow) AS (VALUES ('com/', true), ('example.com/en/', false), ('www.example.com/en/', true), ('net/es/', false), ('net/fr/', false)),
ruled AS (SELECT k.*, coalesce(component, k.key) AS component,
  (SELECT max({'n': length(rule), 'allow': allow, 'rule': rule}) FROM rules
   WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, substr(rule, length(split_part(rule, '/', 1)) + 1))) AS best
  FROM keyed k LEFT JOIN part USING (key)),
on_page AS (SELECT p.page_id, r.* FROM pages p JOIN ruled r ON r.url IS NOT DISTINCT FROM p.url),
told AS (SELECT component, bool_or(best.allow) AS any_allow FROM on_page WHERE best IS NOT NULL AND component IS NOT NULL GROUP BY component)
SELECT page_id, host, path, best.rule AS rule, CASE WHEN coalesce(best.allow, any_allow, true) THEN 'allow' ELSE 'block' END AS verdict
FROM on_page LEFT JOIN told USING (component)
"""
