"""URL filter with redirect equivalence.

Every URL has an explicit verdict by the longest rule that fits, or none.
URLs that only differ in scheme, fragment, trailing slash or tracking
parameters are one node; canonical links and meta refreshes in the pages'
HTML are edges between nodes.  Over the connected components of these edges
block decisions spread to all aliases, except where some alias is explicitly
allowed: an explicit allow wins for the aliases without a rule.  A URL's own
rule always stands; what nothing decides is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.common import all_of, any_of, ascii_lower, connected_components, load
from churnlake.session import checkpoint

# fixed rules: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
URL = r"^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
CANONICAL = r"""<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
REFRESH = r"""<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
HREF = r"""\bhref\s*=\s*["']?([^"'\s>]+)"""
TO = r"""\burl\s*=\s*["']?([^"'\s>]+)"""
TRACKING = r"([?&])(?:utm_[^&]*|ref=[^&]*)(?=&|$)"


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)" + URL, group), F.lit(""))


def with_rule(df: DataFrame, url: str, rules: tuple = RULES) -> DataFrame:
    """Adds host, path, rule (host and path of the longest that fits) and ruling."""
    df = df.withColumns({"host": ascii_lower(_part(F.col(url), 1)), "path": _part(F.col(url), 2)})
    fits = [(h, p, v, all_of([any_of([F.col("host") == h, F.col("host").endswith("." + h)]), F.col("path").startswith(p)]))
            for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))]
    return df.withColumns({
        "rule": F.coalesce(F.lit(None).cast("string"), *[F.when(c, F.lit(h + p)) for h, p, _, c in fits]),
        "ruling": F.coalesce(F.lit(None).cast("string"), *[F.when(c, F.lit(v)) for _, _, v, c in fits])})


def node_of(url: Column) -> Column:
    """What names a URL and its spellings; a URL without :// stands for itself, null for nothing."""
    query = F.regexp_replace(F.regexp_replace(_part(url, 3), TRACKING, "$1"), "[?&]+$", "")
    query = F.regexp_replace(F.regexp_replace(query, r"\?&+", "?"), "&&+", "&")
    return F.when(url.contains("://"), F.concat(ascii_lower(_part(url, 1)), F.regexp_replace(_part(url, 2), "/+$", ""), query)
                  ).otherwise(url)


def _target(tag: str, inside: str, html: Column, url: Column) -> Column:
    """The absolute URL that a tag points to, null without one."""
    href = F.regexp_extract(F.regexp_extract(html, "(?is)" + tag, 0), "(?is)" + inside, 1)
    base = F.concat(F.lit("http://"), _part(url, 1))
    full = (F.when(href.contains("://"), href).when(href.startswith("//"), F.concat(F.lit("http:"), href))
            .when(href.startswith("/"), F.concat(base, href))
            .otherwise(F.concat(base, F.regexp_replace(_part(url, 2), "[^/]*$", ""), F.lit(""), href)))
    return F.when(all_of([F.coalesce(href, F.lit("")) != "", F.coalesce(url, F.lit("")).contains("://")]), full)


def filter_urls(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, component (a node's name).

    A null url has empty host and path, belongs to no component and is allowed; null HTML has no links;
    repeated rows stay.
    """
    read = pages.select("page_id", "url", _target(CANONICAL, HREF, F.col("html"), F.col("url")).alias("canonical"),
                        _target(REFRESH, TO, F.col("html"), F.col("url")).alias("refresh"))
    read = checkpoint(with_rule(read, "url", rules).withColumn("node", node_of(F.col("url"))))
    links = read.select("node", F.explode(F.array_compact(F.array("canonical", "refresh"))).alias("to"))
    links = checkpoint(with_rule(links, "to", rules).withColumn("to_node", node_of(F.col("to"))))
    found = connected_components(links.select(F.col("node").alias("u"), F.col("to_node").alias("v")))
    found = checkpoint(found.select(F.col("node").alias("__n"), F.col("component").alias("__c")))

    def placed(df: DataFrame) -> DataFrame:
        return (df.join(found, F.col("node") == F.col("__n"), "left")
                .withColumn("component", F.coalesce("__c", "node")).drop("__n", "__c"))

    ruled = read.where("ruling IS NOT NULL").select("node", "ruling").union(
        links.where("ruling IS NOT NULL").select(F.col("to_node").alias("node"), "ruling"))
    said = placed(ruled).groupBy(F.col("component").alias("__k")).agg(
        F.max((F.col("ruling") == "allow").cast("int")).alias("allowed"),
        F.max((F.col("ruling") == "block").cast("int")).alias("blocked"))
    out = placed(read)
    out = out.join(said, out["component"] == said["__k"], "left")
    spread = F.when((F.col("blocked") == 1) & (F.col("allowed") == 0), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruling", spread).alias("verdict"), "component")


def op2_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages."""
    return filter_urls(load(spark, sf_dir, "pages"))
