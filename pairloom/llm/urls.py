"""URL filters: rules by host and path, block decisions passed on over redirects and canonical links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.graph import connected_components

# Fixed values: (verdict, host, path). A rule fits its host and all subdomains; the longest that fits wins.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Rules (about 60 bytes each) up to which they are sent to every executor; above, they are shuffled.
BROADCAST_ROWS = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; null or none: empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ?, # or the end; null or no ://: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: tuple = RULES) -> DataFrame:
    """verdict, host, path as a table of literals."""
    rows = F.array(*[F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules])
    return spark.range(1).select(F.inline(rows.cast("array<struct<verdict:string,host:string,path:string>>")))


def alias_edges(pages: DataFrame) -> DataFrame:
    """pages (url, html) -> src, dst: URLs that a page names as itself: its canonical link, and the target of an
    immediate refresh. Links that don't hold :// are relative to the page's scheme and host. A URL's fragment is never
    sent to a server, so it is left out on both ends. Null url or html: no edge."""
    attribute = lambda tag, name: F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*["']?([^"'>\s]+)""", 1)
    tags = pages.where("url is not null").select("url", F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("tag"))
    canonical = F.when(F.col("tag").rlike(r"""(?is)^<link\b.*\srel\s*=\s*["']?canonical\b"""), attribute(F.col("tag"), "href"))
    refresh = F.when(F.col("tag").rlike(r"""(?is)^<meta\b.*http-equiv\s*=\s*["']?refresh\b"""), F.regexp_extract("tag", r"""(?is)url\s*=\s*([^"'>\s]+)""", 1))
    to = tags.select("url", F.coalesce(canonical, refresh).alias("to")).where("to <> ''")
    base = F.regexp_extract("url", r"(?s)^(.*?://[^/?#]*)", 1)
    full = F.when(F.col("to").contains("://"), F.col("to")).when(F.col("to").startswith("//"), F.concat(F.regexp_extract("url", r"(?s)^(.*?:)//", 1), "to")).otherwise(F.concat(base, F.when(F.col("to").startswith("/"), F.lit("")).otherwise(F.lit("/")), "to"))
    return to.select(bare(F.col("url")).alias("src"), bare(full).alias("dst"))


def bare(url: Column) -> Column:
    """The URL without fragment, its host in lower case."""
    no_fragment = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    head = F.regexp_extract(no_fragment, r"(?s)^(.*?://[^/?]*)", 1)
    return F.concat(F.translate(head, _UPPER, _LOWER), F.substr(no_fragment, F.length(head) + 1))


def match_rules(urls: DataFrame, rules: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """urls (url) -> url, rule, verdict for those that a rule fits.

    Each URL looks up its host's last labels, as many as some rule's host has, with its path cut to each length that a
    rule's path has, by equality: a host with very many rules costs no more than one with few, and one of very many labels
    takes time in proportion to its length. Of two rules of one length, block wins.
    """
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().sort("length(path)").collect()]  # as many as the longest path has characters, at most
    n_labels = lambda h: F.length(h) - F.length(F.replace(h, F.lit("."), F.lit(""))) + 1
    depths = [r[0] for r in rules.where("host is not null").select(n_labels(F.col("host")).alias("n")).distinct().sort("n").collect()]  # as many as the longest host has labels, at most
    small = rules.count() <= broadcast_rows
    table = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    suffixes = F.array_compact(F.array(*[F.when(n_labels(F.col("h")) >= n, F.substring_index("h", ".", -n)) for n in depths])).cast("array<string>")
    cuts = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("p"))
    keys = urls.select("url", host(F.col("url")).alias("h"), path(F.col("url")).alias("p"))
    keys = keys.select("url", "p", "h", F.explode(suffixes).alias("host")).select("url", "host", "p", F.explode(cuts).alias("n")).select("url", "host", F.left("p", "n").alias("path"))
    found = keys.join(F.broadcast(table) if small else table, ["host", "path"])
    best = found.groupBy("url").agg(F.max(F.struct((F.length("host") + F.length("path")).alias("n"), "verdict", "host", "path")).alias("b"))
    return best.select("url", F.concat("b.host", "b.path").alias("rule"), "b.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame | None = None, redirects: DataFrame | None = None) -> DataFrame:
    """pages (page_id, url, html; others are ignored), redirects (src, dst) -> page_id, url, host, path, rule, verdict,
    component (null where the URL has no alias).

    A rule's verdict stands. A URL that no rule fits takes the decision of its aliases: the connected component over
    redirects, canonical links and immediate refreshes. There an explicit allow comes before a block, and where neither
    is, the URL is allowed. The targets of links needn't be pages themselves: rules are applied to them too.

    Each distinct URL is judged once, so a URL of very many pages costs one row; pages get it back by a join that AQE
    can split. A null url, or one without ://, has an empty host and path, fits no rule and is allowed. Repeated rows
    stay. An empty table gives no rows.
    """
    rules = rule_table(pages.sparkSession) if rules is None else rules
    p = pages.select("page_id", "url", "html")
    edges = alias_edges(p)
    if redirects is not None:
        edges = edges.union(redirects.select(bare(F.col("src")), bare(F.col("dst"))))
    edges = edges.where("src is not null and dst is not null and src <> dst").distinct()
    groups = connected_components(edges.select(F.col("src"), F.col("dst")))
    urls = p.select("url").where("url is not null").distinct()
    judged = match_rules(urls.union(groups.select("id")).distinct(), rules)
    at = groups.join(judged, groups["id"] == judged["url"], "left")
    decided = at.groupBy("component").agg(F.when(F.max(F.col("verdict") == "allow"), "allow").when(F.max(F.col("verdict") == "block"), "block").otherwise("allow").alias("passed_on"))
    member = groups.join(decided, "component").withColumnRenamed("id", "bare")
    of_url = urls.join(judged, "url", "left").withColumn("bare", bare(F.col("url"))).join(member, "bare", "left")
    of_url = of_url.select(F.col("url").alias("at"), "rule", F.coalesce("verdict", "passed_on").alias("verdict"), "component")
    return p.join(of_url, p["url"] == of_url["at"], "left").select(
        "page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"), "component"
    )
