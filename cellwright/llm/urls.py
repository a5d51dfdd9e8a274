"""URL rules: an index of rules by their rarest literal token, regular expressions only on candidates.

A rule is a host and a path prefix with a verdict. It fits the URLs of its host
and of all subdomains whose path starts with the rule's path. Every URL is cut
into literal tokens (host labels and whole path segments). Each rule is filed
under the one of its own tokens that the fewest URLs hold, so a rule about
``org`` with path ``/es/`` is looked up by whichever of the two is rarer. URLs
fetch candidate rules by token; only those run their regular expression.

Defined results
    null URL or no ``://``      host and path empty; no rule; the default verdict
    no fitting rule             rule null, default verdict
    several fitting rules       the longest (host and path together) wins; of equal
                                length the alphabetically first, then ``allow``
    repeated rows               each is judged and returned
    empty pages or empty rules  no rows / all rows with the default verdict
    other columns               kept out; only ``page_id`` and ``url`` are read
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: fixed values: (host, path, verdict)
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host is lower-cased in A-Z; both are '' without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def tokens(host: Column, path: Column, prefix: bool) -> Column:
    """Literal tokens of a URL, or of a rule (``prefix``: its last path segment may go on in a URL)."""
    labels = F.transform(F.filter(F.split(host, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x))
    segments = F.split(path, "/")
    if prefix:
        segments = F.slice(segments, 1, F.greatest(F.size(segments) - 1, F.lit(0)))
    segments = F.transform(F.filter(segments, lambda x: x != ""), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(labels, segments))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """rule_host, rule_path, rule_verdict from a list; any table of that shape will do."""
    return spark.createDataFrame(rules, "rule_host string, rule_path string, rule_verdict string")


def index_rules(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Each rule under its rarest literal token, counted over ``urls`` (host, path).

    A rule without any literal token (empty host, path of one open segment)
    goes under the token every URL has, ``*``.
    """
    own = rules.select(
        "rule_host", "rule_path", "rule_verdict",
        F.explode_outer(tokens(F.col("rule_host"), F.col("rule_path"), prefix=True)).alias("token"),
    )
    wanted = own.where("token IS NOT NULL").select("token").distinct()
    seen = (
        urls.select(F.explode(tokens(F.col("host"), F.col("path"), prefix=False)).alias("token"))
        .groupBy("token").agg(F.count(F.lit(1)).alias("n"))
        .join(wanted, "token", "left_semi")
    )
    ranked = own.join(seen, "token", "left").groupBy("rule_host", "rule_path", "rule_verdict").agg(
        F.min(F.when(F.col("token").isNotNull(), F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("token").alias("t")))).alias("best")
    )
    host = F.concat(F.lit(r"(?s)^([^/]*\.)?\Q"), "rule_host", F.lit(r"\E"))
    return ranked.select(
        F.coalesce(F.col("best.t"), F.lit("*")).alias("token"),
        F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict",
        F.concat(host, F.lit(r"\Q"), "rule_path", F.lit(r"\E.*$")).alias("pattern"),
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url).

    Distinct URLs are judged, once each, and joined back to the pages; both
    sides of every join are shuffled joins that the planner may turn into
    broadcasts by measured size, or split where a token or URL is very frequent.
    """
    host, path = url_parts(F.col("url"))
    parted = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = parted.select("host", "path").distinct()
    index = index_rules(rules, urls)
    looked_up = urls.select(
        "host", "path",
        F.explode(F.concat(tokens(F.col("host"), F.col("path"), prefix=False), F.array(F.lit("*")))).alias("token"),
    )
    fits = looked_up.join(index, "token").where("concat(host, path) RLIKE pattern")
    best = fits.groupBy("host", "path").agg(
        F.min(F.struct((-F.length("rule")).alias("k"), F.col("rule").alias("rule"), F.col("rule_verdict").alias("v"))).alias("best")
    )
    return parted.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.v"), F.lit(default)).alias("verdict"),
    )
