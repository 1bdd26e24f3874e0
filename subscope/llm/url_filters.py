"""URL rules by expressions and hash prefixes.

A rule is a host and the beginning of a path; it fits the host, all its subdomains, and every path that begins so. Every
distinct URL is expanded into expressions: each host suffix at a dot, with the path up to each slash. The first
four bytes of an expression's SHA-256 are equi-joined with those of the rules, the full digests confirm a match, and
the longest rule that fits gives the verdict.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Leading hexadecimal digits of a digest that are joined on.
PREFIX = 8
#: What holds where no rule fits.
DEFAULT = "allow"

RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, with A-Z in lower case; empty without :// or for null."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\0", host, path), 256)


def _folder(path: Column) -> Column:
    """The path up to its last slash: what a rule is looked up by."""
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def keyed_rules(rules: DataFrame) -> DataFrame:
    """Rules (verdict, host, path) with their digest, its prefix and the rule as text.

    The host counts in lower case. Null parts count as empty; a rule without a host fits nothing and goes. Of
    rules with the same host and path a block wins.
    """
    host = F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER)
    rules = rules.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host <> ''")
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    digest = _digest(F.col("host"), _folder(F.col("path")))
    return rules.select(
        digest.alias("digest"), F.substring(digest, 1, PREFIX).alias("prefix"),
        "host", F.concat("host", "path").alias("rule"), F.col("path").alias("rule_path"), "verdict",
    )


def judged_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Per row: page_id, host, path, rule (the longest that fits, else null) and verdict (the rule's, else DEFAULT).

    `pages` needs page_id and url; other columns are ignored. A url that is null or has no :// has an empty host and
    path, which no rule fits. Equal urls are judged once; repeated rows give a row each. Of fitting rules of the same
    length the one with the longer host wins; there is no further tie, as both are then the same rule.
    """
    urls = pages.select("url").where("url IS NOT NULL").distinct()
    urls = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).where("host <> ''")
    # Every suffix of the host at a dot, and the path up to every slash, as well as no path at all.
    keyed = keyed_rules(rules)
    # No expression is longer than the rules have labels and slashes.
    labels, slashes = keyed.agg(F.max(F.size(F.split("host", "[.]"))), F.max(F.size(F.split("rule_path", "/")) - 1)).head()
    suffixes = (
        f"transform(array(split(host, '[.]')), p -> transform(sequence(greatest(1, size(p) - {labels or 1} + 1), size(p)),"
        " i -> array_join(slice(p, i, size(p)), '.')))[0]"
    )
    folders = (
        f"transform(array(split(path, '/')), p -> transform(sequence(0, least(size(p) - 1, {slashes or 0})),"
        " i -> CASE WHEN i = 0 THEN '' ELSE concat(array_join(slice(p, 1, i), '/'), '/') END))[0]"
    )
    each = urls.select("url", "path", F.explode_outer(F.expr(suffixes)).alias("suffix"), F.expr(folders).alias("folders"))
    each = each.select("url", "path", "suffix", F.explode_outer("folders").alias("folder"))
    each = each.select("url", "path", _digest(F.col("suffix"), F.col("folder")).alias("full"))
    each = each.withColumn("prefix", F.substring("full", 1, PREFIX))
    fits = each.join(keyed.drop("host"), "prefix").where("full = digest AND startswith(path, rule_path)")
    order = F.struct(F.length("rule"), F.length("rule") - F.length("rule_path"), "rule")
    best = fits.groupBy("url").agg(F.max_by(F.struct("rule", "verdict"), order).alias("best"))
    joined = pages.select("page_id", "url").join(best, "url", "left")
    return joined.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(DEFAULT)).alias("verdict"),
    )
