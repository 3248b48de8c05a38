"""URL filters: host and path rules, then a list of canonical URLs.

The list is held as a blocked Bloom filter whose size follows the list up to a ceiling.  A URL's keys that the filter passes
go to an exact hash join with the list, which removes false positives; the others never leave their task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bloom import passes, shared_bloom

#: (verdict, host and path) of the query; a rule fits its host and all subdomains.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
#: Canonical URLs that the query blocks where no rule fits; "site/" stands for the whole site.
LISTED = ["cheap-pills.example.com/", "cheap-pills.example.net/", "casino-win.example.net/", "casino-win.example.com/"]


def host_of(url: str | Column = "url") -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(_part(url, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str | Column = "url") -> Column:
    return _part(url, 2)


def _part(url: str | Column, k: int) -> Column:
    c = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(c, r"(?s)\A.*?://([^/?#]*)([^?#]*)", k), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` or ``m.``, and the path without closing slashes and ``.html``."""
    return F.concat(F.regexp_replace(host, r"^(?:www|m)\.", ""), F.lit("/"), F.regexp_replace(F.ltrim(path, F.lit("/")), r"(?:\.html)?/*$", ""))


def keys_of(host: Column, path: Column) -> Column:
    """What can be listed of a URL: the page itself and the sites of its host and all parents."""
    labels = F.split(host, r"\.")
    sites = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.concat(F.array_join(F.slice(labels, k, F.size(labels)), "."), F.lit("/"))
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(F.array(canonical(host, path)), sites)))


def url_filter(pages: DataFrame, listed: DataFrame, rules=RULES, bits: int | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and listed_key of every row.

    The longest rule that fits decides (equally long ones: the first stated); where none fits, a page is blocked if its canonical URL or a
    site above it is in ``listed`` (column ``key``; nulls and repeats don't matter).  Null URLs and those
    without ``://`` have an empty host and path, fit no rule and are allowed.  Repeated rows stay repeated.
    """
    rows = pages.select("page_id", host_of().alias("host"), path_of().alias("path"))
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        site, _, start = rule.partition("/")
        host = F.col("host")
        fit = ((host == site) | host.endswith("." + site)) & F.col("path").startswith("/" + start)
        fits.append((fit, rule, verdict))
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for fit, name, verdict in reversed(fits):
        rule, ruled = F.when(fit, name).otherwise(rule), F.when(fit, verdict).otherwise(ruled)
    rows = rows.withColumn("rule", rule).withColumn("ruled", ruled)

    keys = listed.where("key is not null").select("key").distinct()
    held = shared_bloom(keys.select(F.xxhash64("key").alias("h")), bits)

    possible = passes(held)
    free = rows.where("rule is null and host != ''").select("host", "path", F.explode(keys_of(F.col("host"), F.col("path"))).alias("key"))
    hits = free.where(possible(F.xxhash64("key")))
    found = hits.join(keys.hint("shuffle_hash"), "key").groupBy("host", "path").agg(F.min("key").alias("listed_key"))
    # the right side has one row for each address; a hot address on the left is split by the adaptive join
    bad = found.select(F.col("host").alias("h"), F.col("path").alias("p"), "listed_key")
    return (
        rows.join(bad.hint("merge"), F.expr("host = h and path = p and rule is null"), "left")
        .withColumn("verdict", F.coalesce("ruled", F.when(F.col("listed_key").isNotNull(), "block").otherwise("allow")))
        .select("page_id", "host", "path", "rule", "verdict", "listed_key")
    )


def default_list(spark: SparkSession, listed=LISTED) -> DataFrame:
    return spark.createDataFrame([(k,) for k in listed], "key string")
