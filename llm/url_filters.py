"""URL rules by host-suffix and path-prefix expressions, looked up by hash prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hex digits of the SHA-256 digest that the equi-join uses (32 bits).
PREFIX_DIGITS = 8

#: The rules of the registered query (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column, counts: list[int]) -> Column:
    """The last ``n`` labels for each n of ``counts``, up to the whole host."""
    labels = F.split(host, r"\.")
    fitting = F.filter(F.array(*[F.lit(n) for n in counts]).cast("array<int>"), lambda n: n <= F.size(labels))
    return F.transform(fitting, lambda n: F.array_join(F.slice(labels, -n, n), "."))


def url_verdicts(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Judge every page's url: page_id, host, path, rule, verdict.

    Each url becomes the expressions host-suffix + path-prefix, with a suffix for every number of
    labels and a prefix for every path length that some rule has. Expressions meet rules in an equi-join on the first
    hex digits of their SHA-256 digests; a hit counts if the whole digest agrees. The
    longest rule wins, and of equal rules that differ in verdict ``block`` wins; urls
    without a hit get ``default`` and a null rule. The rules are aggregated by expression
    and joined like any table, so neither a hot host nor a long rule list meets in one task:
    each url's expressions are generated and, after the join, reduced in the same partition
    before the one shuffle by row.

    A url that is null or has no ``://`` has an empty host and path and no hit. Repeated rows
    are judged each by itself. Empty path prefixes and rules with null host or path: a null
    path counts as empty, a rule without host is ignored. Other columns are ignored.
    """
    r = (rules.where(F.col("host").isNotNull() & (F.col("host") != ""))
         .select((F.concat("host", F.coalesce("path", F.lit("")))).alias("_rule"),
                 F.length(F.coalesce("path", F.lit(""))).alias("_plen"), F.size(F.split("host", r"\.")).alias("_labels"),
                 F.col("verdict").alias("_verdict")))
    # the label counts and path lengths in use: a few numbers, no longer than a url's host and path
    counts, lengths = map(sorted, r.agg(F.collect_set("_labels"), F.collect_set("_plen")).first())
    r = (r.groupBy("_rule").agg(F.max(F.col("_verdict") == "block").alias("_block"))
         .withColumn("_digest", F.sha2("_rule", 256)))
    r = r.withColumn("_key", F.substring("_digest", 1, PREFIX_DIGITS))

    base = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
                        F.monotonically_increasing_id().alias("_rid"))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"),
                       lambda n: n <= F.length("path"))
    expressions = F.when(F.col("host") != "", F.flatten(F.transform(
        host_suffixes(F.col("host"), counts),
        lambda h: F.transform(fitting, lambda n: F.concat(h, F.substring(F.col("path"), F.lit(1), n))))))
    e = base.select("*", F.explode_outer(expressions).alias("_expr"))
    e = e.withColumn("_hash", F.sha2("_expr", 256)).withColumn("_key", F.substring("_hash", 1, PREFIX_DIGITS))
    hit = F.when(F.col("_hash") == F.col("_digest"),
                 F.struct(F.length("_rule").alias("n"), F.col("_block").alias("block"), F.col("_rule").alias("rule")))
    best = (e.join(r, "_key", "left").groupBy("_rid", "page_id", "host", "path")
            .agg(F.max(hit).alias("_hit")))
    verdict = (F.when(F.col("_hit").isNull(), default).when(F.col("_hit.block"), "block").otherwise("allow"))
    return best.select("page_id", "host", "path", F.col("_hit.rule").alias("rule"), verdict.alias("verdict"))
