"""URL filters (operator 5): hash-prefix lookup of host-suffix and path-prefix expressions.

A rule is a host and a path, written ``host/path``. It fits a URL of that host
or a subdomain of it whose path starts with the rule's path; the longest
fitting rule wins, and of equal ones ``block`` wins over ``allow``. A URL is
expanded into one expression for each of its host suffixes and each path length
that occurs among the rules. Rules are grouped by the first four bytes of their
SHA-256. An expression meets the rules of its prefix, and these alone are confirmed
by whole digest, expression and host. Everything is built from DataFrame functions.

The prefix table has one row per prefix with its rules and is broadcast where its
checked size allows. The join has the prefix as its one key.

Defined cases: a null URL or one without ``://`` has an empty host and path and
fits no rule; a URL that fits no rule gets the default verdict; a rule with a
null field is ignored; no rules or no URLs are allowed; every input row gives one
result row, repeated ids included. Host letters A-Z are lower-cased, paths are
compared as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm.common import fresh_name
from tickwise.operators.joins import sized_broadcast

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT_VERDICT = "allow"
PREFIX_DIGITS = 8  # hexadecimal digits of four bytes
RULES_SCHEMA = "host string, path string, verdict string"


def rules_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules given as (``host/path``, verdict) as a table of host, path, verdict."""
    if not rules:
        return spark.range(0).selectExpr("'' AS host", "'' AS path", "'' AS verdict")
    rows = F.array(*(F.struct(F.lit(r.partition("/")[0]).alias("host"),
                              F.lit("/" + r.partition("/")[2]).alias("path"),
                              F.lit(v).alias("verdict")) for r, v in rules))
    return spark.range(1).select(F.inline(rows))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path of a URL; both empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def url_filter(pages: DataFrame, key: str, url: str, rules: DataFrame) -> DataFrame:
    """``key``, host, path, rule (null if none fits) and verdict of every row."""
    rules = (rules.select("host", "path", "verdict").dropna()
             .filter("verdict IN ('allow', 'block')")
             .groupBy(F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"))
             .agg(F.max("verdict").alias("r_verdict")))  # block over allow
    rules = (rules.withColumn("rule", F.concat("r_host", "r_path"))
             .withColumn("digest", F.sha2("rule", 256)))
    # path lengths that occur among the rules: no more than the longest path has characters
    lengths = rules.agg(F.sort_array(F.collect_set(F.char_length("r_path")))).first()[0]

    host, path = host_and_path(F.col(url))
    rid = fresh_name("row_key", pages.columns)
    rows = (pages.select(F.col(key).alias("k"), F.monotonically_increasing_id().alias(rid),
                         host.alias("host"), path.alias("path")))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    found = (rows
             .withColumn("prefixes", F.transform(
                 F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"),
                          lambda n: n <= F.char_length("path")),
                 lambda n: F.col("path").substr(F.lit(1), n)))
             .withColumn("suffix", F.explode(suffixes))
             .withColumn("prefix", F.explode_outer("prefixes"))
             .withColumn("expression", F.concat("suffix", "prefix"))
             .withColumn("digest", F.sha2("expression", 256)))
    found = found.withColumn("prefix_key", F.substring("digest", 1, PREFIX_DIGITS))
    # the rules of a prefix stand in one row: as many as share four bytes of a digest
    buckets = rules.groupBy(F.substring("digest", 1, PREFIX_DIGITS).alias("prefix_key")).agg(
        F.collect_list(F.struct("digest", "rule", "r_host", "r_verdict")).alias("rules"))
    met = found.join(sized_broadcast(buckets), "prefix_key", "left")
    fits = F.filter("rules", lambda r: (r["digest"] == F.col("digest")) & (r["rule"] == F.col("expression"))
                    & (r["r_host"] == F.col("suffix")))
    own = F.array_max(F.transform(fits, lambda r: F.struct(
        F.char_length(r["rule"]).alias("n"), r["r_verdict"].alias("verdict"), r["rule"].alias("rule"))))
    return (met.select("*", own.alias("own")).groupBy(rid, "k", "host", "path").agg(F.max("own").alias("best"))
            .select(F.col("k").alias(key), "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict")))
