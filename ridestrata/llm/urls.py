"""URL rules by hash prefixes, in DataFrame operations only.

A rule is a host and a path prefix. A url is expanded into the suffixes of its host,
label by label, times the prefixes of its path that are as long as some rule's path.
Expressions and rules meet in an equi-join on the first bytes of their digests;
whole digests confirm, and of the rules that fit the longest wins, a block before an
allow."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridestrata.operators.stored import lookup_join, store

PREFIX = 8  #: hexadecimal digits of a digest on which url and rule meet


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path after the first ``://``, both empty without one."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.encode(F.concat(host, F.lit("\n"), path), "utf-8"), 256)


def _rules_by_prefix(rules: DataFrame) -> DataFrame:
    """One row per digest prefix with its rules; equal rules count once and a block
    hides an allow of the same host and path."""
    known = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IN ('allow', 'block')")
    one = known.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    digest = _digest(F.col("host"), F.col("path"))
    rule = F.struct(
        digest.alias("digest"),
        (F.length("host") + F.length("path")).alias("size"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    return one.groupBy(F.substring(digest, 1, PREFIX).alias("prefix")).agg(F.collect_list(rule).alias("rules"))


def judged(pages: DataFrame, rules: DataFrame, otherwise: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages`` (page_id, url).

    ``rules`` has (host, path, verdict allow or block): a rule fits its host and all
    hosts below it, if the path starts with its path; the longest that fits wins, and
    ``otherwise`` is the verdict without one. Null urls and urls without ``://`` have
    empty host and path and no rule. Repeated rows come back repeated, an empty table
    gives no rows; rules with a null are left out, other columns are not read."""
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    addresses = split.select("host", "path").distinct()
    known = store(_rules_by_prefix(rules), "rules")
    sizes = rules.select(F.length("path").alias("n")).where("n IS NOT NULL").distinct()
    sizes = store(sizes.agg(F.sort_array(F.collect_set("n")).alias("sizes")), "sizes")
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    expanded = (
        addresses.withColumn("sizes", sizes.scalar())
        .withColumn("n", F.explode("sizes"))
        .where(F.col("n") <= F.length("path"))
        .withColumn("suffix", F.explode(suffixes))
        .select("host", "path", _digest(F.col("suffix"), F.expr("substring(path, 1, n)")).alias("digest"))
        .withColumn("prefix", F.substring("digest", 1, PREFIX))
    )
    met = lookup_join(expanded, known, ["prefix"], "inner")
    confirmed = met.select("host", "path", "digest", F.explode("rules").alias("r")).where("r.digest = digest")
    order = F.struct(F.col("r.size"), F.col("r.verdict"), F.col("r.rule"))
    best = confirmed.groupBy("host", "path").agg(F.max(order).alias("best"))
    winners = store(best.select("host", "path", "best.rule", "best.verdict"), "winners")
    return lookup_join(split, winners, ["host", "path"]).select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict")
    )


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, verdict)."""
    rows = [
        F.struct(F.lit(host).alias("host"), F.lit(path).alias("path"), F.lit(verdict).alias("verdict"))
        for host, path, verdict in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))
