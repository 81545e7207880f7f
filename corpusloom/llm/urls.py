"""URL filters: host-suffix and path-prefix expressions looked up by short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import ascii_lower, guarded

#: Rules are copied to the executors only up to this many; a larger list is joined by shuffle.
COPIED_RULES = 50_000
#: Hexadecimal digits of the short hash prefix (4 bytes).
PREFIX_DIGITS = 8

OUTPUTS = ["url_host", "url_path", "url_rule", "url_verdict"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without `://` or without a URL."""
    start = F.instr(url, "://")
    after = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def url_rules(rules: DataFrame) -> DataFrame:
    """The usable rules of (host, path, verdict), each with its expression, hash prefix and full digest.

    Hosts are lower-cased (A-Z), a null path is empty. Rules without a host or verdict fit nothing and are left out.
    Of several verdicts for one (host, path) `block` wins.
    """
    host = ascii_lower(F.col("host"))
    known = rules.select(host.alias("_rule_host"), F.coalesce("path", F.lit("")).alias("_rule_path"), F.col("verdict").alias("_verdict"))
    known = known.filter((F.col("_rule_host") != "") & F.col("_verdict").isNotNull())
    known = known.groupBy("_rule_host", "_rule_path").agg(F.max("_verdict").alias("_verdict"))
    expression = F.concat("_rule_host", "_rule_path")
    return known.select(
        "_rule_host", "_rule_path", "_verdict", expression.alias("_rule"), F.sha2(expression, 256).alias("_digest"),
        F.substring(F.sha2(expression, 256), 1, PREFIX_DIGITS).alias("_prefix"),
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", copied: int = COPIED_RULES) -> DataFrame:
    """All rows and columns of `pages` with url_host, url_path, url_rule and url_verdict.

    A rule fits its host and all subdomains when the path starts with the rule's; the longest host + path wins (of equal
    lengths the longer host). Each different (host, path) is expanded once into host suffixes times path prefixes, of
    the label counts and path lengths that rules have (two short lists, bounded by the longest host and path of a rule),
    and meets the rules by the first four bytes of the SHA-256; the whole digest then decides. A null or odd URL has
    empty parts and gets the default; without rules all get it. Repeated rows stay.
    """
    return guarded(pages, OUTPUTS, lambda rows, name: _judge_urls(rows, rules, name("url"), default, copied))


def _judge_urls(pages: DataFrame, rules: DataFrame, url: str, default: str, copied: int) -> DataFrame:
    host, path = host_and_path(F.col(url))
    parted = pages.withColumn("url_host", host).withColumn("url_path", path)
    known = url_rules(rules)
    lengths = known.agg(
        F.sort_array(F.collect_set(F.size(F.split("_rule_host", "\\.")))).alias("labels"),
        F.sort_array(F.collect_set(F.length("_rule_path"))).alias("paths"),
        F.count("*").alias("n"),
    ).first()
    if not lengths["n"]:
        return parted.withColumn("url_rule", F.lit(None).cast("string")).withColumn("url_verdict", F.lit(default))
    places = parted.select("url_host", "url_path").filter("url_host != ''").distinct()
    labels = F.split("url_host", "\\.")
    suffixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths["labels"]]), lambda n: n <= F.size(labels)),
        lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths["paths"]]), lambda n: n <= F.length("url_path")),
        lambda n: F.substring(F.col("url_path"), F.lit(1), n),
    )
    expressions = (
        places.withColumn("_suffix", F.explode(suffixes)).withColumn("_start", F.explode(prefixes))
        .withColumn("_digest", F.sha2(F.concat("_suffix", "_start"), 256))
        .withColumn("_prefix", F.substring("_digest", 1, PREFIX_DIGITS))
    )
    side = F.broadcast(known) if lengths["n"] <= copied else known
    met = expressions.join(side.withColumnRenamed("_digest", "_rule_digest"), "_prefix").filter(F.col("_digest") == F.col("_rule_digest"))
    best = met.groupBy("url_host", "url_path").agg(
        F.max(F.struct(F.length("_rule").alias("n"), F.length("_rule_host").alias("h"), F.col("_rule").alias("r"), F.col("_verdict").alias("v"))).alias("_best")
    )
    return (
        parted.join(best, ["url_host", "url_path"], "left")
        .withColumn("url_rule", F.col("_best.r")).withColumn("url_verdict", F.coalesce("_best.v", F.lit(default))).drop("_best")
        .select(*parted.columns, "url_rule", "url_verdict")
    )
