"""Work lists, links and redirects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.keys import canonical_url, pair_key, row_key
from corpusloom.operators.filters import last_row
from corpusloom.operators.joins import hot_keys, spread_join
from corpusloom.session import cut
from corpusloom.sources.state import store


def keyed_urls(urls: DataFrame) -> DataFrame:
    """(key, url), one row per URL."""
    return urls.select("url").dropDuplicates().select(row_key("url").alias("key"), "url")


def resolve_redirects(rows: DataFrame, redirects: DataFrame, url: str = "url", target: str = "target") -> DataFrame:
    """Adds `target`: where the URL redirects to, one hop, or the URL itself, without query and fragment."""
    hops = redirects.groupBy(F.col("url").alias(url)).agg(F.min("target").alias("_hop"))
    hopped = spread_join(rows, hops, url, "left")
    return hopped.withColumn(target, canonical_url(F.coalesce(F.col("_hop"), F.col(url)))).drop("_hop")


def link_edges(links: DataFrame) -> DataFrame:
    """(key, fromurl, tourl), one row per pair."""
    pairs = links.select("fromurl", "tourl").dropDuplicates()
    return pairs.select(pair_key("fromurl", "tourl").alias("key"), "fromurl", "tourl")


def remaining(todo: DataFrame, processed: DataFrame, key: str = "key") -> DataFrame:
    """Work list without what is processed: stored pages, empty pages and sources of redirects."""
    return todo.join(processed.select(key), key, "left_anti")


def settle_links(links: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits edges into (done, open). `stored(url, target)` lists the URLs whose page has content.

    A done edge is keyed by its source and the target after the redirect, and shows the URL as it was linked.
    """
    known = stored.select(F.col("url").alias("tourl"), "target").dropDuplicates(["tourl"])
    # Links are read twice by the join, and its result once for each side of the split.
    met = cut(spread_join(cut(links), known, "tourl", "left"))
    done = met.filter(F.col("target").isNotNull()).select(
        pair_key("fromurl", "target").alias("key"), "fromurl", "tourl"
    )
    # Two URLs of a page that lead to one target share a key.
    return last_row(done, "key", "tourl"), met.filter(F.col("target").isNull()).select("key", "fromurl", "tourl")


def next_frontier(links: DataFrame, processed: DataFrame) -> DataFrame:
    """(key, url): targets of links that are not processed yet. One hop."""
    targets = links.select(F.col("tourl").alias("url")).distinct()
    done = processed.select("url").distinct()
    return targets.join(done, "url", "left_anti").select(row_key("url").alias("key"), "url")


def stored_edges(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct links in buckets by their source, written once for all hops, and the list of hot sources.

    The links of a hot source lie in slices, each with its own bucket, so that no bucket follows the links of one page.
    """
    edges = cut(links.select("fromurl", "tourl").filter("fromurl is not null and tourl is not null").dropDuplicates())
    hot = cut(hot_keys(edges.groupBy("fromurl").agg(F.count("*").alias("n")), "fromurl"))
    sliced = edges.join(F.broadcast(hot), "fromurl", "left")
    part = F.coalesce(F.pmod(F.xxhash64("tourl"), F.col("_slices")).cast("int"), F.lit(0))
    return store(sliced.select(_slot("fromurl", part).alias("slot"), "tourl"), "slot"), hot


def _slot(url: str, part: Column) -> Column:
    """Where the links of one slice of a source lie."""
    return F.concat_ws(" ", part.cast("string"), F.col(url))


def hop_targets(edges: DataFrame, hot: DataFrame, last: DataFrame) -> DataFrame:
    """(url): what the URLs of `last` link to. Only `last` is dealt out to the buckets; the links stay where they are."""
    sliced = last.select(F.col("url").alias("fromurl")).join(F.broadcast(hot), "fromurl", "left")
    parts = F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)
    slots = sliced.select("fromurl", F.explode(parts).alias("_part")).select(_slot("fromurl", F.col("_part")).alias("slot"))
    return edges.join(slots, "slot", "left_semi").select(F.col("tourl").alias("url")).distinct()


def reachable(seeds: DataFrame, links: DataFrame, hops: int) -> DataFrame:
    """(url, hop): URLs within `hops` link steps of the seeds and the step they were first met at.

    A hop writes nothing but the URLs that are new, in buckets by URL. What earlier hops wrote is never written or
    shuffled again: the targets of a hop are dealt out to those buckets once and leave out what they find there. A hop
    without new URLs is the last one. Rows without a URL are left out.
    """
    edges, hot = stored_edges(links)
    met = [store(seeds.select("url").filter("url is not null").distinct(), "url")]
    while len(met) <= hops:
        fresh = hop_targets(edges, hot, met[-1])
        for earlier in met:
            fresh = fresh.join(earlier, "url", "left_anti")
        fresh = store(fresh, "url")
        if fresh.isEmpty():
            break
        met.append(fresh)
    numbered = [urls.select("url", F.lit(hop).alias("hop")) for hop, urls in enumerate(met)]
    return reduce(DataFrame.unionByName, numbered)
