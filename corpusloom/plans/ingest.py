"""From web pages to stored text, terms, tags and links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.keys import row_key
from corpusloom.functions.text import join_ids, split_tags, weighted_text
from corpusloom.operators.filters import first_row
from corpusloom.operators.graph import keyed_urls, link_edges, resolve_redirects, settle_links
from corpusloom.operators.pages import PageRules, has_content, read_pages
from corpusloom.operators.segment import keep_terms, segment
from corpusloom.operators.tags import tag_index
from corpusloom.operators.upserts import assign_ids, ids_of, union_by_key, upsert_count
from corpusloom.operators.weights import tokens
from corpusloom.sources.tables import Corpus


def page_tokens(read: DataFrame, lexicon: DataFrame | None, method: str = "longest") -> DataFrame:
    """(key, pos, term, termtype) of pages (key, text): words of a lexicon that carry meaning, or runs of letters."""
    if lexicon is not None:
        return keep_terms(segment(read, lexicon, method, "key", "text"))
    return tokens(read, "key", "text").withColumn("termtype", F.lit(None).cast("string"))


def collected_ids(rows: DataFrame, id_name: str, name: str) -> DataFrame:
    """(key, name): the ids of one page in order as text. One group is one page."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", id_name)))
    return rows.groupBy("key").agg(join_ids(F.transform(ordered, lambda r: r[id_name])).alias(name))


def ingest(
    corpus: Corpus,
    pages: DataFrame,
    rules: PageRules,
    redirects: DataFrame | None = None,
    lexicon: DataFrame | None = None,
    method: str = "longest",
) -> None:
    """Reads the pages (url, html) that are on the work list or linked from a stored page.

    A page counts once: one that is stored already changes neither counters nor its row. `redirects(url, target)`
    tells where URLs lead to; of several URLs of one target the first is read.
    """
    todo, links, stored = corpus.read("todo"), corpus.read("links"), corpus.read("done")
    work = todo.select("url").unionByName(links.select(F.col("tourl").alias("url"))).distinct()
    if redirects is None:
        redirects = corpus.spark.createDataFrame([], "url string, target string")
    # Redirects are looked up for bare URLs, so the pages themselves are moved for one join only.
    found = pages.join(resolve_redirects(work, redirects), "url")
    read = read_pages(found, rules, ["url", "target", "html"]).withColumn("key", row_key("target"))
    # Everything below starts from this table, so pages are parsed once.
    read = corpus.write("parsed", read)

    fresh = first_row(
        has_content(read).join(stored.select("key"), "key", "left_anti").select("key", "url", "target"), "key", "url"
    )
    # By key alone, as all later joins of pages are, so that they find the pages in place.
    new = read.join(fresh.select("key", F.col("url").alias("_first")), "key").filter("url = _first").drop("_first")
    # A page delivered more than once is one page: of its snapshots with content the first by HTML.
    new = first_row(has_content(new), "key", "html")
    new = new.withColumn("text", weighted_text(title="title", tags="tags", keyword="keyword", content="content"))

    tagged = new.select("key", "target", F.posexplode(split_tags("tags")).alias("pos", "tag"))
    place = F.struct("key", "pos").alias("_place")
    tags = corpus.write("tags", upsert_count(
        corpus.read("tags"), tagged.select("tag", place), "tag", "_place", None, "tagcount", "tagid"
    ))
    # Cut words are the costly part; they are counted, numbered and put back in order from here.
    words = corpus.write("page_terms", page_tokens(new.select("key", "text"), lexicon, method))
    kind = dict(words.dtypes)["pos"]
    tag_terms = tagged.select("key", F.lit(None).cast(kind).alias("pos"), F.col("tag").alias("term"), F.lit(None).cast("string").alias("termtype"))
    seen = words.unionByName(tag_terms).select("term", "termtype", place)
    terms = corpus.write("terms", upsert_count(
        corpus.read("terms"), seen, "term", "_place", ["termtype"], "termfreq", "termid"
    ))

    tag_ids = ids_of(tagged, tags, "tag", "tagid")
    corpus.write("tag_index", tag_index(tag_ids.withColumnRenamed("target", "url"), "tagid", "url"))
    rows = (
        new.join(collected_ids(tag_ids, "tagid", "tagids"), "key", "left")
        .join(collected_ids(ids_of(words, terms, "term", "termid"), "termid", "termids"), "key", "left")
        .select(
            "key", F.col("target").alias("url"), F.lit("").alias("redirect_url"), F.lit("utf-8").alias("charset"), "html",
            F.col("text").alias("content"), "tags", "title", "keyword",
            F.coalesce("tagids", F.lit("")).alias("tagids"), F.coalesce("termids", F.lit("")).alias("termids"),
        )
    )
    last = stored.select("key", "urlid")
    numbers = assign_ids(last, fresh.select("key"), "key", "urlid").join(fresh.select("key"), "key", "left_semi")
    corpus.write("done", rows.join(numbers, "key"))

    hrefs = has_content(read).select(F.col("target").alias("fromurl"), F.explode("hrefs").alias("tourl"))
    edges = union_by_key(links, link_edges(hrefs), "key")
    reached = has_content(read).select("url", "target").unionByName(stored.select("url", F.col("url").alias("target")))
    settled, still_open = settle_links(edges, reached)
    corpus.write("links_done", settled.join(corpus.read("links_done").select("key"), "key", "left_anti"))
    corpus.write("links", still_open)

    seen_urls = read.select("url").unionByName(read.select(F.col("target").alias("url"))).unionByName(stored.select("url"))
    targets = keyed_urls(hrefs.select(F.col("tourl").alias("url")))
    due = union_by_key(todo, targets, "key")
    corpus.write("todo", due.join(seen_urls.select(row_key("url").alias("key")).distinct(), "key", "left_anti"))
    corpus.finish()
