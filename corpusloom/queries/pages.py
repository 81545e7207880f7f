"""Text, titles and links of `pages`, and the link graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.html import BLOCK_TAGS, ENTITIES
from corpusloom.functions.keys import canonical_url, ids_in_url, pad_bytes, pair_key, row_key
from corpusloom.functions.text import weighted_text, weighted_words
from corpusloom.operators import graph, weights as w
from corpusloom.operators.joins import spread_join
from corpusloom.operators.pages import PageRules, has_content, read_pages
from corpusloom.operators.upserts import union_by_key
from corpusloom.queries.terms import documents
from corpusloom.session import cut
from corpusloom.sources.seeds import seed_urls as seeds_of
from corpusloom.sources.tables import dealt, read_table

# The pages keep their text in <article> and link within the site.
RULES = PageRules(content=["article"], link_prefixes=["/"])


def raw(spark, folder, *columns: str) -> DataFrame:
    pages = read_table(spark, folder, "pages", list(columns))
    return dealt(pages) if "html" in columns else pages


def parsed(spark, folder) -> DataFrame:
    return read_pages(raw(spark, folder, "page_id", "url", "html"), RULES)


def page_text(spark, folder):
    return parsed(spark, folder).select("page_id", "content")


def page_title(spark, folder):
    return parsed(spark, folder).select("page_id", "title", "tags", "keyword")


def page_links(spark, folder):
    return parsed(spark, folder).select("page_id", F.posexplode("hrefs").alias("pos", "href"))


def page_urls(spark, folder):
    """Canonical URLs with the number in their path."""
    found = raw(spark, folder, "page_id", "url").withColumn("canonical", canonical_url("url"))
    number = ids_in_url("canonical", r"/([0-9]+)(?:\.html)?/?$", "number")["number"]
    return found.select("page_id", "canonical", number.alias("number"))


def redirect_targets(spark, folder):
    """Addresses that end in `.html` lead to the ones without, as a redirect table has it."""
    pages = raw(spark, folder, "page_id", "url").withColumn("url", canonical_url("url"))
    moved = pages.filter(F.col("url").endswith(".html"))
    target = F.concat(F.regexp_replace("url", r"\.html$", ""), F.lit("?moved=1#top"))
    return graph.resolve_redirects(pages, moved.select("url", target.alias("target"))).select("page_id", "url", "target")


def site(spark, folder) -> DataFrame:
    """(page_id, url, content, hrefs): all pages with an address, under their own canonical one; links start from one base."""
    read = read_pages(raw(spark, folder, "page_id", "url", "html").filter("url is not null"), RULES, ["page_id", "url"])
    return read.select("page_id", canonical_url("url").alias("url"), "content", F.transform("hrefs", lambda href: F.concat(F.lit("http://ex"), href)).alias("hrefs"))


def addresses(pages: DataFrame) -> DataFrame:
    """(url, target): the address that a page links to first leads to that page, to the smallest one where several share it."""
    own = pages.filter(F.size("hrefs") > 0).select(F.get("hrefs", F.lit(0)).alias("url"), F.struct("page_id", "url").alias("page"))
    return own.groupBy("url").agg(F.min("page").alias("page")).select("url", F.col("page.url").alias("target"))


def edges_of(pages: DataFrame) -> DataFrame:
    return graph.link_edges(has_content(pages).select(F.col("url").alias("fromurl"), F.explode("hrefs").alias("tourl")))


def read_urls(pages: DataFrame) -> DataFrame:
    """URLs of pages that were read, by their own and by their linked address."""
    return pages.select("url").unionByName(addresses(pages).select("url"))


def link_edges(spark, folder):
    return edges_of(site(spark, folder))


def _settled(spark, folder):
    # Pages are parsed once and then read twice, as sources and as targets.
    pages = cut(has_content(site(spark, folder)))
    return graph.settle_links(edges_of(pages), addresses(pages))


def links_done(spark, folder):
    return _settled(spark, folder)[0]


def links_open(spark, folder):
    return _settled(spark, folder)[1]


def frontier_next(spark, folder):
    pages = cut(site(spark, folder))
    return graph.next_frontier(edges_of(pages), read_urls(pages))


def todo_remaining(spark, folder):
    """Work list of all addresses and link targets without those of pages that were read, empty ones included."""
    pages = cut(site(spark, folder))
    linked = graph.keyed_urls(edges_of(pages).select(F.col("tourl").alias("url")))
    todo = union_by_key(graph.keyed_urls(pages), linked, "key")
    return graph.remaining(todo, graph.keyed_urls(read_urls(pages)))


def reachable_pages(spark, folder):
    """What two link steps reach from the page with the smallest address that has content."""
    pages = cut(has_content(site(spark, folder)))
    start = pages.filter(F.col("url") == pages.agg(F.min("url")).scalar())
    led = spread_join(edges_of(pages), addresses(pages).withColumnRenamed("url", "tourl"), "tourl", "left")
    edges = led.select("fromurl", F.coalesce("target", "tourl").alias("tourl"))
    return graph.reachable(start, edges, 2)


def weighted_page_terms(spark, folder):
    terms = weighted_words(title="title", tags="tags", keyword="keyword", content="content")
    return w.term_freq(parsed(spark, folder), "page_id", terms)


def page_stored_text(spark, folder):
    text = weighted_text(title="title", tags="tags", keyword="keyword", content="content")
    return parsed(spark, folder).select("page_id", text.alias("text"))


def seed_urls(spark, folder):
    customers = read_table(spark, folder, "customer", ["c_custkey"])
    return seeds_of(customers, "http://ex.org/view/{n}.htm", "c_custkey")


def md5_keys(spark, folder):
    orders = read_table(spark, folder, "orders", ["o_orderkey", "o_custkey"])
    return orders.select("o_orderkey", row_key("o_orderkey").alias("key"), pair_key("o_custkey", "o_orderkey").alias("pair"))


def padded_terms(spark, folder):
    terms = w.doc_freq(documents(spark, folder))
    return terms.select("term", pad_bytes("term", 12, "*", True).alias("left_pad"), pad_bytes("term", 12, "*", False).alias("right_pad"))


def _decode(text: str) -> str:
    for name, character in ENTITIES.items():
        quoted = character.replace("'", "''")
        text = f"replace({text}, '&{name};', '{quoted}')"
    return text


def _text(html: str) -> str:
    text = rf"regexp_replace({html}, '<!--.*?-->', '', 'gs')"
    text = rf"regexp_replace({text}, '</?(?:{'|'.join(BLOCK_TAGS)})(?:[\s/][^>]*)?>', ' ', 'gi')"
    text = rf"regexp_replace({text}, '<[a-zA-Z/!?][^>]*>', '', 'g')"
    return rf"trim(regexp_replace({_decode(text)}, '\s+', ' ', 'g'))"


CLEAN = r"""clean AS (SELECT page_id, url, html, regexp_replace(regexp_replace(regexp_replace(html,
    '<\s*script[^>]*>.*?<\s*/\s*script\s*>', '', 'gis'), '<\s*style[^>]*>.*?<\s*/\s*style\s*>', '', 'gis'),
    '<(?:script|style)[\s/>].*', '', 'is') AS h FROM pages)"""
READ = f"""{CLEAN}, read AS (SELECT page_id, html,
    {_text("regexp_extract(h, '<article>(.*?)</article>', 1, 's')")} AS content,
    {_text("regexp_extract(h, '<title>(.*?)</title>', 1, 's')")} AS title,
    regexp_extract_all(h, '<a href="([^"]*)"', 1) AS hrefs FROM clean),
    hrefs AS (SELECT page_id, pos, regexp_replace(hrefs[pos + 1], '[?#].*$', '', 's') AS href
    FROM (SELECT page_id, hrefs, unnest(range(len(hrefs))) AS pos FROM read WHERE content <> ''))"""
SITE = f"""{READ}, site AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url FROM pages WHERE url IS NOT NULL),
    addresses AS (SELECT 'http://ex' || href AS url, arg_min(site.url, page_id) AS target FROM hrefs JOIN site USING (page_id) WHERE pos = 0 GROUP BY 1),
    known AS (SELECT url FROM site UNION SELECT url FROM addresses),
    edges AS (SELECT DISTINCT md5(url) || '-' || md5('http://ex' || href) AS key, url AS fromurl, 'http://ex' || href AS tourl
    FROM site JOIN hrefs USING (page_id))"""
WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}]+')"

QUERIES = {
    "page_text": (page_text, f"WITH {READ} SELECT page_id, content FROM read"),
    "page_title": (page_title, f"""WITH {READ} SELECT page_id, CASE WHEN content <> '' THEN title ELSE '' END AS title,
        '' AS tags, '' AS keyword FROM read"""),
    "page_links": (page_links, f"WITH {READ} SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM hrefs"),
    "page_urls": (page_urls, r"""SELECT page_id, canonical,
        TRY_CAST(regexp_extract(canonical, '/([0-9]+)(?:\.html)?/?$', 1) AS INTEGER) AS number
        FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS canonical FROM pages)"""),
    "redirect_targets": (redirect_targets, r"""SELECT page_id, url, regexp_replace(url, '\.html$', '') AS target
        FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url FROM pages)"""),
    "link_edges": (link_edges, f"WITH {SITE} SELECT key, fromurl, tourl FROM edges"),
    "links_done": (links_done, f"""WITH {SITE} SELECT md5(fromurl) || '-' || md5(target) AS key, fromurl, max(tourl) AS tourl
        FROM edges JOIN addresses ON tourl = url GROUP BY fromurl, target"""),
    "links_open": (links_open, f"WITH {SITE} SELECT key, fromurl, tourl FROM edges WHERE tourl NOT IN (SELECT url FROM addresses)"),
    "frontier_next": (frontier_next, f"""WITH {SITE} SELECT DISTINCT md5(tourl) AS key, tourl AS url FROM edges
        WHERE tourl NOT IN (SELECT url FROM known)"""),
    "todo_remaining": (todo_remaining, f"""WITH {SITE} SELECT md5(url) AS key, url FROM (
        SELECT tourl AS url FROM edges UNION SELECT url FROM site) WHERE url NOT IN (SELECT url FROM known)"""),
    "reachable_pages": (reachable_pages, f"""WITH {SITE}, led AS (SELECT DISTINCT fromurl, coalesce(target, tourl) AS tourl FROM edges LEFT JOIN addresses ON tourl = url),
        h0 AS (SELECT min(site.url) AS url FROM site JOIN read USING (page_id) WHERE content <> ''),
        h1 AS (SELECT DISTINCT tourl AS url FROM led JOIN h0 ON fromurl = url WHERE tourl NOT IN (SELECT url FROM h0)),
        h2 AS (SELECT DISTINCT tourl AS url FROM led JOIN h1 ON fromurl = url
            WHERE tourl NOT IN (SELECT url FROM h0 UNION ALL SELECT url FROM h1))
        SELECT url, CAST(0 AS INTEGER) AS hop FROM h0 UNION ALL SELECT url, 1 FROM h1 UNION ALL SELECT url, 2 FROM h2"""),
    "weighted_page_terms": (weighted_page_terms, f"""WITH {READ} SELECT page_id, term, CAST(sum(n) AS BIGINT) AS tf FROM (
        SELECT page_id, unnest({WORDS.format('title')}) AS term, 4 AS n FROM read WHERE content <> ''
        UNION ALL SELECT page_id, unnest({WORDS.format('content')}), 1 FROM read) GROUP BY 1, 2"""),
    "page_stored_text": (page_stored_text, f"""WITH {READ} SELECT page_id,
        repeat((CASE WHEN content <> '' THEN title ELSE '' END) || ' ', 4) || repeat(' ', 5) || content AS text FROM read"""),
    "seed_urls": (seed_urls, """SELECT md5(url) AS key, url FROM (
        SELECT 'http://ex.org/view/' || c_custkey || '.htm' AS url FROM customer)"""),
    "md5_keys": (md5_keys, """SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS key,
        md5(CAST(o_custkey AS VARCHAR)) || '-' || md5(CAST(o_orderkey AS VARCHAR)) AS pair FROM orders"""),
    "padded_terms": (padded_terms, rf"""SELECT term, repeat('*', greatest(12 - strlen(term), 0)) || term AS left_pad,
        term || repeat('*', greatest(12 - strlen(term), 0)) AS right_pad
        FROM (SELECT DISTINCT unnest({WORDS.format('text')}) AS term FROM documents)"""),
}
