"""Dictionaries, lexicon terms and segmentation, from the sources and words of `documents` and from `part`."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.text import map_characters
from corpusloom.operators import dictpages, filters, ids, lexicon, rankindex, segment, weights as w
from corpusloom.operators.upserts import delete_prefix, insert_absent
from corpusloom.plans.lexicon import dict_rows, term_rows
from corpusloom.queries.terms import TOKENS, documents
from corpusloom.session import cut
from corpusloom.sources.seeds import seed_urls
from corpusloom.sources.tables import SCHEMAS, read_table

# Stand-ins for the silenced subjects, the deleted prefix and the class letters of the fixture's invented words.
SILENCED = ["es"]
DELETED = "la"
ACCENTS = {"é": "e", "è": "e", "ê": "e", "ç": "c", "ä": "a", "ö": "o", "ü": "u", "ñ": "n", "ó": "o", "á": "a"}
STEM_LETTERS = 5


def source_id(column="source"):
    return F.regexp_extract(column, r"^src(\d+)$", 1).cast("bigint")


def dicts(spark, folder) -> DataFrame:
    """A dictionary per source: its most common language as category, its documents as count."""
    per_lang = documents(spark, folder, "source", "lang").groupBy("source", "lang").agg(F.count("*").alias("n"))
    order = F.struct(-F.col("n"), "lang")
    return per_lang.groupBy("source").agg(F.min_by("lang", order).alias("category"), F.sum("n").alias("count")).select(
        source_id().alias("dicid"), F.col("source").alias("name"), "category", "count"
    )


def files(spark, folder, separator=" ") -> DataFrame:
    """A dictionary text per document, one word a line."""
    return documents(spark, folder, "source", "text").select(
        source_id().alias("dicid"), F.replace("text", F.lit(separator), F.lit("\n")).alias("text")
    )


def terms(spark, folder) -> DataFrame:
    """The dictionary terms, with ids and counts, without those of the deleted prefix."""
    empty = spark.createDataFrame([], SCHEMAS["dict_terms"])
    return cut(delete_prefix(term_rows(empty, files(spark, folder)), "term", DELETED))


def active(spark, folder) -> DataFrame:
    return lexicon.active_terms(terms(spark, folder), silenced_dicts(spark, folder))


def dict_table(spark, folder):
    return dicts(spark, folder)


def silenced_dicts(spark, folder):
    return lexicon.silence_categories(dicts(spark, folder), SILENCED)


def lexicon_lines(spark, folder):
    """Dictionary texts by line: how often each line occurs per dictionary."""
    docs = documents(spark, folder, "source", "text").select(source_id().alias("dicid"), "text")
    return lexicon.dict_lines(docs).groupBy("dicid", "term").agg(F.count("*").alias("n"))


def lexicon_clean(spark, folder):
    return lexicon.clean_terms(lexicon.dict_lines(files(spark, folder))).groupBy("dicid", "term").agg(F.count("*").alias("n"))


def lexicon_rejects(spark, folder):
    rejected = lexicon.rejected_terms(lexicon.dict_lines(files(spark, folder, "\u0001")))
    return rejected.groupBy("dicid", "reason").agg(F.count("*").alias("n"))


def lexicon_terms(spark, folder):
    return terms(spark, folder)


def lexicon_active(spark, folder):
    return active(spark, folder)


def lexicon_page(spark, folder):
    return rankindex.build(active(spark, folder), "termid").page(3, 200)


def lexicon_page_after(spark, folder):
    return ids.page_after(active(spark, folder), "termid", 400, 200)


def lexicon_last(spark, folder):
    return lexicon.last_term(active(spark, folder))


def lexicon_max_id(spark, folder):
    return filters.max_id(active(spark, folder), "termid")


def _stems(spark, folder) -> DataFrame:
    """A lexicon of the corpus words of at most five letters, classed by their first letter."""
    counts = w.term_counts(documents(spark, folder)).filter(F.length("term") <= STEM_LETTERS)
    return cut(counts.select("term", F.substring("term", 1, 1).alias("termtype"), F.col("termfreq").alias("freq")))


def user_lexicon(spark, folder):
    """The stems and the active dictionary terms as user terms."""
    return lexicon.user_lexicon(_stems(spark, folder), active(spark, folder))


def segment_dict(spark, folder):
    """How often each word occurs when all runs of letters are cut into the longest stems."""
    return segment.word_counts(documents(spark, folder), _stems(spark, folder), unknown_class="?")


def segment_likeliest(spark, folder):
    """The same with the likeliest cuts."""
    return segment.word_counts(documents(spark, folder), _stems(spark, folder), "likeliest")


def pos_filter(spark, folder):
    """Tokens that carry meaning when a word's class is its first letter, unknown for long words."""
    tokens = w.tokens(documents(spark, folder))
    return segment.keep_terms(segment.with_classes(tokens, _stems(spark, folder)))


def simplify_chars(spark, folder):
    return documents(spark, folder).select("doc_id", map_characters("text", ACCENTS).alias("text"))


LIST_URL = "http://ex/dict/cate/index/{}/download/{}"
PER_PAGE = 10
# A pager shows the first and the last page of a brand and this many on either side of its own.
PAGER_REACH = 5


def list_pages(spark, folder) -> DataFrame:
    """(url, html): parts as dictionaries, listed ten a page by brand, each page with a pager."""
    parts = read_table(spark, folder, "part", ["p_partkey", "p_name", "p_brand", "p_size"])
    brand = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("bigint")
    # A page holds the parts of one brand whose keys fall into one range: at most ten of a page's text.
    placed = parts.select(
        "p_partkey", "p_name", "p_size", brand.alias("brand"), (F.expr("p_partkey div 100") + 1).alias("page")
    )
    block = F.concat(
        F.lit('<div class="dict_detail_block"><div class="detail_title"><a href="/dict/detail/index/'),
        F.col("p_partkey").cast("string"), F.lit('">'), F.col("p_name"), F.lit(" &amp; co</a></div>"),
        F.lit('<div class="show_content">x</div><div class="show_content">'),
        (F.col("p_size") * 100).cast("string"), F.lit("</div></div>"),
    )
    blocks = placed.groupBy("brand", "page").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", block.alias("b")))), lambda x: x["b"]), "").alias("blocks")
    )
    last = placed.groupBy("brand").agg(F.max("page").alias("last"))
    # Whatever the page, the greatest number of its pager is the brand's last page, and no page grows with its brand.
    own = F.greatest(F.lit(1), F.least(F.coalesce("page", F.lit(1)), "last"))
    near = F.sequence(F.greatest(F.lit(1), own - PAGER_REACH), F.greatest(F.lit(1), F.least(own + PAGER_REACH, "last")))
    numbers = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(1).cast("bigint"), "last"), near)))
    pager = F.array_join(
        F.transform(
            F.when(F.col("last").isNotNull(), numbers),
            lambda p: F.concat(F.lit('<a href="/dict/cate/index/0/download/'), p.cast("string"), F.lit('">'), p.cast("string"), F.lit("</a>")),
        ),
        "",
    )
    url = F.concat(F.lit("http://ex/dict/cate/index/"), F.col("brand").cast("string"), F.lit("/download/"), F.col("page").cast("string"))
    html = F.concat(
        F.lit("<html><head><title>brand"), F.col("brand").cast("string"), F.lit("_dicts</title></head><body>"), F.col("blocks"),
        F.lit('<div id="dict_page_list">'), pager, F.lit("</div></body></html>"),
    )
    return blocks.join(last, "brand").select(url.alias("url"), html.alias("html"))


def read_lists(spark, folder) -> DataFrame:
    return cut(dictpages.read_list_pages(list_pages(spark, folder)))


def dict_pages(spark, folder):
    """Dictionaries that the list pages show with a count above 2000."""
    read = dictpages.read_list_pages(list_pages(spark, folder))
    return read.select("category_id", "page", "category", F.explode("dicts").alias("d")).select(
        "category_id", "page", "category", "d.dicid", "d.name", "d.count"
    )


def pager_rows(spark, folder):
    return dictpages.pager_rows(dictpages.read_list_pages(list_pages(spark, folder)))


def dict_list(spark, folder):
    """The dictionary table after a listing of all brands."""
    return dict_rows(spark.createDataFrame([], SCHEMAS["dicts"]), dictpages.listed_dicts(read_lists(spark, folder)))


def dict_term_todo(spark, folder):
    """The texts to read after a listing; those of cheap dictionaries were on the list before."""
    listed = dictpages.listed_dicts(read_lists(spark, folder)).select("dicid", "count").distinct()
    urls = seed_urls(listed.select("dicid").distinct(), "http://ex/dict/text?id={n}", "dicid")
    before = seed_urls(listed.filter("count < 3000").select("dicid").distinct(), "http://ex/dict/text?id={n}", "dicid")
    return insert_absent(before, urls, "key")


DICTS = """dicts AS (SELECT CAST(substr(source, 4) AS BIGINT) AS dicid, source AS name, arg_min(lang, (-n, lang)) AS category,
    CAST(sum(n) AS BIGINT) AS "count" FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2) GROUP BY source)"""
SILENCED_DICTS = f"""{DICTS}, off AS (SELECT dicid, name, category,
    CASE WHEN category LIKE '%es%' THEN 0 ELSE "count" END AS "count" FROM dicts)"""
# One word a line: the text is cut at blanks and line ends, and each line is trimmed of white space.
LINES = r"""lines AS (SELECT CAST(substr(source, 4) AS BIGINT) AS dicid, regexp_replace(line, '^\s+|\s+$', '', 'g') AS term FROM (
    SELECT source, unnest(string_split(replace(text, ' ', chr(10)), chr(10))) AS line FROM documents))"""
CLEANED = f"""{LINES}, cleaned AS (SELECT dicid, CASE WHEN regexp_replace(term, '[a-z,A-Z]', '', 'g') <> ''
    THEN regexp_replace(term, '[a-z,A-Z]', '', 'g') ELSE term END AS term FROM lines),
    kept AS (SELECT * FROM cleaned WHERE term <> '' AND strlen(term) < 17)"""
TERMS = f"""{CLEANED}, terms AS (SELECT * FROM (SELECT row_number() OVER (ORDER BY substr(md5(term), 1, 3), term) AS termid,
    term, count(*) AS termfreq, max(dicid) AS dicid FROM kept GROUP BY term) WHERE term NOT LIKE 'la%')"""
ACTIVE = f"""{TERMS}, {SILENCED_DICTS}, active AS (SELECT * FROM terms WHERE dicid IN (SELECT dicid FROM off WHERE "count" > 0))"""
STEMS = f"""{TOKENS}, stems AS (SELECT term, substr(term, 1, 1) AS termtype, count(*) AS freq FROM tokens
    WHERE length(term) <= 5 GROUP BY term)"""
# Each distinct word is cut once: the longest stem at its start, then the rest.
CUT = """pieces AS (SELECT word, 0 AS start, (SELECT coalesce(max(n), 1) FROM (VALUES (1), (2), (3), (4), (5)) v(n)
        WHERE n <= length(word) AND substr(word, 1, n) IN (SELECT term FROM stems)) AS size FROM (SELECT DISTINCT term AS word FROM tokens)
    UNION ALL SELECT word, start + size, (SELECT coalesce(max(n), 1) FROM (VALUES (1), (2), (3), (4), (5)) v(n)
        WHERE n <= length(word) - start - size AND substr(word, start + size + 1, n) IN (SELECT term FROM stems))
    FROM pieces WHERE start + size < length(word))"""
# Each distinct word from its last letter back: the best logarithm of shares, in millionths, of what begins at each place,
# and the size of its first stem; then the sizes are followed from the first letter on.
LIKELIEST = """whole AS (SELECT sum(freq) + 1.0 AS total FROM stems), every AS (SELECT DISTINCT term AS word FROM tokens),
    choices AS (SELECT word, start, n, CAST(round(ln((CASE WHEN freq > 0 THEN freq ELSE 0.5 END) / (SELECT total FROM whole)) * 1000000) AS BIGINT) AS w
        FROM (SELECT word, unnest(range(length(word))) AS start FROM every), (VALUES (1), (2), (3), (4), (5)) v(n)
        LEFT JOIN stems ON term = substr(word, start + 1, n) WHERE start + n <= length(word) AND (n = 1 OR term IS NOT NULL)),
    steps AS (SELECT word, start, {'best': []::BIGINT[], 'sizes': []::BIGINT[], 'next': list({'s': w, 'n': n::BIGINT})} AS step FROM choices GROUP BY word, start),
    walks AS (SELECT word, list(step ORDER BY start DESC) AS steps FROM steps GROUP BY word),
    chosen AS (SELECT word, list_reduce(steps, lambda done, step: list_transform(
            [list_max(list_transform(step.next, lambda c: {'s': c.s + done.best[c.n], 'n': c.n}))],
            lambda b: {'best': list_prepend(b.s, done.best), 'sizes': list_prepend(b.n, done.sizes), 'next': step.next})[1],
        {'best': [0::BIGINT], 'sizes': []::BIGINT[], 'next': [{'s': 0::BIGINT, 'n': 0::BIGINT}]}).sizes AS sizes FROM walks),
    pieces AS (SELECT word, sizes, 0::BIGINT AS start, sizes[1] AS size FROM chosen
        UNION ALL SELECT word, sizes, start + size, sizes[start + size + 1] FROM pieces WHERE start + size < len(sizes))"""
PARTS = """listed AS (SELECT CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT) AS brand, p_partkey // 100 + 1 AS page,
    p_partkey AS dicid, p_name || ' & co' AS name, CAST(p_size * 100 AS BIGINT) AS "count" FROM part),
    firsts AS (SELECT brand, CASE WHEN max("count") > 2000 THEN 'brand' || brand ELSE '' END AS category FROM listed
        WHERE page = 1 GROUP BY brand),
    shown AS (SELECT listed.*, firsts.category FROM listed JOIN firsts USING (brand) WHERE "count" > 2000)"""

QUERIES = {
    "dict_table": (dict_table, f"WITH {DICTS} SELECT * FROM dicts"),
    "silenced_dicts": (silenced_dicts, f"WITH {SILENCED_DICTS} SELECT * FROM off"),
    "lexicon_lines": (lexicon_lines, r"""SELECT dicid, term, count(*) AS n FROM (
        SELECT CAST(substr(source, 4) AS BIGINT) AS dicid, regexp_replace(line, '^\s+|\s+$', '', 'g') AS term FROM (
        SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY 1, 2"""),
    "lexicon_clean": (lexicon_clean, f"WITH {CLEANED} SELECT dicid, term, count(*) AS n FROM kept GROUP BY 1, 2"),
    "lexicon_rejects": (lexicon_rejects, f"""WITH {CLEANED.replace("replace(text, ' ', chr(10))", "text")}
        SELECT dicid, CASE WHEN term = '' THEN 'blank' ELSE 'too long' END AS reason, count(*) AS n FROM cleaned
        WHERE NOT (term <> '' AND strlen(term) < 17) GROUP BY 1, 2"""),
    "lexicon_terms": (lexicon_terms, f"WITH {TERMS} SELECT termid, term, termfreq, dicid FROM terms"),
    "lexicon_active": (lexicon_active, f"WITH {ACTIVE} SELECT termid, term, termfreq, dicid FROM active"),
    "lexicon_page": (lexicon_page, f"WITH {ACTIVE} SELECT termid, term, termfreq, dicid FROM active ORDER BY termid LIMIT 200 OFFSET 400"),
    "lexicon_page_after": (lexicon_page_after, f"""WITH {ACTIVE} SELECT termid, term, termfreq, dicid FROM active
        WHERE termid > 400 ORDER BY termid LIMIT 200"""),
    "lexicon_last": (lexicon_last, f"WITH {ACTIVE} SELECT term FROM active ORDER BY termid DESC LIMIT 1"),
    "lexicon_max_id": (lexicon_max_id, f"WITH {ACTIVE} SELECT max(termid) AS max_id FROM active"),
    "user_lexicon": (user_lexicon, f"""WITH {STEMS}, {ACTIVE} SELECT term, termtype, freq FROM stems UNION ALL
        SELECT term, 'nwt', termfreq + 1000 FROM active WHERE term NOT IN (SELECT term FROM stems)"""),
    "segment_dict": (segment_dict, f"""WITH RECURSIVE {STEMS}, {CUT}, found AS (
        SELECT doc_id, substr(word, start + 1, size) AS term FROM tokens JOIN pieces ON tokens.term = word)
        SELECT doc_id, found.term AS term, coalesce(termtype, '?') AS termtype, count(*) AS n
        FROM found LEFT JOIN stems ON found.term = stems.term GROUP BY 1, 2, 3"""),
    "segment_likeliest": (segment_likeliest, f"""WITH RECURSIVE {STEMS}, {LIKELIEST}, found AS (
        SELECT doc_id, substr(word, start + 1, size) AS term FROM tokens JOIN pieces ON tokens.term = word)
        SELECT doc_id, found.term AS term, coalesce(termtype, 'n') AS termtype, count(*) AS n
        FROM found LEFT JOIN stems ON found.term = stems.term GROUP BY 1, 2, 3"""),
    "pos_filter": (pos_filter, rf"""WITH {STEMS} SELECT doc_id, CAST(pos AS INTEGER) AS pos, tokens.term AS term,
        coalesce(termtype, 'n') AS termtype FROM tokens LEFT JOIN stems ON tokens.term = stems.term
        WHERE NOT regexp_matches(coalesce(termtype, 'n'), '^(t|f|r|m|q|d|p|c|u|e|y|o|h|k|x|w)')"""),
    "simplify_chars": (simplify_chars, f"""SELECT doc_id, translate(text, '{"".join(ACCENTS)}', '{"".join(ACCENTS.values())}') AS text
        FROM documents"""),
    "dict_pages": (dict_pages, f"""WITH {PARTS} SELECT brand AS category_id, page, CASE WHEN max("count") OVER (PARTITION BY brand, page) > 2000
        THEN 'brand' || brand ELSE '' END AS category, dicid, name, "count" FROM listed QUALIFY "count" > 2000"""),
    "pager_rows": (pager_rows, f"""WITH {PARTS} SELECT DISTINCT brand AS category_id, unnest(range(2, last + 1)) AS page
        FROM (SELECT brand, max(page) AS last FROM listed GROUP BY brand HAVING min(page) = 1)"""),
    "dict_list": (dict_list, f"""WITH {PARTS} SELECT dicid, name, category, "count" FROM shown"""),
    "dict_term_todo": (dict_term_todo, f"""WITH {PARTS} SELECT md5('http://ex/dict/text?id=' || dicid) AS key,
        'http://ex/dict/text?id=' || dicid AS url FROM shown"""),
}
