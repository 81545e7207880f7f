"""Tokens, counters, weights and keywords of `documents`."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.functions.keys import row_key
from corpusloom.functions.text import join_ids, split_tags, words
from corpusloom.operators import freqstate, postings, tags as tag_ops, weights as w
from corpusloom.operators.ids import dense_ids
from corpusloom.operators.joins import spread_join
from corpusloom.operators.upserts import ids_of, upsert_count
from corpusloom.plans.ingest import collected_ids
from corpusloom.sources.state import store
from corpusloom.sources.tables import dealt, read_table, sql_rows
from corpusloom.session import cut, shared_dir
from corpusloom.streaming import counters


def doc_url():
    return F.concat(F.lit("http://ex/"), F.col("doc_id"))


# SQL for the pieces that several queries share.
TOKENS = r"""tokens AS (SELECT doc_id, unnest(range(len(ws))) AS pos, unnest(ws) AS term
    FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}]+') AS ws FROM documents))"""
TF = TOKENS + ", tf AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY 1, 2)"
WEIGHTS = TF + """, idf AS (SELECT term, count(*) AS df,
      ln(((SELECT count(DISTINCT doc_id) FROM tf) + 1) / (count(*) + 1)) AS idf FROM tf GROUP BY 1),
    weights AS (SELECT doc_id, term, tf, tf * idf AS w FROM tf JOIN idf USING (term))"""
TAGS = """tagged AS (SELECT doc_id, 'lang=' || lang AS tag FROM documents
    UNION ALL SELECT doc_id, 'source=' || source FROM documents
    UNION ALL SELECT doc_id, 'quality=' || quality FROM labels)"""
BUCKET = "substr(md5({0}), 1, 3), {0}"


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", ["doc_id", *(columns or ["text"])])
    return dealt(docs) if "text" in docs.columns else docs


def tagged(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, tag): language, source and quality of a document as tags, taken apart from one tag text."""
    docs = documents(spark, folder, "lang", "source")
    labels = read_table(spark, folder, "labels", ["doc_id", "quality"])
    own = F.concat(F.lit("lang="), "lang", F.lit(" ， source="), "source")
    text = docs.select("doc_id", own.alias("tags")).unionByName(
        labels.select("doc_id", F.concat(F.lit("quality="), F.col("quality").cast("string")).alias("tags"))
    )
    return text.select("doc_id", F.explode(split_tags("tags")).alias("tag"))


def token_rows(spark, folder):
    return w.tokens(documents(spark, folder))


def term_freq(spark, folder):
    return w.term_freq(documents(spark, folder)).withColumn("tf", F.col("tf").cast("double"))


def turn_term_freq(spark, folder):
    turns = read_table(spark, folder, "conversations", ["conv_id", "text"])
    return w.term_freq_of_rows(w.tokens(turns, "conv_id"), "conv_id")


def term_presence(spark, folder):
    return w.term_presence(documents(spark, folder))


def doc_freq_idf(spark, folder):
    return w.corpus_idf(documents(spark, folder)).withColumn("idf", F.round("idf", 6))


def tfidf(spark, folder):
    weights = w.corpus_weights(documents(spark, folder))
    return weights.select("doc_id", "term", F.round("w", 6).alias("w"))


def keywords_top10(spark, folder):
    docs = documents(spark, folder)
    best = w.unpacked(w.heaviest_of(docs, w.corpus_idf(docs), 10, zeros=False))
    return best.select("doc_id", "rank", "term", F.round("w", 6).alias("w"))


def top_terms_200(spark, folder):
    docs = documents(spark, folder)
    best = w.unpacked(w.heaviest_of(docs, w.corpus_idf(docs), 200))
    return best.select("doc_id", "rank", "term", F.round("w", 6).alias("w"))


def url_keywords(spark, folder):
    """Keywords of the page whose key is the smallest; weights against the whole corpus."""
    docs = documents(spark, folder).withColumn("key", row_key(doc_url())).select("key", "text")
    idfs = w.corpus_idf(docs)
    page = docs.filter(F.col("key") == docs.agg(F.min("key")).scalar())
    own = w.keywords(w.tf_idf(w.term_freq(page, "key"), idfs), 20, "key")
    return own.select("key", "rank", "term", F.round("w", 6).alias("w"))


def corpus_term_counts(spark, folder):
    docs = documents(spark, folder)
    return tag_ops.term_and_tag_counts(docs.select(F.explode(words("text")).alias("term")), tagged(spark, folder))


def tag_counts(spark, folder):
    return tag_ops.tag_counts(tagged(spark, folder))


def tag_ids(spark, folder):
    return dense_ids(tag_ops.tag_counts(tagged(spark, folder)), "tag", "tagid")


def tag_index(spark, folder):
    rows = ids_of(tagged(spark, folder), tag_ids(spark, folder), "tag", "tagid", "tagcount")
    return tag_ops.tag_index(rows.withColumn("url", doc_url()), "tagid", "url")


def term_ids(spark, folder):
    return dense_ids(w.term_counts(documents(spark, folder)), "term", "termid")


def doc_term_ids(spark, folder):
    tokens = w.tokens(documents(spark, folder)).withColumnRenamed("doc_id", "key")
    joined = ids_of(tokens, term_ids(spark, folder), "term", "termid", "termfreq")
    ids = collected_ids(joined, "termid", "termids")
    return ids.select(F.col("key").alias("doc_id"), "termids")


def id_terms(spark, folder):
    """Terms of the ten best keywords looked up by id, as the keyword job stores ids."""
    docs = documents(spark, folder)
    best = cut(w.unpacked(w.heaviest_of(docs, w.corpus_idf(docs), 10, zeros=False)))
    table = term_ids(spark, folder)
    numbered = ids_of(best, table, "term", "termid").select("doc_id", "rank", "termid")
    return spread_join(numbered, table.select("termid", "term"), "termid").select("doc_id", "rank", "termid", "term")


def stream_term_counts(spark, folder):
    """Counts of a stream over `documents`, batch by batch into a log of the shared folder."""
    place = f"{shared_dir(spark)}/stream-{spark.range(1).select(F.expr('uuid()')).first()[0]}"
    docs = counters.arriving(spark, f"{folder}/documents.parquet", "doc_id bigint, text string")
    query = counters.log_counts(docs, f"{place}/log", f"{place}/progress")
    query.awaitTermination()
    return counters.total_counts(spark, f"{place}/log")


def stream_tag_counts(spark, folder):
    """Tag counts of a stream over `documents` as running totals, kept in versions of a shared folder."""
    place = f"{shared_dir(spark)}/stream-{spark.range(1).select(F.expr('uuid()')).first()[0]}"
    docs = counters.arriving(spark, f"{folder}/documents.parquet", "lang string, source string")
    both = F.array(F.concat(F.lit("lang="), F.col("lang")), F.concat(F.lit("source="), F.col("source")))
    counters.keep_totals(docs, f"{place}/totals", f"{place}/progress", both).awaitTermination()
    return counters.kept_totals(spark, f"{place}/totals").withColumnsRenamed({"term": "tag", "termfreq": "tagcount"})


def sql_source_counts(spark, folder):
    """A SQL text over named tables, with typed rows."""
    text = "SELECT source, lang, count(*) AS docs, sum(n_chars) AS chars FROM {documents} GROUP BY source, lang"
    return sql_rows(spark, text, documents=documents(spark, folder, "source", "lang", "n_chars"))


def incremental_term_counts(spark, folder):
    """Counters after two deliveries: even documents first, odd ones on top. Totals and ids as of the second."""
    tokens = w.tokens(documents(spark, folder)).withColumn("place", F.struct("doc_id", "pos"))
    empty = spark.createDataFrame([], "term string, termid bigint, termfreq bigint")
    even, odd = tokens.filter("doc_id % 2 = 0"), tokens.filter("doc_id % 2 = 1")
    first = upsert_count(empty, even, "term", "place", None, "termfreq", "termid")
    return upsert_count(first, odd, "term", "place", None, "termfreq", "termid")


def changed_doc_freq(spark, folder):
    """Document frequencies of a corpus in which documents were deleted, replaced and added after they were counted."""
    docs, kind = documents(spark, folder), F.col("doc_id") % 5
    known = store(docs.filter(kind != 2), "doc_id")
    gone = (kind == 0).alias("gone")
    text = F.when(kind == 1, F.regexp_replace("text", "[aeo]", "u")).otherwise(F.col("text")).alias("text")
    changes = docs.filter(kind < 3).select("doc_id", text, gone, F.lit(1).alias("place"))
    state = freqstate.change_docs(known, freqstate.freq_state(known), changes, "place")[1]
    return freqstate.state_idf(state).withColumn("idf", F.round("idf", 6))


def tag_conjunctions(spark, folder):
    """Documents that have two and three given tags, from posting blocks of all tags."""
    index = posting_blocks(spark, folder)
    found = [index.all_of(tags).select(F.lit(" ".join(tags)).alias("tags"), F.col("number").alias("doc_id")) for tags in CONJUNCTIONS]
    return reduce(DataFrame.unionByName, found)


def posting_blocks(spark, folder):
    return postings.build(tagged(spark, folder), "tag", "doc_id")


CONJUNCTIONS = [["lang=en", "quality=1"], ["lang=en", "quality=1", "source=src3"], ["lang=fr", "source=src3"]]


def _top(n, where=""):
    return f"""WITH {WEIGHTS} SELECT doc_id, rank, term, round(w, 6) AS w FROM (
        SELECT doc_id, term, w, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, term) AS INTEGER) AS rank
        FROM weights {where}) WHERE rank <= {n}"""


TERM_IDS = f"""term_ids AS (SELECT term, count(*) AS termfreq,
    row_number() OVER (ORDER BY {BUCKET.format('term')}) AS termid FROM tokens GROUP BY term)"""
TAG_IDS = f"""tag_ids AS (SELECT tag, count(*) AS tagcount,
    row_number() OVER (ORDER BY {BUCKET.format('tag')}) AS tagid FROM tagged GROUP BY tag)"""

QUERIES = {
    "token_rows": (token_rows, f"WITH {TOKENS} SELECT doc_id, CAST(pos AS INTEGER) AS pos, term FROM tokens"),
    "term_freq": (term_freq, f"WITH {TF} SELECT doc_id, term, CAST(tf AS DOUBLE) AS tf FROM tf"),
    "turn_term_freq": (turn_term_freq, r"""SELECT conv_id, term, count(*) AS tf FROM (
        SELECT conv_id, unnest(regexp_extract_all(lower(text), '[\p{L}]+')) AS term FROM conversations) GROUP BY 1, 2"""),
    "term_presence": (term_presence, f"WITH {TF} SELECT doc_id, term, CAST(1 AS DOUBLE) AS tf FROM tf"),
    "doc_freq_idf": (doc_freq_idf, f"WITH {WEIGHTS} SELECT term, df, round(idf, 6) AS idf FROM idf"),
    "tfidf": (tfidf, f"WITH {WEIGHTS} SELECT doc_id, term, round(w, 6) AS w FROM weights"),
    "keywords_top10": (keywords_top10, _top(10, "WHERE w <> 0")),
    "top_terms_200": (top_terms_200, _top(200)),
    "url_keywords": (url_keywords, f"""WITH {WEIGHTS}, page AS (
        SELECT doc_id, md5('http://ex/' || doc_id) AS key FROM documents ORDER BY key LIMIT 1)
        SELECT key, rank, term, round(w, 6) AS w FROM (SELECT key, term, w,
        CAST(row_number() OVER (ORDER BY w DESC, term) AS INTEGER) AS rank FROM weights JOIN page USING (doc_id) WHERE w <> 0)
        WHERE rank <= 20"""),
    "corpus_term_counts": (corpus_term_counts, f"""WITH {TOKENS}, {TAGS} SELECT term, count(*) AS termfreq FROM (
        SELECT term FROM tokens UNION ALL SELECT tag FROM tagged) GROUP BY term"""),
    "tag_counts": (tag_counts, f"WITH {TAGS} SELECT tag, count(*) AS tagcount FROM tagged GROUP BY tag"),
    "tag_ids": (tag_ids, f"WITH {TAGS}, {TAG_IDS} SELECT tag, tagcount, tagid FROM tag_ids"),
    "tag_index": (tag_index, f"""WITH {TAGS}, {TAG_IDS} SELECT DISTINCT
        md5(CAST(tagid AS VARCHAR)) || '-' || md5('http://ex/' || doc_id) AS key, tagid, 'http://ex/' || doc_id AS url
        FROM tagged JOIN tag_ids USING (tag)"""),
    "term_ids": (term_ids, f"WITH {TOKENS}, {TERM_IDS} SELECT term, termfreq, termid FROM term_ids"),
    "doc_term_ids": (doc_term_ids, f"""WITH {TOKENS}, {TERM_IDS}
        SELECT doc_id, string_agg(CAST(termid AS VARCHAR), ' ' ORDER BY pos) AS termids
        FROM tokens JOIN term_ids USING (term) GROUP BY doc_id"""),
    "id_terms": (id_terms, f"""WITH {WEIGHTS}, {TERM_IDS} SELECT doc_id, rank, termid, term FROM (
        SELECT doc_id, term, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, term) AS INTEGER) AS rank
        FROM weights WHERE w <> 0) JOIN term_ids USING (term) WHERE rank <= 10"""),
    "stream_term_counts": (stream_term_counts, f"""WITH {TOKENS} SELECT term, count(*) AS termfreq FROM tokens GROUP BY term"""),
    "stream_tag_counts": (stream_tag_counts, """SELECT tag, count(*) AS tagcount FROM (
        SELECT 'lang=' || lang AS tag FROM documents UNION ALL SELECT 'source=' || source FROM documents) GROUP BY tag"""),
    "sql_source_counts": (sql_source_counts, """SELECT source, lang, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars
        FROM documents GROUP BY source, lang"""),
    "changed_doc_freq": (changed_doc_freq, "WITH now AS (SELECT doc_id, CASE WHEN doc_id % 5 = 1 THEN regexp_replace(text, '[aeo]', 'u', 'g') "
        "ELSE text END AS text FROM documents WHERE doc_id % 5 <> 0), "
        + WEIGHTS.replace("FROM documents", "FROM now") + " SELECT term, df, round(idf, 6) AS idf FROM idf"),
    "tag_conjunctions": (tag_conjunctions, f"WITH {TAGS}, pairs AS (SELECT DISTINCT doc_id, tag FROM tagged) " + " UNION ALL ".join(
        f"SELECT '{' '.join(tags)}' AS tags, doc_id FROM pairs WHERE tag IN ({', '.join(map(repr, tags))}) GROUP BY doc_id HAVING count(*) = {len(tags)}"
        for tags in CONJUNCTIONS)),
    "incremental_term_counts": (incremental_term_counts, f"""WITH {TOKENS}, seen AS (
        SELECT term, count(*) AS termfreq, min(doc_id % 2) AS part FROM tokens GROUP BY term)
        SELECT term, row_number() OVER (ORDER BY part, {BUCKET.format('term')}) AS termid, termfreq FROM seen"""),
}
