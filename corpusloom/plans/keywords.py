"""Keywords of stored pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.keys import row_key
from corpusloom.functions.text import parse_ids
from corpusloom.operators.filters import present
from corpusloom.operators.joins import spread_join
from corpusloom.operators.weights import corpus_idf, keywords, term_freq, tf_idf
from corpusloom.session import cut
from corpusloom.sources.tables import Corpus


def page_ids(done: DataFrame) -> DataFrame:
    """(key, url, ids): pages that have terms, with their term ids; 0 stands for no term."""
    own = done.filter(present("termids")).select("key", "url", parse_ids("termids").alias("ids"))
    return own.withColumn("ids", F.filter("ids", lambda i: i != 0))


def page_weights(done: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """(key, term, tf, w) with term ids as terms. idf is taken from all pages, weights for those in `only(key)` or all."""
    pages = page_ids(done)
    idfs = corpus_idf(pages, F.col("ids"))
    wanted = pages if only is None else pages.join(only.select("key").distinct(), "key", "left_semi")
    return tf_idf(term_freq(wanted, "key", F.col("ids")), idfs)


def corpus_keywords(corpus: Corpus, n: int, url: str | None = None) -> DataFrame:
    """(key, rank, term, w): the `n` best keywords of every stored page, or of one."""
    done = corpus.read("done")
    only = None if url is None else done.filter(F.col("key") == row_key(F.lit(url)))
    # The join reads its rows twice; these are few, what makes them is much.
    best = cut(keywords(page_weights(done, only), n, "key").withColumnRenamed("term", "termid"))
    named = spread_join(best, corpus.read("terms").select("termid", "term"), "termid")
    return named.select("key", "rank", "term", "w")
