"""From dictionary pages and texts to the lexicon."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.keys import ids_in_url, row_key
from corpusloom.operators.dictpages import listed_dicts, read_list_pages
from corpusloom.operators.graph import remaining
from corpusloom.operators.lexicon import active_terms, clean_terms, counted_lines, silence_categories
from corpusloom.operators.upserts import add_counts, delete_prefix, insert_absent, upsert_count
from corpusloom.sources.seeds import seed_urls
from corpusloom.sources.tables import Corpus


def dict_rows(dicts: DataFrame, listed: DataFrame) -> DataFrame:
    """The dictionary table after a listing; the last place a dictionary is shown at counts."""
    shown = listed.withColumn("_place", F.struct("category_id", "page", "pos"))
    return upsert_count(dicts, shown, "dicid", "_place", ["name", "category", "count"])


def collect_dicts(corpus: Corpus, pages: DataFrame, text_url: str, characters: dict[str, str] | None = None) -> None:
    """Reads the list pages (url, html) of the work list and the pages they lead to into the dictionary table.

    `text_url` is the URL of a dictionary's text with `{n}` for its id; the new ones go to the list of texts to read.
    """
    todo = corpus.read("dict_todo")
    read = read_list_pages(pages, characters)
    firsts = read.join(todo.select("url"), "url", "left_semi")
    started = firsts.select("category_id").distinct()
    listed = listed_dicts(read.join(started, "category_id", "left_semi"))
    corpus.write("dicts", dict_rows(corpus.read("dicts"), listed))
    urls = seed_urls(listed.select("dicid").distinct(), text_url, "dicid")
    corpus.write("term_todo", insert_absent(corpus.read("term_todo"), urls, "key"))
    corpus.write("dict_todo", remaining(todo, firsts.select(row_key("url").alias("key"))))
    corpus.finish()


def term_rows(terms: DataFrame, files: DataFrame, characters: dict[str, str] | None = None) -> DataFrame:
    """The dictionary term table after the texts (dicid, text): +1 per line, with the dictionary it was last seen in."""
    # The last place of a term is in the greatest dictionary that has it, wherever in its text.
    return add_counts(terms, clean_terms(counted_lines(files, characters)), "term", "termfreq", "termid", ["dicid"], "dicid")


def build_lexicon(
    corpus: Corpus, texts: DataFrame, id_pattern: str = r"id=(\d+)$", characters: dict[str, str] | None = None
) -> None:
    """Reads the dictionary texts (url, text) of the work list, switches off unwanted dictionaries and terms."""
    todo = corpus.read("term_todo")
    wanted = texts.join(todo.select("url"), "url", "left_semi")
    files = wanted.select(ids_in_url("url", id_pattern, "dicid")["dicid"].alias("dicid"), "text")
    terms = term_rows(corpus.read("dict_terms"), files, characters)
    corpus.write("dict_terms", delete_prefix(terms, "term", fixed.DELETED_TERM_PREFIX))
    corpus.write("dicts", silence_categories(corpus.read("dicts")))
    corpus.write("term_todo", remaining(todo, wanted.select(row_key("url").alias("key"))))
    corpus.finish()


def current_lexicon(corpus: Corpus) -> DataFrame:
    """Terms of the dictionaries that are switched on."""
    return active_terms(corpus.read("dict_terms"), corpus.read("dicts"))
