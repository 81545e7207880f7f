"""Empty tables and seeded work lists."""

from __future__ import annotations

from corpusloom.sources.seeds import seed_range
from corpusloom.sources.tables import DICT_TABLES, PAGE_TABLES, Corpus


def reset_all(corpus: Corpus) -> None:
    """All tables, empty."""
    corpus.reset()
    corpus.finish()


def seed_pages(corpus: Corpus, last: int, template: str) -> None:
    """Empty page tables and a work list of the page URLs numbered 1 to `last`."""
    corpus.reset([t for t in PAGE_TABLES if t != "todo"])
    corpus.write("todo", seed_range(corpus.spark, last, template))
    corpus.finish()


def seed_dicts(corpus: Corpus, last: int, template: str) -> None:
    """Empty dictionary tables and a work list of the category pages numbered 1 to `last`."""
    corpus.reset([t for t in DICT_TABLES if t != "dict_todo"])
    corpus.write("dict_todo", seed_range(corpus.spark, last, template))
    corpus.finish()
