"""Web pages as rows of text, title, tags, keywords and links."""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.html import _any
from corpusloom.functions.keys import _col, canonical_url
from corpusloom.functions.tagevents import PAGE_ARROW, PAGE_TYPE, read_all, read_page
from corpusloom.session import ship


@dataclass
class PageRules:
    """Where a site keeps what is read. The last content selector that is present counts."""

    content: list[str] = field(default_factory=lambda: list(fixed.CONTENT_SELECTORS))
    tags: str = fixed.TAG_SELECTOR
    title_suffix: str = ""
    link_prefixes: list[str] = field(default_factory=list)


def page_fields(html: Column | str, rules: PageRules) -> Column:
    """Struct (content, title, tags, keyword, hrefs) of a page, read in one pass."""
    content, tags = list(rules.content), rules.tags

    @F.arrow_udf(PAGE_TYPE)
    def fields(pages: pa.Array) -> pa.Array:
        return read_all(pages, lambda page: read_page(page, content, tags, "Keywords"), PAGE_ARROW)

    # A page is read once: Spark would read it again for each filter that follows, or that it makes of an explode.
    return fields.asNondeterministic()(_col(html))


def read_pages(pages: DataFrame, rules: PageRules, keep: list[str] | None = None) -> DataFrame:
    """Adds content, title, tags, keyword and hrefs to pages with an `html` column, which stays only if in `keep`.

    A page without content has none of the others either.
    """
    kept = keep if keep is not None else [c for c in pages.columns if c != "html"]
    read = ship(pages).select(*kept, page_fields("html", rules).alias("_page"))
    title = F.replace(F.col("_page.title"), F.lit(rules.title_suffix), F.lit("")) if rules.title_suffix else F.col("_page.title")
    wanted = F.filter(F.col("_page.hrefs"), lambda h: _any(h, rules.link_prefixes))
    return read.select(
        *kept, "_page.content", title.alias("title"), "_page.tags", "_page.keyword", F.transform(wanted, canonical_url).alias("hrefs")
    )


def has_content(read: DataFrame) -> DataFrame:
    return read.filter(F.col("content") != "")


def empty_pages(read: DataFrame) -> DataFrame:
    """Pages that only leave the work list, with the reason."""
    return read.filter(F.col("content") == "").withColumn("reason", F.lit("no content"))
