"""Dictionary list pages: the dictionaries they show and the further pages they lead to."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.html import leading_title
from corpusloom.functions.keys import _col, ids_in_url
from corpusloom.functions.tagevents import LIST_ARROW, LIST_TYPE, read_all, read_list_page
from corpusloom.functions.text import map_characters
from corpusloom.session import ship


def page_numbers(url: Column | str) -> Column:
    """Struct (category_id, page) of a list page URL."""
    return ids_in_url(url, r"/dict/cate/index/(\d+)/download/(\d+)", "category_id", "page")


def list_fields(html: Column | str) -> Column:
    """Struct (title, dicts, pager) of a list page, read in one pass; `dicts` are the blocks that link to a dictionary or elsewhere."""

    @F.arrow_udf(LIST_TYPE)
    def fields(pages: pa.Array) -> pa.Array:
        return read_all(pages, read_list_page, LIST_ARROW)

    # A page is read once: Spark would read it again for a filter that it makes of a later explode.
    return fields.asNondeterministic()(_col(html))


def shown_dicts(fields: Column | str) -> Column:
    """Array of (dicid, name, count) of the blocks of a read page that link to a dictionary; null where a number is none."""
    linked = F.filter(_col(fields)["dicts"], lambda d: F.startswith(d["href"], F.lit(fixed.DICT_LINK_PREFIX)))
    return F.transform(linked, lambda d: F.struct(
        F.replace(d["href"], F.lit(fixed.DICT_LINK_PREFIX), F.lit("")).try_cast("bigint").alias("dicid"),
        d["name"].alias("name"), d["count"].try_cast("bigint").alias("count"),
    ))


def last_page(fields: Column | str, most_pages: int | None = None) -> Column:
    """Greatest page number of the pager, but no more than `most_pages` where that is given; 1 without a pager."""
    numbers = F.transform(_col(fields)["pager"], lambda n: n.try_cast("int"))
    last = F.coalesce(F.array_max(numbers), F.lit(1))
    return last if most_pages is None else F.least(last, F.lit(most_pages))


def read_list_pages(
    pages: DataFrame, characters: dict[str, str] | None = None, above: int = fixed.DICT_COUNT_ABOVE, most_pages: int | None = None
) -> DataFrame:
    """(url, category_id, page, category, dicts, last_page) of pages (url, html); only dicts counted `above` that many.

    `most_pages` bounds the pages of a category that are followed; without it the pager alone decides.
    """
    html = map_characters("html", characters) if characters else F.col("html")
    read = ship(pages).select("url", page_numbers("url").alias("_numbers"), list_fields(html).alias("_read")).select(
        "url",
        "_numbers.*",
        leading_title(F.col("_read.title")).alias("category"),
        shown_dicts("_read").alias("_shown"),
        last_page("_read", most_pages).alias("last_page"),
    )
    counted = F.filter("_shown", lambda d: d["count"] > above)
    return read.withColumn("dicts", counted).withColumn(
        "category", F.when(F.size("dicts") == 0, "").otherwise(F.col("category"))
    ).drop("_shown")


def rejected_dicts(pages: DataFrame) -> DataFrame:
    """(url, name, reason): blocks of list pages whose id or count is no number."""
    read = ship(pages).select("url", list_fields("html").alias("_read"))
    shown = read.select("url", F.explode(shown_dicts("_read")).alias("d"))
    bad = shown.filter(F.col("d.dicid").isNull() | F.col("d.count").isNull())
    reason = F.when(F.col("d.dicid").isNull(), "id is no number").otherwise("count is no number")
    return bad.select("url", "d.name", reason.alias("reason"))


def pager_rows(read: DataFrame) -> DataFrame:
    """(category_id, page): the further pages that first pages lead to."""
    first = read.filter((F.col("page") == 1) & (F.col("last_page") > 1))
    return first.select("category_id", F.explode(F.sequence(F.lit(2), F.col("last_page"))).alias("page"))


def listed_dicts(read: DataFrame) -> DataFrame:
    """(category_id, page, pos, dicid, name, category, count): dictionaries of first pages and of the pages they lead to.

    The category is that of the first page, '' where no dictionary of that page qualifies.
    """
    columns = ["category_id", "page", "category", F.posexplode("dicts").alias("pos", "d")]
    first = read.filter(F.col("page") == 1)
    # The pages that were read meet the bounds of their category: a number that a pager prints makes no rows.
    bounds = first.groupBy("category_id").agg(F.max("category").alias("category"), F.max("last_page").alias("_last"))
    further = read.drop("category").join(bounds, "category_id").filter((F.col("page") > 1) & (F.col("page") <= F.col("_last")))
    rows = first.select(*columns).unionByName(further.select(*columns))
    return rows.select("category_id", "page", "pos", "d.dicid", "d.name", "category", "d.count")
