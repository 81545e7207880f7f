"""Dictionaries and their terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.text import clean_lexicon_term, map_characters, short_enough
from corpusloom.operators.filters import any_contains
from corpusloom.operators.ids import page_by_position
from corpusloom.operators.joins import spread_join
from corpusloom.operators.upserts import update_where


def dict_lines(files: DataFrame, characters: dict[str, str] | None = None) -> DataFrame:
    """(dicid, pos, term): the trimmed lines of dictionary texts (dicid, text)."""
    text = map_characters("text", characters) if characters else F.col("text")
    lines = files.select("dicid", F.posexplode(F.split(text, "\n")).alias("pos", "term"))
    return lines.withColumn("term", F.regexp_replace("term", r"^\s+|\s+$", ""))


def counted_lines(files: DataFrame, characters: dict[str, str] | None = None) -> DataFrame:
    """(term, n, dicid): the trimmed lines of dictionary texts with their number and the greatest dictionary they are in.

    Equal lines are combined before they are trimmed, so that a line is worked on once however often it occurs; a term
    may come in as many rows as it was written in different ways.
    """
    text = map_characters("text", characters) if characters else F.col("text")
    lines = files.select("dicid", F.explode(F.split(text, "\n")).alias("term"))
    counted = lines.groupBy("term").agg(F.count("*").alias("n"), F.max("dicid").alias("dicid"))
    # As the element of a list, so that Spark does not move a later filter on the term to before the lines are combined.
    trimmed = F.array(F.regexp_replace("term", r"^\s+|\s+$", ""))
    return counted.select(F.explode(trimmed).alias("term"), "n", "dicid")


def clean_terms(lines: DataFrame, below: int = fixed.TERM_BYTES_BELOW) -> DataFrame:
    """Lines as lexicon terms; those that are blank or too long are left out."""
    return lines.withColumn("term", clean_lexicon_term("term")).filter(short_enough("term", below))


def rejected_terms(lines: DataFrame, below: int = fixed.TERM_BYTES_BELOW) -> DataFrame:
    """The lines that `clean_terms` leaves out, with the reason."""
    cleaned = lines.withColumn("cleaned", clean_lexicon_term("term")).filter(
        ~F.coalesce(short_enough("cleaned", below), F.lit(False))
    )
    blank = F.coalesce(F.col("cleaned") == "", F.lit(True))
    return cleaned.withColumn("reason", F.when(blank, "blank").otherwise("too long"))


def silence_categories(dicts: DataFrame, parts: list[str] | None = None) -> DataFrame:
    """Sets the count of dictionaries to 0 whose category names a silenced subject."""
    return update_where(dicts, {"count": 0}, any_contains("category", parts or fixed.SILENCED_CATEGORIES))


def active_terms(terms: DataFrame, dicts: DataFrame) -> DataFrame:
    """Terms of dictionaries with a count above 0. One dictionary may hold any share of the terms."""
    active = dicts.filter(F.col("count") > 0).select("dicid").distinct()
    return spread_join(terms, active, "dicid").select(*terms.columns)


def last_term(terms: DataFrame, number: str = "termid") -> DataFrame:
    """One row: the term with the greatest id, '' for an empty table."""
    return terms.agg(F.coalesce(F.max_by("term", number), F.lit("")).alias("term"))


def user_lexicon(base: DataFrame, terms: DataFrame, limit: int | None = None) -> DataFrame:
    """(term, termtype, freq): the base lexicon and the user terms it does not have.

    Where a term was stored twice, the lower id counts. A limit, where asked for, takes the first terms by id.
    """
    loaded = terms if limit is None else page_by_position(terms, "termid", 1, limit)
    user = loaded.groupBy("term").agg(F.min_by("termfreq", "termid").alias("termfreq"))
    new = user.join(base.select("term"), "term", "left_anti").select(
        "term",
        F.lit(fixed.USER_TERM_CLASS).alias("termtype"),
        (F.col("termfreq") + fixed.USER_TERM_BONUS).cast("bigint").alias("freq"),
    )
    return base.select("term", "termtype", F.col("freq").cast("bigint").alias("freq")).unionByName(new)
