"""Tag counters, the inverted tag index, class slices and labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.keys import pair_key


def tag_counts(tagged: DataFrame) -> DataFrame:
    """(tag, tagcount): +1 for each page that has the tag."""
    return tagged.groupBy("tag").agg(F.count("*").alias("tagcount"))


def term_and_tag_counts(terms: DataFrame, tagged: DataFrame) -> DataFrame:
    """(term, termfreq) over tokens, with each tag of a page counted as one more term."""
    both = terms.select("term").unionByName(tagged.select(F.col("tag").alias("term")))
    return both.groupBy("term").agg(F.count("*").alias("termfreq"))


def tag_index(tagged: DataFrame, tag_id: str, url: str) -> DataFrame:
    """(key, tag id, url), one row per pair."""
    pairs = tagged.select(tag_id, url).dropDuplicates()
    return pairs.select(pair_key(tag_id, url).alias("key"), tag_id, url)


def tag_slice(
    counts: DataFrame,
    take: int = fixed.CLASS_LIMIT,
    min_count: int = fixed.CLASS_MIN_COUNT,
    skip: int = fixed.CLASS_SKIP,
) -> DataFrame:
    """The most frequent tags, without the very first ones. At most `take` rows."""
    frequent = counts.filter(F.col("tagcount") >= min_count)
    return frequent.orderBy(F.desc("tagcount"), F.asc("tag")).offset(skip).limit(take)


def root_tags(tagged: DataFrame, selected: DataFrame, roots: DataFrame) -> DataFrame:
    """Documents with root tags. Only selected tags have a root here; a tag without one, or with a blank one, is its own.

    `selected` comes from `tag_slice` and thus has a bounded number of rows, as has what is joined from `roots`.
    """
    blank = F.col("root_tag").isNull() | F.col("root_tag").cast("string").isin("0", "")
    own = roots.join(F.broadcast(selected.select("tag")), "tag", "left_semi").filter(~blank).select("tag", "root_tag")
    # One root per tag, so that this table is no longer than `selected`.
    own = own.groupBy("tag").agg(F.min("root_tag").alias("root_tag"))
    joined = tagged.join(F.broadcast(own), "tag", "left")
    return joined.withColumn("tag", F.coalesce(F.col("root_tag"), F.col("tag"))).drop("root_tag")


def labelled_docs(tagged: DataFrame, selected: DataFrame, roots: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, tag): the distinct root tags of each document that are selected themselves."""
    rooted = root_tags(tagged.select(doc, "tag"), selected, roots)
    kept = rooted.join(F.broadcast(selected.select("tag")), "tag", "left_semi")
    return kept.select(doc, "tag").dropDuplicates()
