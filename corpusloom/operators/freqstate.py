"""Document frequencies that follow a changing corpus: a replaced or deleted document takes its terms out again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.keys import let
from corpusloom.functions.text import words
from corpusloom.operators.filters import last_row
from corpusloom.operators.weights import idf
from corpusloom.session import cut
from corpusloom.sources.state import store

#: The term under which documents that have terms are counted. No word is empty.
DOCUMENTS = ""

#: Up to so many changed documents go to the scan of the old ones as a list, which then opens the buckets of those only.
LISTED = 1_000


def _counted(terms: Column) -> Column:
    """What a document counts for: its distinct terms and, if there are any, itself."""
    return let(F.array_distinct(terms), lambda t: F.when(F.size(t) > 0, F.concat(F.array(F.lit(DOCUMENTS)), t)).otherwise(F.array().cast("array<string>")))


def freq_state(docs: DataFrame, terms: Column | None = None) -> DataFrame:
    """(term, df) of a table of documents, stored in buckets by term; `DOCUMENTS` has the number of documents with terms."""
    terms = words("text") if terms is None else terms
    counted = docs.select(F.explode(_counted(terms)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return store(counted, "term")


def changed_freqs(before: DataFrame, after: DataFrame, doc: str = "doc_id", terms: Column | None = None) -> DataFrame:
    """(term, d): by how much the frequency of a term changes, without those that stay.

    `before` and `after` have the changed documents as they were and as they are, a row each; a new one is missing from
    `before`, a deleted one from `after`. Terms that a document keeps are dropped in its row and never shuffled.
    """
    terms = words("text") if terms is None else terms
    old, new = before.select(doc, _counted(terms).alias("_old")), after.select(doc, _counted(terms).alias("_new"))
    none = F.array().cast("array<string>")
    met = old.join(new, doc, "full").select(F.coalesce("_old", none).alias("_old"), F.coalesce("_new", none).alias("_new"))
    signed = lambda names, d: F.transform(names, lambda t: F.struct(t.alias("term"), F.lit(d).cast("bigint").alias("d")))
    moves = F.concat(signed(F.array_except("_old", "_new"), -1), signed(F.array_except("_new", "_old"), 1))
    return met.select(F.inline(moves)).groupBy("term").agg(F.sum("d").alias("d")).filter("d <> 0")


def add_freqs(state: DataFrame, delta: DataFrame) -> DataFrame:
    """The state with a delta added, stored again. Only the delta is shuffled; a term of no document goes.

    A frequency below zero stops the job: a document was taken out that had never been counted.
    """
    df = F.coalesce(F.col("df"), F.lit(0)) + F.coalesce(F.col("d"), F.lit(0))
    met = state.join(delta, "term", "full").select("term", df.cast("bigint").alias("df"))
    wrong = F.raise_error(F.concat(F.lit("uncounted document taken out, term "), F.col("term"))).cast("bigint")
    return store(met.withColumn("df", F.when(F.col("df") < 0, wrong).otherwise(F.col("df"))).filter("df <> 0"), "term")


def old_versions(docs: DataFrame, changes: DataFrame, doc: str = "doc_id", listed: int = LISTED) -> DataFrame:
    """The rows of `docs` that `changes` touches. A table stored by `doc` stays in place, and few changes open few of its buckets."""
    ids = [row[doc] for row in changes.select(doc).limit(listed + 1).collect()]
    if len(ids) <= listed:
        return docs.filter(F.col(doc).isin(ids)) if ids else docs.filter(F.lit(False))
    return docs.join(changes.select(doc), doc, "left_semi")


def change_docs(
    docs: DataFrame, state: DataFrame, changes: DataFrame, place: str, doc: str = "doc_id", text: str = "text", listed: int = LISTED
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, state, delta) after `changes`: (doc, text, gone, place), where a true `gone` deletes and anything else replaces or adds.

    Of several changes of one document that with the greatest `place` counts; deleting an unknown document changes nothing.
    `docs` has one row (doc, text) per document and is best stored by `doc`. Terms are cut from the old and new texts of
    changed documents alone. A null or empty text has no terms, changes without an id are left out.
    """
    last = cut(last_row(changes.filter(F.col(doc).isNotNull()), doc, place).select(doc, text, F.coalesce("gone", F.lit(False)).alias("gone")))
    after = last.filter("not gone").select(doc, text)
    delta = cut(changed_freqs(old_versions(docs, last, doc, listed), after, doc, words(text)))
    met = docs.select(doc, F.col(text).alias("_was")).join(last.withColumn("_changed", F.lit(True)), doc, "full")
    kept = met.filter("not coalesce(gone, false)")
    now = kept.select(doc, F.when(F.col("_changed"), F.col(text)).otherwise(F.col("_was")).alias(text))
    return store(now, doc), add_freqs(state, delta), delta


def state_idf(state: DataFrame) -> DataFrame:
    """(term, df, idf) as the state has them."""
    documents = state.filter(F.col("term") == DOCUMENTS).agg(F.max("df")).scalar()
    return idf(state.filter(F.col("term") != DOCUMENTS), documents)
