"""Term frequencies, document frequencies, TF-IDF weights and the heaviest terms of each document."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusloom.functions.keys import _col, let
from corpusloom.functions.text import words
from corpusloom.operators.joins import spread_join
from corpusloom.session import cut, ship

#: Every task gets the idf of the terms with more than one of so many frequencies, hence of fewer terms than this (some 25 MB).
COPIED = 1_000_000


def tokens(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (doc, pos, term) per token."""
    return docs.select(doc, F.posexplode(words(text)).alias("pos", "term"))


def run_lengths(terms: Column | str) -> Column:
    """Array of (term, tf) of an array of terms: sort it, then measure the runs. Needs no shuffle."""

    def starts(ordered: Column) -> Column:
        first = lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2))
        return F.filter(F.when(F.size(ordered) > 0, F.sequence(F.lit(1), F.size(ordered))), first)

    def runs(row: Column) -> Column:
        ordered, begin = row["ordered"], row["begin"]
        run = lambda start, i: F.struct(
            F.get(ordered, start - 1).alias("term"),
            (F.coalesce(F.get(begin, i + 1), F.size(ordered) + 1) - start).cast("bigint").alias("tf"),
        )
        return F.transform(begin, run)

    ordered = F.sort_array(_col(terms))
    return let(let(ordered, lambda o: F.struct(o.alias("ordered"), starts(o).alias("begin"))), runs)


def term_freq(docs: DataFrame, doc: str = "doc_id", terms: Column | None = None) -> DataFrame:
    """(doc, term, tf) for one row per document. A document never leaves its task."""
    terms = words("text") if terms is None else terms
    return docs.select(doc, F.inline(run_lengths(terms)))


def term_freq_of_rows(rows: DataFrame, doc: str, term: str = "term", weight: str | None = None) -> DataFrame:
    """(doc, term, tf) when the tokens of a document come as several rows."""
    amount = F.sum(weight) if weight else F.count("*")
    return rows.groupBy(doc, F.col(term).alias("term")).agg(amount.alias("tf"))


def term_presence(docs: DataFrame, doc: str = "doc_id", terms: Column | None = None) -> DataFrame:
    """(doc, term, tf) with tf = 1.0 for every term a document has."""
    terms = words("text") if terms is None else terms
    return docs.select(doc, F.explode(F.array_distinct(terms)).alias("term"), F.lit(1.0).alias("tf"))


def doc_freq(docs: DataFrame, terms: Column | None = None) -> DataFrame:
    """(term, df): in how many documents a term occurs, counted before the shuffle."""
    terms = words("text") if terms is None else terms
    return docs.select(F.explode(F.array_distinct(terms)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def doc_freq_of_tf(tf: DataFrame) -> DataFrame:
    return tf.groupBy("term").agg(F.count("*").alias("df"))


def idf(df: DataFrame, documents: Column) -> DataFrame:
    """(term, df, idf) with idf = ln((m + 1) / (df + 1))."""
    return df.withColumn("idf", F.ln((documents + 1) / (F.col("df") + 1)))


def corpus_idf(docs: DataFrame, terms: Column | None = None, keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """`idf` of a table of documents in one pass over it, written by `keep` for the several uses that follow.

    Documents that have a term are counted along with the terms, as one more term that is null.
    """
    terms = words("text") if terms is None else terms
    marked = let(F.array_distinct(terms), lambda t: F.when(F.size(t) > 0, F.concat(F.array(F.lit(None)), t)))
    counted = keep(docs.select(F.explode(marked).alias("term")).groupBy("term").agg(F.count("*").alias("df")))
    documents = counted.filter(F.col("term").isNull()).agg(F.max("df")).scalar()
    return idf(counted.filter(F.col("term").isNotNull()), documents)


def tf_idf(tf: DataFrame, idfs: DataFrame) -> DataFrame:
    """(doc, term, tf, w): the frequencies times idf. The document frequencies tell the hot terms."""
    counts = idfs.select("term", F.col("df").alias("n"))
    joined = spread_join(tf, idfs.select("term", "idf"), "term", "inner", counts)
    return joined.withColumn("w", F.col("tf") * F.col("idf")).drop("idf")


def counted(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Different terms in order, and of each list and term the list, the place of the term and how often it occurs, in this order."""
    coded = pc.list_flatten(lists).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy().astype(np.int64)
    place, width = np.empty_like(order), max(1, len(order))
    place[order] = np.arange(len(order))
    keys = pc.list_parent_indices(lists).to_numpy().astype(np.int64) * width + place[coded.indices.to_numpy()]
    keys.sort()
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    return coded.dictionary.take(pa.array(order)), keys[starts] // width, keys[starts] % width, np.diff(np.r_[starts, len(keys)])


def offsets(of: np.ndarray, rows: int) -> pa.Array:
    """Where the list of each row begins, then the end; `of` is the row of each element, in order."""
    return pa.array(np.searchsorted(of, np.arange(rows + 1)).astype(np.int32))


def packed_tf_idf(
    docs: DataFrame, idfs: DataFrame, n: int, zeros: bool = True, copied: int = COPIED,
    keep: Callable[[DataFrame], DataFrame] = cut, wanted: DataFrame | None = None,
) -> DataFrame:
    """(doc, terms): the weights of documents (doc, terms) as arrays of (term, tf, w), heaviest first, in one row a document.

    They hold the `n` heaviest terms of each document, without those of weight 0 unless `zeros`; equal weights go by term.
    `wanted`, a table with the column doc, leaves only its documents.
    The idf of the frequent terms is copied to all tasks, where a row keeps the `n` heaviest of them; its other terms, each
    rarer than one of `copied` frequencies, meet their idf by term. Those rows are a small part and have no hot keys.
    Frequent terms travel as their places in the copied table, which is at hand again where they meet the rare ones.
    """
    doc = next(c for c in docs.columns if c != "terms")
    total = idfs.agg(F.sum("df")).scalar()
    # Fewer than `copied` rows whatever the corpus.
    frequent = idfs.filter(F.col("df") * copied > total).select("term", "idf").toArrow()
    known = pa.concat_arrays([pa.array([], pa.string()), *[c.cast(pa.string()) for c in frequent["term"].chunks]])
    shared = docs.sparkSession.sparkContext.broadcast((known, frequent["idf"].to_numpy().astype(np.float64)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, idf = shared.value
        idf = np.r_[idf, np.nan]
        for batch in batches:
            # In the order of rows, then of terms.
            terms, of, term, tf = counted(batch.column(1))
            place = pc.index_in(terms, value_set=known).fill_null(len(known)).to_numpy()[term]
            w = tf * idf[place]
            kept = np.flatnonzero((place < len(known)) & (zeros | (w != 0)))
            # The sort is stable: equal weights stay in the order of terms.
            kept = kept[np.lexsort((-w[kept], of[kept]))]
            kept = kept[np.arange(len(kept)) - np.searchsorted(of[kept], of[kept]) < n]
            rest = np.flatnonzero(place == len(known))
            begin = offsets(of[kept], batch.num_rows)
            lists = [pa.ListArray.from_arrays(begin, pa.array(values[kept].astype(np.int32))) for values in (place, tf)]
            rare = pa.StructArray.from_arrays([terms.take(pa.array(term[rest])), pa.array(tf[rest])], ["term", "tf"])
            heavy = pa.StructArray.from_arrays(lists, ["places", "tfs"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), heavy, pa.ListArray.from_arrays(offsets(of[rest], batch.num_rows), rare)], [doc, "heavy", "rest"]
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, idf = shared.value
        for batch in batches:
            places, tfs, rare = (pc.list_flatten(batch.column(i)) for i in (1, 2, 3))
            place, (rare_term, rare_tf, rare_w) = places.to_numpy(), rare.flatten()
            of = np.r_[tuple(pc.list_parent_indices(batch.column(i)).to_numpy() for i in (1, 3))]
            tf = np.r_[tfs.to_numpy().astype(np.int64), rare_tf.to_numpy()]
            w = np.r_[tf[:len(place)] * idf[place], rare_w.to_numpy()]
            coded = pa.concat_arrays([known.take(places), rare_term.cast(known.type)]).dictionary_encode()
            terms, term = coded.dictionary, coded.indices.to_numpy()
            rank = np.empty(len(terms), np.int64)
            rank[pc.sort_indices(terms).to_numpy()] = np.arange(len(terms))
            kept = np.lexsort((tf, rank[term], -w, of))
            kept = kept[np.arange(len(kept)) - np.searchsorted(of[kept], of[kept]) < n]
            values = [terms.take(pa.array(term[kept])), pa.array(tf[kept]), pa.array(w[kept])]
            heaviest = pa.StructArray.from_arrays(values, ["term", "tf", "w"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets(of[kept], batch.num_rows), heaviest)], [doc, "terms"]
            )

    own = f"`{doc}` {dict(docs.dtypes)[doc]}"
    heavy, rare = "struct<places: array<int>, tfs: array<int>>", "struct<term: string, tf: bigint, w: double>"
    # Read twice below.
    met = keep(ship(docs.select(doc, "terms")).mapInArrow(weigh, f"{own}, heavy {heavy}, rest array<struct<term: string, tf: bigint>>"))
    rest = met.select(doc, F.inline("rest")).join(idfs.select("term", "idf"), "term").withColumn("w", F.col("tf") * F.col("idf"))
    rest = rest.filter(F.lit(zeros) | (F.col("w") != 0)).select(doc, F.lit(None).cast(heavy).alias("heavy"), F.struct("term", "tf", "w").alias("rare"))
    both = met.select(doc, "heavy", F.lit(None).cast(rare).alias("rare")).unionByName(rest)
    gathered = both.groupBy(doc).agg(F.collect_list("heavy").alias("heavy"), F.collect_list("rare").alias("rare"))
    if wanted is not None:
        gathered = gathered.join(wanted, doc, "left_semi")
    lists = [F.flatten(F.transform("heavy", lambda h: h[name])).alias(name) for name in ("places", "tfs")]
    return gathered.select(doc, *lists, "rare").mapInArrow(merge, f"{own}, terms array<{rare}>")


def packed_heaviest(weights: DataFrame, n: int) -> DataFrame:
    """(doc, terms): one row per document with its `n` heaviest terms of `packed_tf_idf` in order; equal weights go by term."""
    doc = next(c for c in weights.columns if c != "terms")
    return weights.select(doc, F.slice("terms", 1, n).alias("terms"))


def unpacked(weights: DataFrame) -> DataFrame:
    """(doc, term, tf, w, rank) of `packed_heaviest`, as `heaviest_terms` gives them. Other weights stay as they are."""
    if "terms" not in weights.columns:
        return weights
    doc = next(c for c in weights.columns if c != "terms")
    rows = weights.select(doc, F.posexplode("terms").alias("at", "t"))
    return rows.select(doc, "t.term", "t.tf", "t.w", (F.col("at") + 1).alias("rank"))


def heaviest_of(
    docs: DataFrame, idfs: DataFrame, n: int, zeros: bool = True, doc: str = "doc_id", text: str = "text",
    keep: Callable[[DataFrame], DataFrame] = cut, wanted: DataFrame | None = None,
) -> DataFrame:
    """The rows of `heaviest_terms` over the weights of a table of documents, packed: without `zeros` those of `keywords`.

    A document is one row on all ways but that of its rare terms.
    """
    return packed_heaviest(packed_tf_idf(docs.select(doc, words(text).alias("terms")), idfs, n, zeros, keep=keep, wanted=wanted), n)


def corpus_weights(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """TF-IDF weights of all documents of a table."""
    return tf_idf(term_freq(docs, doc, words(text)), corpus_idf(docs, words(text)))


def heaviest_terms(weights: DataFrame, n: int, doc: str = "doc_id") -> DataFrame:
    """The `n` heaviest terms of each document with their `rank`; equal weights go by term."""
    order = W.partitionBy(doc).orderBy(F.desc("w"), F.asc("term"))
    return weights.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def keywords(weights: DataFrame, n: int, doc: str = "doc_id") -> DataFrame:
    """The `n` heaviest terms, without those of weight 0 (terms that every document has)."""
    return heaviest_terms(weights.filter(F.col("w") != 0), n, doc)


def keywords_of(weights: DataFrame, value: object, n: int, doc: str = "doc_id") -> DataFrame:
    """Keywords of one document; an unknown document has none."""
    own = weights.filter((F.col(doc) == F.lit(value)) & (F.col("w") != 0))
    return own.orderBy(F.desc("w"), F.asc("term")).limit(n)


def term_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, termfreq): occurrences in the whole corpus."""
    return docs.select(F.explode(words(text)).alias("term")).groupBy("term").agg(F.count("*").alias("termfreq"))
