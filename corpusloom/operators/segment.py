"""Cutting text without blanks into the words of a lexicon."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.keys import _col
from corpusloom.functions.text import kept_class
from corpusloom.operators import automaton
from corpusloom.operators.joins import spread_join
from corpusloom.session import ship

# A lexicon up to this size is small enough to be copied to every executor (24 bytes a state: some 200 MB for terms of 16 bytes).
BROADCAST_TERMS = 1_500_000
#: Documents of an Arrow batch whose words are listed at once.
ROWS = 1_000


def one_per_term(lexicon: DataFrame) -> DataFrame:
    """(term, termtype, freq): of a repeated term the row with the greatest freq, then the least termtype.

    A null freq counts as 0: the term is known, but never seen. Null and empty terms are no words. A term without a
    termtype comes after the others.
    """
    freq = F.coalesce("freq", F.lit(0)) if "freq" in lexicon.columns else F.lit(0)
    best = F.min(F.struct((-freq).alias("less"), F.col("termtype").isNull().alias("untyped"), "termtype"))
    terms = lexicon.filter("term <> ''").groupBy("term").agg(best.alias("b"))
    return terms.select("term", "b.termtype", (-F.col("b.less")).alias("freq"))


def letter_runs(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, run, letters): runs of letters in order; no word of a lexicon crosses their ends."""
    return docs.select(doc, F.posexplode(_runs(text)).alias("run", "letters"))


def _runs(text: str) -> Column:
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(r"(\p{L}+)"), F.lit(1))


def segment(
    docs: DataFrame,
    lexicon: DataFrame,
    method: str = "longest",
    doc: str = "doc_id",
    text: str = "text",
    unknown_class: str = "n",
    broadcast_terms: int = BROADCAST_TERMS,
) -> DataFrame:
    """(doc, pos, term, termtype): the words of each document in order.

    `longest` takes at each place the longest word, or one letter when none starts there; `likeliest` the cut with the greatest
    product of word shares, in which an unknown letter counts as a word seen half a time and the longer first word wins a tie.
    `lexicon(term, termtype, freq)` is read by `one_per_term`. As an automaton it is copied to each executor when it has at
    most `broadcast_terms` different terms, and joined to the candidate words of the text otherwise; both ways give the same cuts.
    """
    lexicon, terms, longest, total = _measured(lexicon, method)
    if terms <= broadcast_terms:
        rows = _with_copied_lexicon(docs, lexicon, doc, text, method, total, False)
        return rows.select(doc, F.struct("run", "part").alias("pos"), "term", F.coalesce("termtype", F.lit(unknown_class)).alias("termtype"))
    return _words(_with_joined_lexicon(letter_runs(docs, doc, text), lexicon, doc, method, longest, total), doc, unknown_class)


def word_counts(
    docs: DataFrame,
    lexicon: DataFrame,
    method: str = "longest",
    doc: str = "doc_id",
    text: str = "text",
    unknown_class: str = "n",
    broadcast_terms: int = BROADCAST_TERMS,
) -> DataFrame:
    """(doc, term, termtype, n): how often `segment` gives each word of a document. With a copied lexicon rows are counted in their task."""
    known, terms, _, total = _measured(lexicon, method)
    if terms <= broadcast_terms:
        rows = _with_copied_lexicon(docs, known, doc, text, method, total, True)
        kind = F.coalesce("termtype", F.lit(unknown_class)).alias("termtype")
        return rows.select(doc, "term", kind, "n").groupBy(doc, "term", "termtype").agg(F.sum("n").alias("n"))
    cut_words = segment(docs, lexicon, method, doc, text, unknown_class, broadcast_terms)
    return cut_words.groupBy(doc, "term", "termtype").agg(F.count("*").alias("n"))


def _measured(lexicon: DataFrame, method: str) -> tuple[DataFrame, int, int, float]:
    """The lexicon with one row per term, its terms, the length of the longest, and what shares are taken of."""
    if method not in ("longest", "likeliest"):
        raise ValueError("method is longest or likeliest")
    lexicon = one_per_term(lexicon)
    size = lexicon.agg(
        F.count("*").alias("terms"), F.max(F.length("term")).alias("longest"), F.sum("freq").alias("total")
    ).first()
    return lexicon, size["terms"], size["longest"] or 1, float(size["total"] or 1) + 1.0


def _with_copied_lexicon(docs: DataFrame, lexicon: DataFrame, doc: str, text: str, method: str, total: float, counted: bool) -> DataFrame:
    """(doc, term, termtype, run, part) of each word, or (doc, term, termtype, n) of each different one of a row when `counted`."""
    name, kinds = automaton.shipped(lexicon)
    names = [doc, "term", "termtype", *(["n"] if counted else ["run", "part"])]

    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = automaton.loaded(name)
        for batch in batches:
            lists = batch.column(1)
            letters, row = pa.compute.list_flatten(lists).dictionary_encode(), pa.compute.list_parent_indices(lists).to_numpy()
            # Each different run of a batch is walked once.
            found = automaton.cut_runs(letters.dictionary.to_pylist(), lambda a, b, codes, left: known.found(codes, left), method, total, kinds)
            begin, words = found[0].offsets.to_numpy(), found[0].values.dictionary_encode()
            terms, place, code = words.dictionary, words.indices.to_numpy(), letters.indices.to_numpy()
            # With an automaton the class of a word follows from its letters.
            classes = found[1].values.take(pa.array(np.unique(place, return_index=True)[1]))
            for first in range(0, batch.num_rows, ROWS):
                a, b = np.searchsorted(row, [first, first + ROWS])
                if a == b:
                    continue
                size = np.diff(begin)[code[a:b]]
                part = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                word, owner = place[np.repeat(begin[code[a:b]], size) + part], np.repeat(row[a:b], size)
                if counted:
                    keys = owner.astype(np.int64) * len(terms) + word
                    keys.sort()
                    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                    owner, word = np.divmod(keys[starts], len(terms))
                    numbers = [np.diff(np.r_[starts, len(keys)])]
                else:
                    run = np.arange(a, b) - np.searchsorted(row, row[a:b])
                    numbers = [np.repeat(run, size).astype(np.int32), part.astype(np.int32)]
                at = pa.array(word)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), terms.take(at), classes.take(at), *map(pa.array, numbers)], names)

    runs = docs.select(doc, _runs(text).alias("runs"))
    rest = "n bigint" if counted else "run int, part int"
    return ship(runs).mapInArrow(cut_batches, f"`{doc}` {dict(runs.dtypes)[doc]}, term string, termtype string, {rest}")


def _with_joined_lexicon(runs: DataFrame, lexicon: DataFrame, doc: str, method: str, longest: int, total: float) -> DataFrame:
    starts = runs.select(doc, "run", "letters", F.explode(F.sequence(F.lit(0), F.length("letters") - 1)).alias("start"))
    ends = F.sequence(F.lit(1), F.least(F.lit(longest), F.length("letters") - F.col("start")))
    # Only the candidate word travels, not the run it is part of.
    candidates = starts.select(doc, "run", "letters", "start", F.explode(ends).alias("size")).select(
        doc, "run", "start", "size", F.substr("letters", F.col("start") + 1, F.col("size")).alias("term")
    )
    met = spread_join(candidates, lexicon.select("term", "termtype", "freq"), "term")
    word = F.struct("size", "start", F.col("freq").cast("double").alias("freq"), "termtype")
    # One group is one run of letters: its known words, at most `longest` per letter, shorter ones first.
    known = met.groupBy(doc, "run").agg(F.sort_array(F.collect_list(word)).alias("found"))
    found = runs.join(known, [doc, "run"], "left").select(doc, "run", "letters", "found")

    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters, lists = batch.column(2).to_pylist(), batch.column(3)
            fields = pa.compute.list_flatten(lists)
            of_run = pa.compute.list_parent_indices(lists).to_numpy()
            classes = fields.field("termtype").dictionary_encode()
            numbers = [fields.field(c).to_numpy(zero_copy_only=False) for c in ("start", "size", "freq")]
            number = np.array(classes.indices.fill_null(-1), np.int64)

            def find(a: int, b: int, codes: np.ndarray, left: np.ndarray):
                mine = (of_run >= a) & (of_run < b)  # noqa: B023
                begin = np.cumsum([0, *map(len, letters[a:b])])[of_run[mine] - a]  # noqa: B023
                start, size, freq = (n[mine] for n in numbers)  # noqa: B023
                order = np.argsort(size, kind="stable")
                return (begin + start)[order], size[order].astype(np.int64), freq[order], number[mine][order]  # noqa: B023

            cut = automaton.cut_runs(letters, find, method, total, classes.dictionary.to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cut], names=[doc, "run", "terms", "classes"])

    return ship(found).mapInArrow(cut_batches, _schema(runs, doc))


def _schema(runs: DataFrame, doc: str) -> str:
    return f"`{doc}` {dict(runs.dtypes)[doc]}, run int, terms array<string>, classes array<string>"


def _words(cut_runs: DataFrame, doc: str, unknown_class: str) -> DataFrame:
    """(doc, run, pos in run) in order; `pos` sorts like the place in the document."""
    word = F.posexplode(F.arrays_zip("terms", "classes")).alias("part", "w")
    rows = cut_runs.select(doc, "run", word)
    return rows.select(
        doc,
        F.struct("run", "part").alias("pos"),
        F.col("w.terms").alias("term"),
        F.coalesce(F.col("w.classes"), F.lit(unknown_class)).alias("termtype"),
    )


def with_classes(tokens: DataFrame, lexicon: DataFrame, unknown_class: str = "n") -> DataFrame:
    """Adds `termtype` to tokens that were not cut with the lexicon."""
    joined = spread_join(tokens, one_per_term(lexicon).select("term", "termtype"), "term", "left")
    return joined.withColumn("termtype", F.coalesce("termtype", F.lit(unknown_class)))


def keep_terms(tokens: DataFrame, stop: DataFrame | None = None) -> DataFrame:
    """Tokens that carry meaning, without the terms of an optional stop list."""
    kept = tokens.filter(kept_class("term", "termtype"))
    return kept if stop is None else kept.join(stop.select("term").distinct(), "term", "left_anti").select(*tokens.columns)
