"""Substring dedup: documents factored against an index of reference windows, after relative Lempel-Ziv parsing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusloom.llm.common import WordHashes, full_text, guarded, key_filter, mixed, row_batches, runs_of, ship, staged

#: Odd factors of the two independent hashes of a window and of the hash of an anchor.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)

OUTPUTS = ["n_words", "n_removed", "kept_text"]


def _keyed(documents: DataFrame, row: str, text: str) -> DataFrame:
    """(k1, k2, rowkey, text): 96 bits of the text, and the same mixed with the row's id."""
    texts = documents.select(F.col(row).alias("row"), full_text(text).alias("text"))
    return texts.select(*_key(F.col("text")), F.xxhash64("text", "row").alias("rowkey"), "text")


def _key(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("k1"), F.hash(text, F.lit("k2")).alias("k2")


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """`pick` (minimum or maximum) over each `width` consecutive values."""
    done, length = values, 1
    while length < width:
        step = min(length, width - length)
        done = pick(done[:-step], done[step:])
        length += step
    return done


def _anchors(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the chosen grams, as often as they are there, and for each window that of its least gram: equal windows have equal ones."""
    grams = runs_of(words, gram, FACTORS[2])
    least = _slide(grams, window - gram + 1, np.minimum)
    # A gram is chosen when it is the least one of some window.
    wide = window - gram
    padded = np.concatenate([np.full(wide, least[0]), least, np.full(wide, least[-1])]) if len(least) else least
    chosen = grams[_slide(padded, wide + 1, np.maximum)[:len(grams)] == grams] if len(least) else grams[:0]
    # Least hashes are small ones; a filter needs even bits.
    return mixed(chosen), mixed(least)


def _first_rows(batches, kept):
    """(k1, k2, words) of the rows that may stand for their text; words as bytes."""
    for batch in row_batches(batches):
        passing = kept.passes(mixed(batch.column(2).to_numpy().view(np.uint64)))
        k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        texts = batch.column(3)
        for at in np.flatnonzero(passing):
            yield k1[at], k2[at], texts[int(at)].as_py().encode().split()


def window_places(documents: DataFrame, row: str = "doc_id", text: str = "text", window: int = 35, gram: int = 16) -> DataFrame:
    """(h1, h2, k1, k2, pos) of every window that may occur twice, from one row of each different text at least.

    Each window holds an anchor, its least gram by hash. Only windows whose anchor occurs again are looked at further;
    filters of bounded size carry both choices, and what they let through by chance does no harm.
    """
    ship(documents)
    keyed = _keyed(documents, row, text)
    first = staged(keyed.groupBy("k1", "k2").agg(F.min("rowkey").alias("rowkey")).select("rowkey"))
    rows = key_filter(first, "rowkey", mix=True)

    def anchors(batches):
        hashes, found = WordHashes(), []
        for _, _, words in _first_rows(batches, rows):
            if len(words) >= window:
                found.append(_anchors(hashes.of(words), window, gram)[0])
                if len(found) >= 256:
                    yield counted(found)
                    found = []
        if found:
            yield counted(found)

    def counted(found):
        anchor, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n.astype(np.int32))], ["anchor", "n"])

    again = staged(keyed.mapInArrow(anchors, "anchor bigint, n int").groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"))
    repeated = key_filter(again, "anchor")

    def places(batches):
        hashes, out, size = WordHashes(), [], 0
        for k1, k2, words in _first_rows(batches, rows):
            if len(words) < window:
                continue
            coded = hashes.of(words)
            at = np.flatnonzero(repeated.passes(_anchors(coded, window, gram)[1]))
            if len(at):
                one, two = (runs_of(coded, window, f)[at] for f in FACTORS[:2])
                out.append((one.view(np.int64), (two >> np.uint64(32)).astype(np.uint32).view(np.int32), np.full(len(at), k1), np.full(len(at), k2), at.astype(np.int32)))
                size += len(at)
            if size > 50_000:
                yield gathered(out)
                out, size = [], 0
        if out:
            yield gathered(out)

    def gathered(out):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["h1", "h2", "k1", "k2", "pos"])

    return keyed.mapInArrow(places, "h1 bigint, h2 int, k1 bigint, k2 int, pos int")


def repeated_spans(documents: DataFrame, row: str = "doc_id", text: str = "text", window: int = 35) -> DataFrame:
    """(k1, k2, spans): word spans [start, end) of each different text covered by windows that also start elsewhere; written.

    The index holds one reference place for each window hash (96 bits) that starts at two places. A text is factored by
    looking its windows up: a factor goes on while the reference place moves along with it, so it is as long as the match
    with that reference; at a factor's boundary the next windows are looked up on their own, so none that crosses it is
    lost. Factors of `window` words or more are the duplicate spans. A text that several rows share repeats as a whole.
    """
    places = window_places(documents, row, text, window).withColumn("occurrence", F.expr("k1 + pos"))
    index = places.groupBy("h1", "h2").agg(F.min("occurrence").alias("first"), F.max("occurrence").alias("last")).filter("first != last")
    # Written, so that the join can split a window that very many places share.
    index = staged(index).select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), "first", "last")
    met = places.join(index, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")))
    other = F.when(F.col("first") == F.col("occurrence"), F.col("last")).otherwise(F.col("first"))
    # The same along a factor: where its text would begin in the reference.
    line = F.hash(other - F.col("pos"))
    lookups = met.select("k1", "k2", F.struct("pos", line.alias("line")).alias("hit")).groupBy("k1", "k2").agg(F.collect_list("hit").alias("hits"))

    def factored(batches):
        for batch in row_batches(batches, 64):
            spans = []
            hits = batch.column(2)
            for at in range(batch.num_rows):
                values = hits[at].values
                pos, line = (np.asarray(values.field(i)).astype(np.int64) for i in (0, 1))
                spans.append(_factors(pos, line, window))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, pa.list_(pa.int32()))], ["k1", "k2", "spans"])

    found = lookups.mapInArrow(factored, "k1 bigint, k2 int, spans array<int>")
    copies = documents.select(*_key(full_text(text))).groupBy("k1", "k2").agg(F.count("*").alias("n")).filter("n > 1").select("k1", "k2", F.lit(True).alias("whole"))
    return staged(found.join(copies, ["k1", "k2"], "full").select("k1", "k2", F.coalesce("spans", F.array().cast("array<int>")).alias("spans"), F.coalesce("whole", F.lit(False)).alias("whole")))


def _factors(pos: np.ndarray, line: np.ndarray, window: int) -> list[int]:
    """Starts and ends, in turn, of the joined spans of the factors that begin at looked-up windows."""
    order = np.argsort(pos, kind="stable")
    pos, line = pos[order], line[order]
    once = np.r_[True, pos[1:] != pos[:-1]]
    pos, line = pos[once], line[once]
    # A factor ends where the next window is unknown or its reference lies elsewhere.
    begins = np.flatnonzero(np.r_[True, (pos[1:] != pos[:-1] + 1) | (line[1:] != line[:-1])])
    starts, ends = pos[begins], pos[np.r_[begins[1:], len(pos)] - 1] + window
    apart = np.flatnonzero(np.r_[True, starts[1:] > ends[:-1]])
    return np.stack([starts[apart], ends[np.r_[apart[1:], len(ends)] - 1]], 1).ravel().tolist()


def without_repeats(documents: DataFrame, row: str = "doc_id", text: str = "text", window: int = 35) -> DataFrame:
    """All rows and columns of `documents` with n_words, n_removed and kept_text.

    A word goes when a window of `window` words of the input over it also starts anywhere else; kept words are joined by
    one space. Null, empty and short texts lose nothing; equal texts of `window` words or more lose all words in every
    row; repeated rows count as copies; without documents there are no rows.
    """
    return guarded(documents, OUTPUTS, lambda rows, name: _without_repeats(rows, name(row), name(text), window))


def _without_repeats(documents: DataFrame, row: str, text: str, window: int) -> DataFrame:
    spans = repeated_spans(documents, row, text, window)
    keys = key_filter(spans, "k1", mix=True)

    k1, k2 = _key(full_text(text))
    keyed = documents.select(*documents.columns, k1.alias("_k1"), k2.alias("_k2"))
    columns, width = documents.columns, len(documents.columns)
    place = columns.index(text)

    def passing(batch):
        return keys.passes(mixed(batch.column(width).to_numpy().view(np.uint64)))

    def cut(batch, spans_of, wholes):
        total, removed, kept = [], [], []
        for one, spans, whole in zip(batch.column(place).to_pylist(), spans_of, wholes):
            words = ("" if one is None else str(one)).encode().split()
            total.append(len(words))
            if whole and len(words) >= window:
                left = []
            elif spans:
                edges = [0, *spans, len(words)]
                left = [w for start, end in zip(edges[::2], edges[1::2]) for w in words[start:end]]
            else:
                left = words
            removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
        results = [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
        return pa.RecordBatch.from_arrays([*batch.columns[:width], *results], [*columns, "n_words", "n_removed", "kept_text"])

    def cut_alone(batches):
        for batch in row_batches(batches):
            rest = batch.filter(pa.array(~passing(batch)))
            yield cut(rest, [None] * rest.num_rows, [False] * rest.num_rows)

    def to_meet(batches):
        for batch in row_batches(batches):
            yield batch.filter(pa.array(passing(batch)))

    def cut_met(batches):
        for batch in row_batches(batches):
            yield cut(batch, batch.column(width).to_pylist(), batch.column(width + 1).to_pylist())

    added = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    schema = T.StructType([*documents.schema.fields, *added])
    # Texts without repeats stay where they are; only the others are dealt out to meet their spans.
    alone = keyed.mapInArrow(cut_alone, schema)
    met = keyed.mapInArrow(to_meet, keyed.schema)
    met = met.join(spans, (F.col("_k1") == F.col("k1")) & (F.col("_k2") == F.col("k2")), "left")
    met = met.select(*columns, "spans", F.coalesce("whole", F.lit(False)).alias("whole")).mapInArrow(cut_met, schema)
    return alone.unionByName(met)
