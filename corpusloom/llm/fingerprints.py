"""I-Match document fingerprints over randomised lexicon subsets."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import KeyFilter, WordHashes, full_text, key_filter, mixed, row_batches, ship, staged

#: Lexicon subsets of each density, and neighbouring densities that a fingerprint holds.
SUBSETS, LEVELS = 16, 3


@dataclass
class Lexicon:
    """The terms whose document frequency lies in the band, as a filter of bounded size over their hashes."""

    terms: KeyFilter


def lexicon(documents: DataFrame, text: str = "text", least: int = 2, share: float = 0.05, flush: int = 1_500_000) -> Lexicon:
    """Terms in at least `least` documents and at most `share` of them (never fewer than `least`): the band of idf.

    Frequencies are counted over all documents by 32-bit hashes of terms, combined in each task before the shuffle.
    """
    ship(documents)

    def counted(batches):
        hashes, found, size = WordHashes(), [], 0

        def total():
            term, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
            return term, np.bincount(at, np.concatenate([f[1] for f in found])).astype(np.int64)

        def sent():
            term, n = total()
            return pa.RecordBatch.from_arrays([pa.array(term.view(np.int32)), pa.array(n)], ["term", "n"])

        for batch in row_batches(batches):
            sets = [terms_of(t, hashes) for t in batch.column(0).to_pylist()]
            term, n = np.unique((np.concatenate(sets) >> np.uint64(32)).astype(np.uint32), return_counts=True)
            found.append((term, n))
            size += len(term)
            if size > flush:
                found = [total()]
                size = len(found[0][0])
                if size > flush // 2:
                    yield sent()
                    found, size = [], 0
        if found:
            yield sent()

    total = documents.count()
    counts = documents.select(full_text(text).alias("text")).mapInArrow(counted, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    band = counts.filter(F.col("n").between(least, max(least, int(share * total)))).select(F.shiftleft(F.col("term").cast("bigint"), 32).alias("term"))
    return Lexicon(key_filter(staged(band), "term"))


def terms_of(text: str, hashes: WordHashes) -> np.ndarray:
    """Sorted different hashes of the words of a text, A-Z lower-cased."""
    return np.unique(hashes.of(text.encode().lower().split()))


class Fingerprinter:
    """Fingerprints of texts for one lexicon, as bytes.

    A subset of density 1 / 2^level keeps the terms whose hash, under the subset's own turn, is small enough. A text of m
    lexicon terms is hashed at the levels around log2(m), where a subset keeps about one of its terms, so that some
    subsets miss an edit. Byte 0 is the lowest level + 1, or 0 for a text without lexicon terms, which has the digest of
    all its words instead; then come 16 bits for each subset, 0 where it keeps none of the terms.
    """

    def __init__(self, known: Lexicon, most: int = 200_000):
        self.known, self.hashes = known, WordHashes(most=most)
        self.turns = mixed(np.arange(1, SUBSETS + 1, dtype=np.uint64))[:, None]

    def of(self, text: str) -> bytes:
        terms = terms_of(text, self.hashes)
        terms = terms[self.known.terms.passes(terms)]
        if not len(terms):
            return b"\0" + hashlib.sha256(b" ".join(text.encode().lower().split())).digest()[:16]
        level = max(0, int(round(np.log2(len(terms)))) - LEVELS // 2)
        place, value = mixed(terms[None, :] ^ self.turns), mixed(terms)
        parts = []
        for density in range(level, level + LEVELS):
            inside = place >> np.uint64(64 - density) == 0 if density else np.ones(place.shape, bool)
            total = (inside * value).sum(axis=1, dtype=np.uint64)
            parts.append(np.where(inside.any(axis=1), mixed(total) >> np.uint64(48) | np.uint64(1), 0).astype("<u2"))
        return bytes([level + 1]) + np.concatenate(parts).tobytes()


def likeness(one: bytes, two: bytes) -> float:
    """Share of equal hashes among the subsets of the levels both have in which either keeps a term; 0 to 1, 1 if equal."""
    if one == two:
        return 1.0
    if not one[0] or not two[0]:
        return 0.0
    first, second = (np.frombuffer(f[1:], "<u2").reshape(LEVELS, SUBSETS) for f in (one, two))
    shift = two[0] - one[0]
    if abs(shift) >= LEVELS:
        return 0.0
    first, second = first[max(0, shift):LEVELS + min(0, shift)], second[max(0, -shift):LEVELS - max(0, shift)]
    used = (first > 0) | (second > 0)
    return float(((first == second) & used).sum() / used.sum()) if used.any() else 0.0


def edited(text: str, other: str) -> str:
    """The last third (rounded down) of `text` replaced by as many first code points of `other`, or all of it."""
    third = len(text) // 3
    return text[:len(text) - third] + other[:third]


ROWS = "row bigint, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, part int, edge int, edge_text string"


def fingerprints_with_next(documents: DataFrame, known: Lexicon, row: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: n_chars, fingerprint, and how like it are the fingerprints of its edited text and of the next document.

    The next document is that of the next lower id, rows without an id last, and after the last comes the first; rows of
    equal ids go by a hash of their text; the only document is its own next. Texts meet their next in one range sort:
    each task walks its range, and the first and last row of each range, two per task, are put together after it. Null
    texts are empty. No documents give no rows.
    """
    ship(documents)
    rows = documents.select(F.col(row).cast("bigint").alias("row"), full_text(text).alias("text"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("row").desc_nulls_last(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def walked(batches):
        part = TaskContext.get().partitionId()
        make = Fingerprinter(known)
        last, first = None, True
        for batch in row_batches(batches):
            out = []
            for key, one in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mark = make.of(one)
                if first:
                    out.append((None, None, None, mark, None, None, None, part, 1, one))
                    first = False
                else:
                    out.append((*joined(last, one, mark, make), part, 0, None))
                last = (key, one, mark)
            yield table(out)
        if last:
            yield table([(last[0], None, None, last[2], None, None, None, part, 2, last[1])])

    staged_rows = staged(ranged.mapInArrow(walked, ROWS))
    edges = staged_rows.filter("edge > 0")
    # One number per range.
    used = sorted(r["part"] for r in edges.filter("edge = 1").select("part").collect())
    after = {p: used[(i + 1) % len(used)] for i, p in enumerate(used)}
    following = F.create_map(*[F.lit(v) for pair in after.items() for v in pair]) if after else F.create_map(F.lit(0), F.lit(0))
    ends = edges.filter("edge = 2").select(F.col("row").alias("k"), F.col("edge_text").alias("t"), F.col("fingerprint").alias("f"), following[F.col("part")].alias("next_part"))
    heads = edges.filter("edge = 1").select(F.col("part").alias("next_part"), F.col("edge_text").alias("nt"), F.col("fingerprint").alias("nf"))

    def closed(batches):
        make = Fingerprinter(known)
        for batch in row_batches(batches):
            columns = [c.to_pylist() for c in batch.columns]
            yield table([(*joined((k, t, f), nt, nf, make), 0, 0, None) for k, t, f, nt, nf in zip(*columns)])

    rest = ends.join(heads, "next_part").select("k", "t", "f", "nt", "nf").mapInArrow(closed, ROWS)
    return staged_rows.filter("edge = 0").unionByName(rest).drop("part", "edge", "edge_text")


def joined(last, following: str, mark: bytes, make: Fingerprinter) -> tuple:
    key, one, own = last
    changed = edited(one, following)
    other = make.of(changed)
    return key, len(one), hashlib.sha256(changed.encode()).hexdigest(), own, other, likeness(own, other), likeness(own, mark)


def table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.string()]
    names = [part.split()[0] for part in ROWS.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
