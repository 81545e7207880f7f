"""A lexicon as an automaton in flat arrays, and cuts of many runs of letters at once.

The states are the beginnings of the terms, numbered by length and then in order, so that the states that follow one state
lie together. A state and a letter give one number; the sorted array of these numbers is the whole automaton, and the place
of a number in it is the state that the letter leads to.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: A letter takes this many bits of a number.
LETTER_BITS = 21
#: Shares are compared by their logarithms in millionths, whole numbers that add up the same in any order.
UNIT = 1_000_000
#: Letters that are cut at once.
SLICE = 200_000


def _letters(runs: list[str]) -> np.ndarray:
    return np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32).astype(np.int64)


@dataclass
class Automaton:
    """`edges`: state << LETTER_BITS | letter, sorted; edge i leads to state i + 1, the first state is 0. `freqs` and `kinds` of the states 1, 2, ...: NaN and -1 for no term."""

    edges: np.ndarray
    freqs: np.ndarray
    kinds: np.ndarray

    def found(self, letters: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, size, freq, kind) of all terms in the letters, shorter ones first; `left` tells how many letters a run has from each place on."""
        at, state = np.arange(len(letters)), np.zeros(len(letters), np.int64)
        parts, size = [], 0
        while len(at) and len(self.edges):
            number = state << LETTER_BITS | letters[at + size]
            edge = np.searchsorted(self.edges, number)
            known = self.edges[np.minimum(edge, len(self.edges) - 1)] == number
            at, edge = at[known], edge[known]
            size += 1
            word = ~np.isnan(self.freqs[edge])
            parts.append((at[word], np.full(word.sum(), size), self.freqs[edge[word]], self.kinds[edge[word]]))
            more = left[at] > size
            at, state = at[more], edge[more] + 1
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        return tuple(map(np.concatenate, zip(none, *parts)))


def shipped(lexicon: DataFrame) -> tuple[str, list[str]]:
    """The name of a file that every executor gets, for `loaded`, and the classes of the terms. `lexicon(term, termtype, freq)` has one row per term.

    Spark makes the states and puts them in order; the driver only lines their columns up. The caller has checked the size.
    """
    beginnings = lexicon.select("term", "termtype", "freq", F.explode(F.sequence(F.lit(1), F.length("term"))).alias("n"))
    whole = F.col("n") == F.length("term")
    states = beginnings.select(
        "n", F.substr("term", F.lit(1), F.col("n")).alias("state"), F.when(~whole, F.substr("term", F.col("n") + 1, F.lit(1))).alias("next"),
        F.when(whole, F.col("freq").cast("double")).alias("freq"), F.when(whole, F.col("termtype")).alias("termtype"),
    ).groupBy("n", "state").agg(F.size(F.collect_set("next")).alias("following"), F.max("freq").alias("freq"), F.max("termtype").alias("termtype"))
    rows = states.orderBy("n", "state").select("n", F.right("state", F.lit(1)).alias("letter"), "following", "freq", "termtype").toArrow()
    starts = int(np.sum(rows["n"].to_numpy() == 1))
    following = np.r_[starts, rows["following"].to_numpy()].astype(np.int64)
    edges = np.repeat(np.arange(len(following), dtype=np.int64), following) << LETTER_BITS | _letters(rows["letter"].to_pylist())
    kinds = pa.chunked_array(rows["termtype"]).combine_chunks().dictionary_encode() if rows.num_rows else pa.array([], pa.string()).dictionary_encode()
    number = np.array(kinds.indices.fill_null(-1), np.int64)
    freqs = rows["freq"].to_numpy().astype(np.float64)
    folder = tempfile.mkdtemp(prefix="corpusloom-")
    path = os.path.join(folder, f"lexicon-{uuid.uuid4().hex}.npy")
    np.save(path, np.stack([edges, freqs.view(np.int64), number]) if len(edges) else np.zeros((3, 0), np.int64))
    # The driver serves the file; each executor has one copy, which its workers map.
    lexicon.sparkSession.sparkContext.addFile(path)
    return os.path.basename(path), kinds.dictionary.to_pylist()


@lru_cache(2)
def loaded(name: str) -> Automaton:
    """The automaton of a shipped file, whose pages the workers of one executor share."""
    from pyspark import SparkFiles

    rows = np.load(SparkFiles.get(name), mmap_mode="r")
    return Automaton(rows[0], rows[1].view(np.float64), rows[2])


def longest(starts: np.ndarray, sizes: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each place the size of the longest term that starts there, 1 where none does. Terms come shorter ones first."""
    best = np.ones(len(left), np.int64)
    best[starts] = sizes
    return best


def weights(freqs: np.ndarray, total: float) -> np.ndarray:
    """Logarithms of the shares of words; one that was never seen counts half a time."""
    return np.rint(np.log(np.where(np.isnan(freqs) | (freqs == 0), 0.5, freqs) / total) * UNIT).astype(np.int64)


def likeliest(starts: np.ndarray, sizes: np.ndarray, freqs: np.ndarray, left: np.ndarray, total: float) -> np.ndarray:
    """For each place the size of the first word of the likeliest cut of the rest of its run, the longest of equally likely ones.

    A letter that is no term counts as a word seen half a time. Places with equally many letters left are decided together.
    """
    known = np.zeros(len(left), bool)
    known[starts[sizes == 1]] = True
    alone = np.flatnonzero(~known)
    starts = np.concatenate([starts, alone])
    sizes = np.concatenate([sizes, np.ones(len(alone), np.int64)])
    weight = weights(np.concatenate([freqs, np.zeros(len(alone))]), total)
    order = np.lexsort((sizes, starts, left[starts]))
    starts, sizes, weight = starts[order], sizes[order], weight[order]
    bounds = np.searchsorted(left[starts], np.arange(1, (left.max() if len(left) else 0) + 2))
    best, size = np.zeros(len(left) + 1, np.int64), np.ones(len(left), np.int64)
    for rest, (a, b) in enumerate(zip(bounds, bounds[1:]), 1):
        s, z = starts[a:b], sizes[a:b]
        if not len(s):
            continue
        score = weight[a:b] + np.where(z == rest, 0, best[s + z])
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        top = np.maximum.reduceat(score, first)
        best[s[first]] = top
        equal = score == np.repeat(top, np.diff(np.r_[first, len(s)]))
        # Sizes rise within a place, so the longest of the best ones stays.
        size[s[equal]] = z[equal]
    return size


def words(runs: list[str], size: np.ndarray, left: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, offsets) of the words when every place leads on by its size; offsets tell where the words of each run begin."""
    ends = np.cumsum(lengths)
    at = (ends - lengths)[lengths > 0]
    mark = np.zeros(len(left), bool)
    while len(at):
        mark[at] = True
        at = (at + size[at])[size[at] < left[at]]
    starts = np.flatnonzero(mark)
    return starts, np.r_[0, np.searchsorted(starts, ends)]


def left_of(lengths: np.ndarray) -> np.ndarray:
    """How many letters each run has from each place on, for runs that lie one behind the other."""
    return np.repeat(np.cumsum(lengths), lengths) - np.arange(int(lengths.sum()))


def cut_runs(runs: list[str], find, method: str, total: float, kinds: list[str]) -> tuple[pa.Array, pa.Array]:
    """Words of each run and their classes, as arrays of lists. `find(a, b, letters, left)` gives the terms in the runs from a to b."""
    terms, classes, counts = [], [], [0]
    lengths = np.array([len(r) for r in runs], np.int64)
    ends = np.cumsum(lengths)
    a = 0
    while a < len(runs):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE, "right")))
        part, size_of = runs[a:b], lengths[a:b]
        left = left_of(size_of)
        starts, sizes, freqs, kind = find(a, b, _letters(part), left)
        size = longest(starts, sizes, left) if method == "longest" else likeliest(starts, sizes, freqs, left, total)
        chosen = np.full(len(left), -1, np.int64)
        used = size[starts] == sizes
        chosen[starts[used]] = kind[used]
        at, offsets = words(part, size, left, size_of)
        text = "".join(part)
        terms.extend(text[s:s + n] for s, n in zip(at.tolist(), size[at].tolist()))
        classes.append(chosen[at])
        counts.extend((counts[-1] + offsets[1:]).tolist())
        a = b
    number = np.concatenate([np.zeros(0, np.int64), *classes])
    names = pa.array([*kinds, None], pa.string()).take(pa.array(np.where(number < 0, len(kinds), number)))
    offsets = pa.array(counts, pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(terms, pa.string())), pa.ListArray.from_arrays(offsets, names)
