"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusloom.llm.common import guarded, row_batches, runs_of, ship

#: Labelled rows of the classes 0 and 1 that a model is fitted on at most.
SAMPLE = (3_000, 1_500)


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18
    #: Lengths of the n-grams: a word with one changed letter keeps some of the short ones.
    grams: tuple[int, ...] = (3, 4, 5, 6)
    size: int = 2
    epochs: int = 120
    rate: float = 0.05
    scale: float = 100.0
    decay: float = 1e-4


#: Multiplier of the rolling hash of n-grams.
FACTOR = 0x9E3779B97F4A7C15
#: Words whose n-grams are held at once, and characters of the texts that are rated together; a longer text goes alone.
WORDS_AT_ONCE = 20_000
CHARACTERS_AT_ONCE = 1 << 18


def gram_buckets(words: list[str], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of words, buckets) of the character n-grams of all words, one pair of arrays for each length.

    The ends of a word are marked; a word shorter than all n-grams is one gram. All words are hashed together.
    """
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lengths)
    owners = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    left = np.repeat(ends, lengths) - np.arange(len(codes))
    least = min(settings.grams)
    for n in sorted({*settings.grams, *lengths[lengths < least].tolist()}):
        hashes = runs_of(codes, n, FACTOR)
        if n < least:
            at = (ends - lengths)[lengths == n]
        else:
            at = np.flatnonzero(left[:len(hashes)] >= n)
        yield owners[at], (hashes[at] % np.uint64(settings.buckets)).astype(np.int32)


def pieces_of(items: Iterable, size: Callable[[object], int], most: int) -> Iterator[list]:
    """The items in their order, in lists of a total size up to `most`, or of one item."""
    held, total = [], 0
    for item in items:
        if held and total + size(item) > most:
            yield held
            held, total = [], 0
        held.append(item)
        total += size(item)
    if held:
        yield held


@dataclass
class ToxicityModel:
    """What is left of the embeddings and the softmax when only the score is asked for: both are linear up to it.

    `weights` has the difference of the two logits for each bucket (1 MB), `bias` that of an empty text.
    """

    weights: np.ndarray
    bias: float
    settings: Settings

    def word_logits(self, words: list[str]) -> np.ndarray:
        """The mean weight of the n-grams of each word; what other words are asked for changes nothing."""
        total, count = np.zeros(len(words)), np.zeros(len(words))
        for owners, buckets in gram_buckets(words, self.settings):
            total += np.bincount(owners, self.weights[buckets], len(words))
            count += np.bincount(owners, minlength=len(words))
        return total / count

    def scorer(self, most: int = 300_000) -> Callable[[list[str]], list[float]]:
        """A function from texts to scores that remembers about `most` words."""
        known: dict[str, float] = {}

        def learn(texts: list[list[str]]) -> None:
            new = set().union(*texts).difference(known)
            if len(known) + len(new) > most:
                known.clear()
                new = set().union(*texts)
            new = list(new)
            for start in range(0, len(new), WORDS_AT_ONCE):
                some = new[start:start + WORDS_AT_ONCE]
                known.update(zip(some, self.word_logits(some).tolist()))

        def logit(words: list[str]) -> float:
            return self.bias + (self.settings.scale * sum(map(known.__getitem__, words)) / len(words) if words else 0.0)

        def scores(texts: list[str]) -> list[float]:
            found = []
            for some in pieces_of(texts, len, CHARACTERS_AT_ONCE):
                split = [text.lower().split() for text in some]
                learn(split)
                found.extend(map(logit, split))
            return (1 / (1 + np.exp(-np.clip(found, -500, 500)))).tolist()

        return scores


class _Bag:
    """A sparse matrix whose rows are weighted bags of columns, and its transpose, as runs for reduceat."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, weights: np.ndarray, height: int, width: int):
        self.height, self.width = height, width
        self.forward, self.back = self._runs(rows, columns, weights), self._runs(columns, rows, weights)

    @staticmethod
    def _runs(keys, others, weights):
        order = np.argsort(keys, kind="stable").astype(np.int32)
        keys = keys[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        return keys[starts], starts, others[order], weights[order].astype(np.float32)

    @staticmethod
    def _times(runs, values, height):
        """One column after the other, each contiguous: `values` has a row per dimension."""
        at, starts, others, weights = runs
        out = np.zeros((len(values), height), np.float32)
        for i, one in enumerate(values):
            out[i, at] = np.add.reduceat(one[others] * weights, starts)
        return out

    def times(self, values):
        return self._times(self.forward, values, self.height)

    def transposed_times(self, values):
        return self._times(self.back, values, self.width)


def train(texts: list[str], toxic: np.ndarray, settings: Settings = Settings()) -> ToxicityModel:
    """Fit bucket vectors and softmax together by full-batch Adam on whole texts; a text's vector is the mean of its
    words' vectors, a word's that of its n-grams. Without both classes the score is the share of toxic labels.

    In the second half the rate falls to nothing: at a constant one the loss leaps up once it is small, and the last step is any of those.
    """
    share = float(np.mean(toxic)) if len(toxic) else 0.0
    vocabulary: dict[str, int] = {}
    doc, word, weight = [], [], []
    for at, text in enumerate(texts):
        words = text.lower().split()
        codes, counts = np.unique([vocabulary.setdefault(w, len(vocabulary)) for w in words], return_counts=True)
        doc.append(np.full(len(codes), at, np.int32))
        word.append(codes.astype(np.int32))
        weight.append((counts / max(1, len(words)) * settings.scale).astype(np.float32))
    if not vocabulary or share in (0.0, 1.0):
        odds = np.log((share + 1e-9) / (1 - share + 1e-9))
        return ToxicityModel(np.zeros(settings.buckets, np.float32), float(odds), settings)
    # Plain 4-byte numbers: this runs in the driver, and lists of the n-grams would take ten times the room.
    words, pairs = list(vocabulary), (array("i"), array("i"))
    for start in range(0, len(words), WORDS_AT_ONCE):
        for owners, buckets in gram_buckets(words[start:start + WORDS_AT_ONCE], settings):
            pairs[0].frombytes((owners + np.int32(start)).tobytes())
            pairs[1].frombytes(buckets.tobytes())
    owners, columns = (np.frombuffer(numbers, np.int32) for numbers in pairs)
    lengths = np.bincount(owners, minlength=len(words))
    del words, pairs
    grams = _Bag(owners, columns, (1 / lengths).astype(np.float32)[owners], len(lengths), settings.buckets)
    docs = _Bag(np.concatenate(doc), np.concatenate(word), np.concatenate(weight), len(texts), len(lengths))
    del owners, columns, doc, word, weight
    rng = np.random.default_rng(7)
    state = {
        "vectors": rng.normal(0, 0.05, (settings.size, settings.buckets)).astype(np.float32),
        "softmax": rng.normal(0, 0.5, (settings.size, 2)).astype(np.float32), "bias": np.zeros(2, np.float32),
    }
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in state.items()}
    goal = np.eye(2, dtype=np.float32)[toxic.astype(int)]
    for step in range(1, settings.epochs + 1):
        rate = settings.rate * min(1, 2 * (1 - (step - 1) / settings.epochs))
        means = docs.times(grams.times(state["vectors"])).T
        logits = means @ state["softmax"] + state["bias"]
        share_of = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = (share_of / share_of.sum(axis=1, keepdims=True) - goal) / len(texts)
        slope = {
            "softmax": means.T @ error, "bias": error.sum(axis=0),
            "vectors": grams.transposed_times(docs.transposed_times(np.ascontiguousarray((error @ state["softmax"].T).T))) + settings.decay * state["vectors"],
        }
        for name, g in slope.items():
            first, second = moment[name]
            first += 0.1 * (g - first)
            second += 0.001 * (g * g - second)
            state[name] -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    ahead = state["softmax"][:, 1] - state["softmax"][:, 0]
    return ToxicityModel(ahead @ state["vectors"], float(state["bias"][1] - state["bias"][0]), settings)

OUTPUTS = ["toxic_score", "toxic_predicted"]


def held_out(row: str = "doc_id") -> Column:
    """Rows whose labels are never learned from; a row without an id has none."""
    return F.coalesce(F.pmod(F.crc32(F.col(row).cast("string")), F.lit(3)) == 1, F.lit(True))


def fitted(documents: DataFrame, labels: DataFrame, row: str = "doc_id", text: str = "text", label: str = "toxic", most: tuple[int, int] = SAMPLE, settings: Settings = Settings()) -> ToxicityModel:
    """A model of at most `most` labelled documents of the classes 0 and 1, those first by a hash of their id.

    Of several labels of an id the highest counts, of several texts the least; labels without an id or value, and held-out ids, are left out.
    """
    usable = labels.filter(F.col(row).isNotNull() & F.col(label).isNotNull() & ~held_out(row)).groupBy(row).agg(F.max(label).cast("int").alias("_label"))
    order = [F.xxhash64(row), F.col(row)]
    chosen = usable.filter("_label = 0").orderBy(*order).limit(most[0]).unionByName(usable.filter("_label = 1").orderBy(*order).limit(most[1]))
    # At most sum(most) small rows, and then as many texts, which meet in a task: training takes several times their room.
    marks = chosen.collect()
    if not marks:
        return train([], np.array([]), settings)
    marked = documents.sparkSession.createDataFrame(marks, chosen.schema)
    texts = documents.filter(F.col(row).isin([r[row] for r in marks])).select(F.col(row).alias("row"), F.col(text).alias("text"))
    labelled = texts.join(F.broadcast(marked.withColumnRenamed(row, "row")), "row").groupBy("row").agg(F.min("text").alias("text"), F.max("_label").alias("label"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for batch in batches for r in zip(*[c.to_pylist() for c in batch.columns])), key=lambda r: r[0])
        model = train([r[1] or "" for r in rows], np.array([r[2] for r in rows]), settings)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.astype(np.float32).tobytes()]), pa.array([model.bias])], ["weights", "bias"])

    found = ship(labelled.repartition(1)).mapInArrow(fit, "weights binary, bias double").collect()
    # Labelled ids that no document has leave nothing to learn from.
    if not found:
        return train([], np.array([]), settings)
    return ToxicityModel(np.frombuffer(found[0]["weights"], np.float32), found[0]["bias"], settings)


def scored(documents: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """All rows and columns of `documents` with toxic_score (0 to 1) and toxic_predicted (1 from `threshold` on).

    The whole text alone decides; a null or empty text scores as the bias does, equal texts score the same, and no
    documents give no rows.
    """
    return guarded(documents, OUTPUTS, lambda rows, name: _scored(rows, model, name(text), threshold))


def _scored(documents: DataFrame, model: ToxicityModel, text: str, threshold: float) -> DataFrame:
    width, place = len(documents.columns), documents.columns.index(text)
    names = [*documents.columns, "toxic_score", "toxic_predicted"]

    def rate(batches):
        score = model.scorer()
        for batch in row_batches(batches):
            values = np.array(score(["" if one is None else str(one) for one in batch.column(place).to_pylist()]), np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(values), pa.array((values >= threshold).astype(np.int32))], names)

    added = [T.StructField("toxic_score", T.DoubleType()), T.StructField("toxic_predicted", T.IntegerType())]
    return ship(documents).mapInArrow(rate, T.StructType([*documents.schema.fields, *added]))
