"""Multinomial Naive Bayes over long (doc, term, w) tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.keys import _col
from corpusloom.operators.joins import spread_join
from corpusloom.operators.weights import unpacked
from corpusloom.session import cut


@dataclass
class Model:
    """`classes(class, n, pi, base)` has a row per class, `terms(class, term, s, theta, gain)` per class and seen term.

    A term that a class never saw has theta = `base`; `gain` is theta - base.
    """

    classes: DataFrame
    terms: DataFrame


def in_training(doc: Column | str, share: float = 0.7) -> Column:
    """Repeatable split by document: an even hash below the share."""
    limit = format(int(share * 0x10000), "04x")
    return F.substring(F.md5(_col(doc).cast("string")), 1, 4) < limit


def split_rows(rows: DataFrame, share: float = 0.7, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """Random split by row. A document with two labels may fall on both sides."""
    train, test = rows.randomSplit([share, 1 - share], seed)
    return train, test


def vocabulary_size(idfs: DataFrame) -> Column:
    """Number of distinct terms of the corpus, as a scalar subquery."""
    return idfs.agg(F.count("*")).scalar()


def train(
    weights: DataFrame, labels: DataFrame, vocabulary: Column | int, smoothing: float = fixed.SMOOTHING, doc: str = "doc_id",
    keep: Callable[[DataFrame], DataFrame] = cut,
) -> Model:
    """Class priors and term likelihoods of labelled documents; labels are (doc, class). Weights are (doc, term, w), or packed.

    Packed weights of a document meet its classes as one row. The sums, one row per class and term, are written by `keep` for their uses.
    """
    vocabulary = F.lit(vocabulary) if isinstance(vocabulary, int) else vocabulary
    if "terms" in weights.columns:
        pairs = weights.select(doc, F.transform("terms", lambda t: F.struct(t["term"], t["w"])).alias("terms"))
        met = labels.select(doc, "class").join(pairs, doc).select("class", F.inline("terms"))
    else:
        met = labels.select(doc, "class").join(weights.select(doc, "term", "w"), doc)
    sums = keep(met.groupBy("class", "term").agg(F.sum("w").alias("s")))
    totals = sums.groupBy("class").agg(F.sum("s").alias("total"))
    counts = labels.groupBy("class").agg(F.count("*").alias("n"))
    documents, kinds = labels.agg(F.count("*")).scalar(), labels.agg(F.countDistinct("class")).scalar()
    classes = (
        counts.join(totals, "class", "left")
        .withColumn("pi", F.ln((F.col("n") + smoothing) / (documents + kinds * smoothing)))
        .withColumn("base", F.ln(F.lit(smoothing)) - F.ln(F.coalesce(F.col("total"), F.lit(0.0)) + vocabulary * smoothing))
        .select("class", "n", "pi", "base")
    )
    gain = F.ln(F.col("s") + smoothing) - F.ln(F.lit(smoothing))
    terms = sums.withColumn("gain", gain).join(classes.select("class", "base"), "class")
    return Model(classes, terms.select("class", "term", "s", (F.col("base") + F.col("gain")).alias("theta"), "gain"))


def class_scores(
    weights: DataFrame, model: Model, doc: str = "doc_id", documents: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(doc, scores): for each document an array of (score, class), the unnormalised log joint of each class.

    The documents are those of `documents`, or else those with terms; one without terms scores by the priors alone.

    score = pi + base * W + sum of w * gain over the terms that the class has seen, W the sum of all w of the document.
    Rows meet the model by term. A term brings one vector of its gains, an element for each class in their order, and the
    vectors of a document are summed element by element in one aggregate: a row stays one row however many classes there are.
    The names of the classes are read by the driver; `tags.tag_slice` bounds them. `keep` writes the rows, their counts by
    term and the vectors, so that what was shuffled for them need not lie beside what the join shuffles.
    """
    named = model.classes.select("class").distinct().orderBy("class").collect()
    kind = model.classes.schema["class"].dataType
    names = F.array(*[F.lit(row["class"]).cast(kind) for row in named])
    seen = F.map_from_entries(F.collect_list(F.struct("class", "gain")))
    vectors = model.terms.groupBy("term").agg(seen.alias("_seen")).select(
        "term", F.transform(names, lambda c: F.coalesce(F.try_element_at("_seen", c), F.lit(0.0))).alias("gains")
    )
    facts, counts = unpacked(weights).select(doc, "term", "w"), None
    if keep:
        facts, vectors = keep(facts), keep(vectors)
        counts = keep(facts.groupBy("term").agg(F.count("*").alias("n")))
    met = spread_join(facts, vectors, "term", "left", counts)
    parts = [F.sum(F.col("w") * F.coalesce(F.get("gains", F.lit(i)), F.lit(0.0))).alias(f"_part{i}") for i in range(len(named))]
    sums = met.groupBy(doc).agg(F.sum("w").alias("_all"), *parts)
    part = F.array(*[f"_part{i}" for i in range(len(named))]).cast("array<double>")
    per_doc = sums.select(doc, "_all", part.alias("_parts"))
    if documents is not None:
        per_doc = documents.select(doc).distinct().join(per_doc, doc, "left").withColumn("_all", F.coalesce("_all", F.lit(0.0)))
    classes = model.classes.agg(F.sort_array(F.collect_list(F.struct("class", "pi", "base")))).scalar()
    scores = F.transform(
        F.col("_classes"),
        lambda c, i: F.struct(
            (c["pi"] + c["base"] * F.col("_all") + F.coalesce(F.get("_parts", i), F.lit(0.0))).alias("score"),
            c["class"].alias("class"),
        ),
    )
    return per_doc.withColumn("_classes", classes).select(doc, scores.alias("scores"))


def score_rows(scores: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, class, score)."""
    return scores.select(doc, F.explode("scores").alias("s")).select(doc, "s.class", "s.score")


def top_classes(scores: DataFrame, n: int, doc: str = "doc_id") -> DataFrame:
    """(doc, rank, class, score): the `n` best classes of each document; equal scores go by class."""
    ordered = F.array_sort(
        F.col("scores"),
        lambda a, b: F.when(a["score"] > b["score"], -1)
        .when(a["score"] < b["score"], 1)
        .when(a["class"] < b["class"], -1)
        .when(a["class"] > b["class"], 1)
        .otherwise(0),
    )
    best = scores.select(doc, F.posexplode(F.slice(ordered, 1, n)).alias("rank", "s"))
    return best.select(doc, (F.col("rank") + 1).alias("rank"), "s.class", "s.score")


def predict(scores: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, predicted): the best class of each document."""
    return top_classes(scores, 1, doc).select(doc, F.col("class").alias("predicted"))


def accuracy(predictions: DataFrame, labels: DataFrame, doc: str = "doc_id") -> DataFrame:
    """One row (n, accuracy) over labelled documents; null when there are none."""
    right = (F.col("predicted") == F.col("class")).cast("double")
    return predictions.join(labels, doc).agg(F.count("*").alias("n"), F.avg(right).alias("accuracy"))
