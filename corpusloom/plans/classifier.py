"""Tag classification of stored pages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.text import parse_ids
from corpusloom.operators.classify import Model, accuracy, class_scores, in_training, predict, top_classes, train
from corpusloom.operators.filters import present
from corpusloom.operators.tags import labelled_docs, tag_slice
from corpusloom.operators.weights import heaviest_terms
from corpusloom.plans.keywords import page_ids, page_weights
from corpusloom.session import cut
from corpusloom.sources.tables import Corpus


@dataclass
class Report:
    model: Model
    predictions: DataFrame
    best: DataFrame
    metrics: DataFrame


def report(
    weights: DataFrame, labels: DataFrame, vocabulary: Column | int, classes_shown: int = 2, doc: str = "doc_id",
    smoothing: float = fixed.SMOOTHING, share: float = 0.7, keep: Callable[[DataFrame], DataFrame] | None = None,
) -> Report:
    """Train on one part of the documents and test on the other; labels are (doc, class).

    `keep` writes the tables on the way, otherwise only the sums of the model are written, by `cut`.
    """
    learn = in_training(doc, share)
    model = train(weights.filter(learn), labels.filter(learn), vocabulary, smoothing, doc, keep or cut)
    tested = labels.filter(~learn)
    scores = class_scores(weights.filter(~learn).join(tested.select(doc).distinct(), doc, "left_semi"), model, doc, tested, keep)
    predictions = predict(scores, doc)
    return Report(
        model,
        predictions.join(tested, doc),
        top_classes(scores, classes_shown, doc),
        accuracy(predictions, tested, doc),
    )


def classify_tags(
    corpus: Corpus,
    roots: DataFrame,
    top_terms: int = fixed.TOP_TERMS,
    take: int = fixed.CLASS_LIMIT,
    min_count: int = fixed.CLASS_MIN_COUNT,
    skip: int = fixed.CLASS_SKIP,
) -> Report:
    """Naive Bayes from the heaviest terms of a page to its root tags. `roots` are (tag, root_tag) ids."""
    done = corpus.read("done")
    counts = corpus.read("tags").select(F.col("tagid").alias("tag"), "tagcount")
    # A few hundred rows that are used four times below.
    selected = cut(tag_slice(counts, take, min_count, skip))
    tagged = done.filter(present("tagids")).select("key", F.explode(parse_ids("tagids")).alias("tag"))
    labels = labelled_docs(tagged.withColumn("tag", F.col("tag").cast("bigint")), selected, roots, "key")
    labels = cut(labels.withColumnRenamed("tag", "class"))
    weights = cut(heaviest_terms(page_weights(done, labels), top_terms, "key"))
    vocabulary = page_ids(done).select(F.explode("ids").alias("term")).agg(F.countDistinct("term")).scalar()
    return report(weights, labels, vocabulary, 2, "key")
