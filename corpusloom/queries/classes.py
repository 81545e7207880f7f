"""Class slices, labelled documents and Naive Bayes over `documents` and `labels`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.operators import classify, tags, weights as w
from corpusloom.plans.classifier import Report, report
from corpusloom.queries.terms import TAGS, WEIGHTS, documents, tagged
from corpusloom.session import cut, scratch

TOP = 200


def weighed(spark, folder) -> tuple[DataFrame, Column]:
    """The heaviest terms of each document, packed, and the size of the vocabulary, both from one table of document frequencies."""
    docs = documents(spark, folder)
    idfs = w.corpus_idf(docs)
    return cut(w.heaviest_of(docs, idfs, TOP)), classify.vocabulary_size(idfs)


def languages(spark, folder) -> DataFrame:
    return documents(spark, folder, "lang").withColumnRenamed("lang", "class")


def language_report(spark, folder) -> Report:
    """Language of a document from its heaviest terms."""
    heaviest, vocabulary = weighed(spark, folder)
    return report(heaviest, languages(spark, folder), vocabulary)


def selected(spark, folder) -> DataFrame:
    """Tags of at least 10 documents without the most frequent one, at most 12."""
    return tags.tag_slice(tags.tag_counts(tagged(spark, folder)), 12, 10, 1)


def roots(spark, folder) -> DataFrame:
    """Sources whose number has two digits belong under the one named by the first digit; `0` stands for no root."""
    own = tagged(spark, folder).select("tag").distinct()
    first = F.regexp_extract("tag", r"^(source=src\d)\d$", 1)
    return own.withColumn("root_tag", F.when(first != "", first).otherwise("0"))


def tag_slice(spark, folder):
    return selected(spark, folder)


def tag_roots(spark, folder):
    return tags.root_tags(tagged(spark, folder), selected(spark, folder), roots(spark, folder))


def labelled_docs(spark, folder):
    return tags.labelled_docs(tagged(spark, folder), cut(selected(spark, folder)), roots(spark, folder))


def split_docs(spark, folder):
    docs = documents(spark, folder, "lang")
    return docs.select("doc_id", classify.in_training("doc_id").cast("int").alias("train"))


def nb_prior(spark, folder):
    classes = language_report(spark, folder).model.classes
    return classes.select("class", "n", F.round("pi", 6).alias("pi"), F.round("base", 6).alias("base"))


def nb_model(spark, folder):
    terms = language_report(spark, folder).model.terms
    return terms.select("class", "term", F.round("theta", 6).alias("theta"))


def _scores(spark, folder) -> DataFrame:
    (all_weights, vocabulary), labels = weighed(spark, folder), languages(spark, folder)
    learn = classify.in_training("doc_id")
    model = classify.train(all_weights.filter(learn), labels.filter(learn), vocabulary)
    return classify.class_scores(all_weights.filter(~learn), model, documents=labels.filter(~learn))


def nb_scores(spark, folder):
    return classify.score_rows(_scores(spark, folder)).withColumn("score", F.round("score", 4))


def nb_predict(spark, folder):
    return language_report(spark, folder).predictions.select("doc_id", "predicted", "class")


def nb_top2(spark, folder):
    return language_report(spark, folder).best.withColumn("score", F.round("score", 4))


def nb_accuracy(spark, folder):
    return language_report(spark, folder).metrics.withColumn("accuracy", F.round("accuracy", 6))


def tag_classifier(spark, folder):
    """Best two tags of each test document, learnt from documents with several tags."""
    labels = tags.labelled_docs(tagged(spark, folder), cut(selected(spark, folder)), roots(spark, folder))
    labels = cut(labels.withColumnRenamed("tag", "class"))
    docs = documents(spark, folder)
    with scratch(spark) as keep:
        idfs = w.corpus_idf(docs, keep=keep)
        with scratch(spark) as passing:
            own = keep(w.heaviest_of(docs, idfs, TOP, keep=passing, wanted=labels.select("doc_id").distinct()))
        best = report(own, labels, classify.vocabulary_size(idfs), keep=keep).best
        return cut(best.withColumn("score", F.round("score", 4)))


SELECTED = f"""{TAGS}, selected AS (SELECT tag, count(*) AS tagcount FROM tagged GROUP BY tag HAVING count(*) >= 10
    ORDER BY tagcount DESC, tag LIMIT 12 OFFSET 1)"""
ROOTED = f"""{SELECTED}, rooted AS (SELECT doc_id, CASE WHEN tag IN (SELECT tag FROM selected) AND regexp_matches(tag, '^source=src[0-9][0-9]$')
    THEN substr(tag, 1, length(tag) - 1) ELSE tag END AS tag FROM tagged)"""
LABELLED = f"{ROOTED}, labels_of AS (SELECT DISTINCT doc_id, tag AS class FROM rooted WHERE tag IN (SELECT tag FROM selected))"
LANGUAGES = "labels_of AS (SELECT doc_id, lang AS class FROM documents)"
TRAIN = "substr(md5(CAST(doc_id AS VARCHAR)), 1, 4) < 'b333'"
MODEL = f"""{WEIGHTS}, top AS (SELECT doc_id, term, w FROM weights
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, term) <= {TOP}),
    v AS (SELECT count(DISTINCT term) AS v FROM tf),
    train AS (SELECT * FROM labels_of WHERE {TRAIN}), test AS (SELECT * FROM labels_of WHERE NOT {TRAIN}),
    sums AS (SELECT class, term, sum(w) AS s FROM train JOIN top USING (doc_id) GROUP BY 1, 2),
    classes AS (SELECT class, n, ln((n + 1.0) / (sum(n) OVER () + count(*) OVER ())) AS pi, -ln(coalesce(total, 0) + v) AS base
        FROM (SELECT class, count(*) AS n FROM train GROUP BY class) LEFT JOIN (SELECT class, sum(s) AS total FROM sums GROUP BY class)
        USING (class), v),
    docs AS (SELECT doc_id, coalesce(sum(w), 0) AS w FROM (SELECT DISTINCT doc_id FROM test) LEFT JOIN top USING (doc_id) GROUP BY doc_id),
    gains AS (SELECT doc_id, class, sum(w * ln(s + 1.0)) AS gain FROM top JOIN sums USING (term)
        WHERE doc_id IN (SELECT doc_id FROM test) GROUP BY 1, 2),
    scores AS (SELECT doc_id, class, pi + base * w + coalesce(gain, 0) AS score
        FROM (SELECT * FROM docs CROSS JOIN classes) LEFT JOIN gains USING (doc_id, class)),
    ranked AS (SELECT doc_id, class, score, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, class) AS INTEGER) AS rank FROM scores)"""
LANGUAGE_MODEL = f"WITH {LANGUAGES}, {MODEL}"
BEST = "SELECT doc_id, rank, class, round(score, 4) AS score FROM ranked WHERE rank <= 2"

QUERIES = {
    "tag_slice": (tag_slice, f"WITH {SELECTED} SELECT tag, tagcount FROM selected"),
    "tag_roots": (tag_roots, f"WITH {ROOTED} SELECT doc_id, tag FROM rooted"),
    "labelled_docs": (labelled_docs, f"WITH {LABELLED} SELECT doc_id, class AS tag FROM labels_of"),
    "split_docs": (split_docs, f"SELECT doc_id, CAST({TRAIN} AS INTEGER) AS train FROM documents"),
    "nb_prior": (nb_prior, f"{LANGUAGE_MODEL} SELECT class, n, round(pi, 6) AS pi, round(base, 6) AS base FROM classes"),
    "nb_model": (nb_model, f"{LANGUAGE_MODEL} SELECT class, term, round(base + ln(s + 1.0), 6) AS theta FROM sums JOIN classes USING (class)"),
    "nb_scores": (nb_scores, f"{LANGUAGE_MODEL} SELECT doc_id, class, round(score, 4) AS score FROM scores"),
    "nb_predict": (nb_predict, f"""{LANGUAGE_MODEL} SELECT doc_id, ranked.class AS predicted, test.class AS class
        FROM ranked JOIN test USING (doc_id) WHERE rank = 1"""),
    "nb_top2": (nb_top2, f"{LANGUAGE_MODEL} {BEST}"),
    "nb_accuracy": (nb_accuracy, f"""{LANGUAGE_MODEL} SELECT count(*) AS n, round(avg(CAST(ranked.class = test.class AS DOUBLE)), 6) AS accuracy
        FROM ranked JOIN test USING (doc_id) WHERE rank = 1"""),
    "tag_classifier": (tag_classifier, f"WITH {LABELLED}, {MODEL} {BEST}"),
}
