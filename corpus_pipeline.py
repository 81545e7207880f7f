"""A pipeline from raw documents to packed sequences, stage after stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm import decontaminate, neardup, packing, secrets, toxicity
from corpusloom.llm.common import staged
from corpusloom.llm.queries import tokenizer_path
from corpusloom.sources.tables import read_table

#: Jaccard similarity, in percent, from which two documents of the near-dedup stage are near duplicates.
NEAR_PERCENT = 80

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; the model is fitted on labelled ones of them."""
    model = toxicity.fitted(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).filter("toxic_predicted = 0").select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate component, that of the least id; rows without an id take part as well."""
    return neardup.one_of_each(docs, percent=NEAR_PERCENT).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark")).filter("not contaminated").select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every found secret replaced by a mark and n_chars as the text is now."""
    found = secrets.findings(docs, secrets.scan(docs, "doc_id"))
    hit = F.size("secrets") > 0
    text = secrets.masked(F.col("text"), F.col("secrets"))
    return found.select(
        "doc_id", F.when(hit, text).otherwise(F.col("text")).alias("text"), "lang", "source",
        F.when(hit, F.length(text).cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences."""
    return packing.pack(docs, tokenizer_path()).withColumnRenamed("row", "doc_id")


STAGES = [
    ("toxicity", drop_toxic), ("near-dedup", one_of_each), ("decontamination", drop_contaminated), ("secrets", mask_secrets), ("packing", pack_sequences),
]

#: A trained model decides in the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
