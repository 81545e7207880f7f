"""Term counters that follow a stream of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.text import words
from corpusloom.operators.upserts import add_counts
from corpusloom.sources.tables import Corpus

COUNTS = "term string, n bigint"


def arriving(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the Parquet files of a folder, whatever its name ends in, or of one file."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    folder, _, last = path.rstrip("/").rpartition("/")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if last.endswith(".parquet") and not (files.exists(place) and files.getFileStatus(place).isDirectory()):
        return reader.option("pathGlobFilter", last).parquet(folder)
    return reader.parquet(path)


def running_counts(docs: DataFrame, terms: Column | None = None) -> DataFrame:
    """(term, termfreq) as a streaming aggregation; its state holds the whole vocabulary, spread over the partitions."""
    terms = words("text") if terms is None else terms
    return docs.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("termfreq"))


def keep_totals(
    docs: DataFrame, folder: str, checkpoint: str, terms: Column | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Start a query that keeps running totals: each batch writes the terms whose total it changed, to a version of its own.

    The totals are the state of the stream, so a version holds as many rows as the batch has terms, and no batch reads the
    versions before it. A batch that is run again after a failure has the same number and replaces its version.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/v={number}")

    writer = running_counts(docs, terms).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def kept_totals(spark: SparkSession, folder: str, upto: int | None = None) -> DataFrame:
    """(term, termfreq) after the last version, or after the version `upto`: of each term the row of its last version."""
    rows = spark.read.schema("term string, termfreq bigint, v bigint").option("basePath", folder).parquet(folder)
    rows = rows if upto is None else rows.filter(F.col("v") <= upto)
    return rows.groupBy("term").agg(F.max_by("termfreq", "v").alias("termfreq"))


def fold_totals(spark: SparkSession, folder: str, into: str, upto: int) -> DataFrame:
    """Write the totals after version `upto` and all later versions to the folder `into`, which then replaces `folder` for readers.

    The folded versions become one row per term, so that reading does not cost more with every batch. A stream that goes on
    is started with the same checkpoint and the new folder.
    """
    kept_totals(spark, folder, upto).write.mode("overwrite").parquet(f"{into}/v={upto}")
    later = spark.read.schema("term string, termfreq bigint, v bigint").option("basePath", folder).parquet(folder).filter(F.col("v") > upto)
    later.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("v").parquet(into)
    return kept_totals(spark, into)


def log_counts(
    docs: DataFrame, log: str, checkpoint: str, terms: Column | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Start a query that writes the term counts of each batch to its own part of `log`.

    A batch that is run again after a failure replaces its part, so nothing is counted twice, and a batch costs as much
    as its own documents have terms, however large the vocabulary is.
    """
    terms = words("text") if terms is None else terms

    def write(batch: DataFrame, number: int) -> None:
        counts = batch.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
        counts.write.mode("overwrite").parquet(f"{log}/batch={number}")

    writer = docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def logged_counts(spark: SparkSession, log: str, after: int = -1, upto: int | None = None) -> DataFrame:
    """(term, n) of the batches `after` < batch <= `upto`, one row per term and batch."""
    rows = spark.read.schema(f"{COUNTS}, batch bigint").option("basePath", log).parquet(log)
    rows = rows.filter(F.col("batch") > after)
    return (rows if upto is None else rows.filter(F.col("batch") <= upto)).select("term", "n")


def total_counts(spark: SparkSession, log: str) -> DataFrame:
    """(term, termfreq) over all batches."""
    return logged_counts(spark, log).groupBy("term").agg(F.sum("n").alias("termfreq"))


def fold_into_terms(corpus: Corpus, log: str, upto: int) -> int:
    """Add the batches up to `upto` to the term table, new terms with ids, and return the last batch folded.

    How far the log is folded is a counter of the same run, so that a batch counts once even when a run is repeated.
    """
    mark = corpus.read("counters").filter(F.col("key") == log).agg(F.max("value")).first()[0]
    folded = -1 if mark is None else mark
    if upto <= folded:
        return folded
    counts = logged_counts(corpus.spark, log, folded, upto)
    corpus.write("terms", add_counts(corpus.read("terms"), counts, "term", "termfreq", "termid"))
    others = corpus.read("counters").filter(F.col("key") != log)
    corpus.write("counters", others.unionByName(corpus.spark.createDataFrame([(log, upto)], "key string, value bigint")))
    corpus.finish()
    return upto
