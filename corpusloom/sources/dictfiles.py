"""Dictionary text files, one per dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.functions.text import map_characters


def read_dict_files(spark: SparkSession, path: str, id_pattern: str, characters: dict[str, str] | None = None) -> DataFrame:
    """(dicid, term): trimmed lines of text files; the id is what the group of `id_pattern` catches in the file name.

    Files are split by line, so one large dictionary is read by many tasks.
    """
    lines = spark.read.text(path).select(
        F.regexp_extract(F.input_file_name(), id_pattern, 1).try_cast("bigint").alias("dicid"), F.col("value").alias("term")
    )
    if characters:
        lines = lines.withColumn("term", map_characters("term", characters))
    return lines.withColumn("term", F.regexp_replace("term", r"^\s+|\s+$", ""))
